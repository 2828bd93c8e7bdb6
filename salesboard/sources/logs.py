"""Raw record logs as tables.

In production the records sit on storage (a topic's archive, landed files);
here they are built from the driver's tables by ``sources.fixtures`` and
written once per application and scale into the scratch folder.  Every query
then reads a plain ``value`` column -- the shape the parser is built for --
instead of re-deriving the lines (and re-running the star join) per query.
The ``ticks`` lines are clustered by ordinal, as a landed log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesboard.session import fresh_dir, use_utc
from salesboard.sources import fixtures as FX

_LOGS: dict[tuple[str, str, str], str] = {}


def ticks_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_ticks`` with its ordinal, as many files as the session has shuffle partitions, each one range in order.

    A slice reads the row groups whose minimum and maximum it meets.  The events are
    dealt and sorted; their lines, several times as large, are made after that.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = FX.tick_events(spark, sf_dir).withColumn("ordinal", FX.event_ordinal())
    return FX.tick_lines(events.repartitionByRange(n, "ordinal").sortWithinPartitions("ordinal")).withColumn(
        "ordinal", FX.envelope_ordinal())


BUILDERS = {
    "ticks": ticks_by_ordinal,
    "sales": FX.raw_sales,           # never sliced: written as the joins leave it, no line is shuffled
}


def raw_log(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The ``ticks`` or ``sales`` record log for a scale, written once per application."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _LOGS.get(key)
    if path is None:
        path = fresh_dir(spark, f"log-{name}")
        BUILDERS[name](spark, sf_dir).write.parquet(path)
        _LOGS[key] = path
    return spark.read.parquet(path)
