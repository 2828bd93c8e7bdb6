"""Topic source (Kafka), its file-stream twin, and offset bookkeeping.

The Kafka connector jar is not bundled here; ``read_topic`` builds the
standard ``readStream.format("kafka")`` reader and is exercised wherever the
jar is on the classpath.  Tests and the driver use ``read_envelope_files``,
a file stream with the same five columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesboard.schema import ENVELOPE

EARLIEST = "earliest"


def read_topic(spark: SparkSession, bootstrap_servers: str, topics: str,
               starting_offsets: str = EARLIEST, **options: str) -> DataFrame:
    """Subscribe to a comma-separated topic list; string value.

    ``starting_offsets`` is ``"earliest"`` or the JSON from ``start_offsets``;
    on restart the stream's checkpoint wins over it.  At scale pass
    ``maxOffsetsPerTrigger`` (bounds a micro-batch) and ``minPartitions``
    (splits a large topic partition over several tasks) in ``options``.  Records
    aged out of the topic fail the query unless ``failOnDataLoss`` is passed as false.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topics)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


#: Files that one micro-batch takes at most, unless the caller says otherwise.
MAX_FILES_PER_TRIGGER = 1000


def read_envelope_files(spark: SparkSession, path: str,
                        max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """File stream of Parquet envelopes ``(topic, partition, offset, timestamp, value)``.

    Admission is always bounded: a backlog of any size is taken, oldest files
    first, in batches of ``max_files_per_trigger`` files.
    """
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(path)


def offset_ledger(batch: DataFrame) -> DataFrame:
    """Next offset to read per ``(topic, partition)`` after this batch."""
    return batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def latest_offsets(ledger: DataFrame) -> DataFrame:
    """The furthest next offset per ``(topic, partition)``, whichever stream id recorded it."""
    return ledger.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def start_offsets(offsets: DataFrame) -> DataFrame:
    """One row ``starting_offsets``: ``{"topic":{"0":n,...}}``, or ``earliest`` if empty.

    The input has one row per topic partition, so the nested map is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("partition", "next_offset")))
    entries = F.transform(ordered, lambda e: F.struct(
        e["partition"].cast("string").alias("k"), e["next_offset"].alias("v")))
    per_topic = offsets.groupBy("topic").agg(F.map_from_entries(entries).alias("p"))
    by_topic = F.array_sort(F.collect_list(F.struct("topic", "p")), lambda a, b: (
        F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)))
    nested = per_topic.agg(F.map_from_entries(by_topic).alias("m"))
    return nested.select(
        F.when(F.size("m") > 0, F.to_json("m")).otherwise(F.lit(EARLIEST)).alias("starting_offsets"))


def starting_offsets_option(offsets: DataFrame) -> str:
    """The ``startingOffsets`` option text (a one-row result, fetched to the driver)."""
    row = start_offsets(offsets).first()
    return row[0] if row and row[0] else EARLIEST
