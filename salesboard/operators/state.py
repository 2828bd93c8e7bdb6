"""Running state and the batch log beside it.

The running totals live in the engine's state store: ``streaming.totals`` is one
stateful aggregation whose checkpoint holds, per ``(measure, key)``, the amount
after every committed batch.  ``read_store`` reads that state as a table (any
retained version of it), ``publish_state`` writes a version as a table clustered
by key, for point reads.

The batch log is the audit trail of the stateless job, a folder of plain tables::

    log/stream_id=<s>/batch_id=<b>/kind=<k>/

``kind`` is a measure (``total``, ``shop``, ``trend``: rows ``key, amt`` that the
batch adds) or a by-product written in the same job: ``metric`` (row counts),
``offset`` (next offset per topic partition) and ``bad`` (quarantined lines).  A
micro-batch writes all of them at once with *dynamic partition overwrite*, so a
replayed batch id (after a crash between the write and the checkpoint commit)
replaces its own partitions instead of adding twice.  ``read_state`` adds the log
up, which must give what the state store holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesboard.schema import DELTA_TYPE, M_SHOP, M_TOTAL, M_TREND, TIME_FORMAT, TOTAL_KEY

MEASURES = (M_TOTAL, M_SHOP, M_TREND)
LOG_PARTITIONS = ("stream_id", "batch_id", "kind")
#: Batch-log schema, partition columns included (read with it: no type inference).
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("amt", T.DecimalType(28, 2)),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("line", T.StringType()), T.StructField("n_fields", T.IntegerType()),
    T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("kind", T.StringType()),
])


# --- the state store ------------------------------------------------------------

#: Bits of the grouping id for the measures' grouping sets over (shop, second).
GROUPED_TOTAL, GROUPED_SHOP, GROUPED_SECOND = 0b11, 0b01, 0b10


def measure_rows(df: DataFrame, shop, second, grouping_id, amt) -> DataFrame:
    """``(measure, key, amt)`` of the measures' grouping sets; blank shops and missing times are no keys."""
    measure = (F.when(grouping_id == GROUPED_TOTAL, M_TOTAL).when(grouping_id == GROUPED_SHOP, M_SHOP)
               .when(grouping_id == GROUPED_SECOND, M_TREND))
    key = (F.when(grouping_id == GROUPED_TOTAL, F.lit(TOTAL_KEY)).when(grouping_id == GROUPED_SHOP, shop)
           .when(grouping_id == GROUPED_SECOND, F.date_format(second, TIME_FORMAT)))
    return (df.select(measure.alias("measure"), key.alias("key"), amt.cast(DELTA_TYPE).alias("amt"))
            .where((F.col("key") != "") & F.col("amt").isNotNull()))


def read_store(spark: SparkSession, checkpoint: str, measure: str | None = None,
               batch_id: int | None = None) -> DataFrame:
    """``(measure, key, amt)`` as of the newest committed batch of a totals query, or as of ``batch_id``.

    One read of the store's snapshot and the changes since it, however many
    batches there have been.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", int(batch_id))
    rows = measure_rows(reader.load(checkpoint), F.col("key.shop_id"), F.col("key.second"),
                        F.col("key.spark_grouping_id"), F.col("value.sum"))
    return rows.where(F.col("measure") == measure) if measure else rows


def publish_state(spark: SparkSession, checkpoint: str, path: str, batch_id: int | None = None) -> None:
    """Write a version of the state as a table clustered by measure and key: a point get skips
    row groups by their min/max statistics."""
    rows = read_store(spark, checkpoint, batch_id=batch_id)
    (rows.repartitionByRange("measure", "key").sortWithinPartitions("measure", "key")
     .write.mode("overwrite").parquet(path))


def state_point_get(state: DataFrame, key_col: str, key_value) -> DataFrame:
    """One row by key; on a Parquet table the predicate reaches the scan."""
    return state.where(F.col(key_col) == F.lit(key_value))


def state_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def state_merge(hist: DataFrame, delta: DataFrame, keys=("key",),
                hist_amt: str = "amt", delta_amt: str = "delta") -> DataFrame:
    """Stored state ⋈ batch result on the key, absent = 0 (full outer equi-join).

    Both sides hold one row per key (they are aggregates), so a hot key is a
    single row here and the join cannot skew.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    j = hist.select(*keys, F.col(hist_amt).alias("_h")).join(
        delta.select(*keys, F.col(delta_amt).alias("_d")), keys, "full_outer")
    return j.select(*keys, (F.coalesce("_h", F.lit(0)) + F.coalesce("_d", F.lit(0)))
                    .cast(DELTA_TYPE).alias("amt"))


# --- the batch log ----------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Overwrite only the partitions present in ``df`` (replay-safe)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def log_columns(kind, key=None, amt=None, topic=None, partition=None,
                line=None, n_fields=None) -> list:
    """Columns projecting rows of any kind onto the common batch-log schema."""
    def c(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return (F.col(x) if isinstance(x, str) else x).cast(t)
    return [(F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
            c(key, "string").alias("key"), c(amt, DELTA_TYPE).alias("amt"),
            c(topic, "string").alias("topic"), c(partition, "int").alias("partition"),
            c(line, "string").alias("line"), c(n_fields, "int").alias("n_fields")]


def log_rows(df: DataFrame, kind, key=None, amt=None, topic=None, partition=None,
             line=None, n_fields=None) -> DataFrame:
    """Project rows of any kind onto the common batch-log schema."""
    return df.select(*log_columns(kind, key, amt, topic, partition, line, n_fields))


def write_batch_log(state_root: str, rows: DataFrame, stream_id: str, batch_id: int) -> None:
    """One job writes every output of a batch; replay overwrites the same partitions.

    Rows are rebalanced by kind, so that a small batch writes a file a kind and a
    large one files of the advised size.
    """
    out = rows.hint("rebalance", "kind").select(
        "*", F.lit(stream_id).alias("stream_id"), F.lit(int(batch_id)).cast("long").alias("batch_id"))
    write_partitioned(out, f"{state_root}/log", *LOG_PARTITIONS)


def upsert_add(state_root: str, deltas: DataFrame, stream_id: str, batch_id: int) -> None:
    """Keyed add to the log, idempotent by ``(stream_id, batch_id)``.

    ``deltas`` has ``(measure, key, delta)``.
    """
    write_batch_log(state_root, log_rows(deltas, F.col("measure"), "key", "delta"),
                    stream_id, batch_id)


def read_log(spark: SparkSession, state_root: str, *kinds: str) -> DataFrame:
    """Batch-log rows of the given kinds (partition pruning on ``kind``)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{state_root}/log")
    return log.where(F.col("kind").isin(*kinds)) if kinds else log


def read_deltas(spark: SparkSession, state_root: str) -> DataFrame:
    """``(measure, key, delta, stream_id, batch_id)`` of every batch."""
    return read_log(spark, state_root, *MEASURES).select(
        F.col("kind").alias("measure"), "key", F.col("amt").alias("delta"), "stream_id", "batch_id")


def read_state(spark: SparkSession, state_root: str, measure: str | None = None,
               up_to_batch: int | None = None) -> DataFrame:
    """``(measure, key, amt)``: the batch log added up, over all streams that write to it."""
    deltas = read_deltas(spark, state_root)
    if measure:
        deltas = deltas.where(F.col("measure") == measure)
    if up_to_batch is not None:
        deltas = deltas.where(F.col("batch_id") <= int(up_to_batch))
    return deltas.groupBy("measure", "key").agg(F.sum("delta").cast(DELTA_TYPE).alias("amt"))


def read_metrics(spark: SparkSession, state_root: str) -> DataFrame:
    """Per batch: ``(stream_id, batch_id, n_rows, n_valid, n_bad, n_bad_time, amt, batch_time)``."""
    log = read_log(spark, state_root, "metric", M_TOTAL)
    def pick(kind, key=None):
        cond = F.col("kind") == kind
        if key:
            cond = cond & (F.col("key") == key)
        return F.max(F.when(cond, F.col("amt")))
    per = log.groupBy("stream_id", "batch_id").agg(
        pick("metric", "n_rows").cast("long").alias("n_rows"),
        pick("metric", "n_valid").cast("long").alias("n_valid"),
        pick("metric", "n_bad_time").cast("long").alias("n_bad_time"),
        pick(M_TOTAL).alias("amt"),
        F.timestamp_millis(pick("metric", "batch_time_ms").cast("long")).alias("batch_time"))
    return per.select("stream_id", "batch_id", "n_rows", "n_valid",
                      (F.col("n_rows") - F.col("n_valid")).alias("n_bad"), "n_bad_time", "amt", "batch_time")


def read_ledger(spark: SparkSession, state_root: str) -> DataFrame:
    """Per batch: ``(topic, partition, next_offset, stream_id, batch_id)``."""
    return read_log(spark, state_root, "offset").select(
        "topic", "partition", F.col("amt").cast("long").alias("next_offset"), "stream_id", "batch_id")


def read_quarantine(spark: SparkSession, state_root: str) -> DataFrame:
    """Rejected lines: ``(value, n_fields, reason, stream_id, batch_id)``.

    Lines with reason ``bad_time`` are missing from the trend alone.
    """
    return read_log(spark, state_root, "bad").select(
        F.col("line").alias("value"), "n_fields", F.col("key").alias("reason"), "stream_id", "batch_id")
