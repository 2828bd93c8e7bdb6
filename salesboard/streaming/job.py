"""The stateless job: one stream, one parse, a replay-safe log of every batch.

``run`` starts ``readStream -> foreachBatch(process_batch)``.  Per micro-batch:

1. the raw rows are parsed once and the narrow slim frame is persisted
   (the aggregation and the quarantine both read it); an empty batch writes
   nothing (no offsets, no metrics);
2. ONE job writes what the batch adds to the three measures, its metrics, the
   quarantined lines and the offset ledger as partitions
   ``(stream_id, batch_id, kind)`` of the batch log, with dynamic partition
   overwrite -- a batch replayed after a crash overwrites itself instead of
   adding twice (the stream checkpoint is the real recovery point).

The running totals and what the wallboard polls come from ``streaming.totals``.
Amounts are decimals end to end; the driver sees only the batch's observed size.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesboard.operators.measures import bucket_time
from salesboard.operators.parse import parse_records
from salesboard.operators.state import log_columns, write_batch_log
from salesboard.sources.topic import EARLIEST, read_topic
from salesboard.schema import DELTA_TYPE, M_SHOP, M_TOTAL, M_TREND, TIME_FORMAT, TOTAL_KEY

ENVELOPE_CARRY = ("topic", "partition", "offset", "timestamp")


@dataclass(frozen=True)
class JobConfig:
    """Where a job writes and how it buckets time.

    ``stream_id`` must be unique per checkpoint: batch ids restart at 0 with a
    new checkpoint, and the batch log is keyed by both.
    """

    state_root: str
    stream_id: str = "main"
    time_col: str = "event"          # event | ingest | processing


def slim_batch(raw: DataFrame, time_col: str = "event") -> DataFrame:
    """Parse a raw batch into the narrow frame every output reads."""
    return parse_records(raw, carry=ENVELOPE_CARRY).select(*_slim_columns(time_col))


@lru_cache(maxsize=8)
def _slim_columns(time_col: str) -> tuple:
    event_time = F.try_to_timestamp(F.col("time"), F.lit(TIME_FORMAT))
    return (F.col("topic"), F.col("partition"), F.col("offset"),
            bucket_time(time_col, event=event_time, ingest=F.col("timestamp")).alias("bucket_time"),
            F.col("price"), F.col("shop_id"), F.col("status"), F.col("n_fields"),
            F.when(F.col("status").isNotNull() | event_time.isNull(), F.col("value")).alias("value"))


#: Grouping sets of a batch and their grouping ids over (shop_id, second, topic, partition).
BATCH_KEYS = ("shop_id", "second", "topic", "partition")
BATCH_SETS = {0b1111: (), 0b0111: ("shop_id",), 0b1011: ("second",), 0b1100: ("topic", "partition")}
ALL_ROWS, BY_SHOP, BY_SECOND, BY_PARTITION = BATCH_SETS


def batch_log(slim: DataFrame) -> DataFrame:
    """Everything a batch writes, as batch-log rows: ONE aggregation + the bad lines.

    One pass over four grouping sets -- all rows, shop, second, topic partition --
    with map-side partial aggregation and one shuffle.  The keyless figures (row
    counts, the total, the batch clock) are one group, unfolded into rows after
    the aggregation; the busiest key is pre-combined in every map task.
    """
    c = _batch_log_columns()
    grouped = slim.select(*c["inputs"]).groupingSets([list(s) for s in BATCH_SETS.values()], *BATCH_KEYS).agg(*c["aggs"])
    rows = grouped.select(F.explode(c["rows"]).alias("e")).select("e.*")
    return rows.unionByName(slim.where(c["bad"]).select(*c["bad_rows"]))


@lru_cache(maxsize=1)
def _batch_log_columns() -> dict:
    ok = F.col("status").isNull()
    timeless = ok & F.col("bucket_time").isNull()
    second = F.date_format(F.date_trunc("second", F.col("bucket_time")), TIME_FORMAT)

    def row(kind, **values):
        return F.struct(*log_columns(kind, **values))

    total = F.coalesce("amt", F.lit(0))                  # an all-bad batch still has a total
    whole = F.array(
        row("metric", key=F.lit("n_rows"), amt="n_rows"),
        row("metric", key=F.lit("n_valid"), amt="n_valid"),
        # valid records without a time: in the total and their shop, not in the trend
        row("metric", key=F.lit("n_bad_time"), amt="n_bad_time"),
        # the batch clock (one value per query)
        row("metric", key=F.lit("batch_time_ms"), amt=F.unix_millis(F.current_timestamp())),
        row(M_TOTAL, key=F.lit(TOTAL_KEY), amt=total))
    which = F.col("grouping")
    return {
        "inputs": (F.when(ok & (F.col("shop_id") != ""), F.col("shop_id")).alias("shop_id"), F.when(ok, second).alias("second"), F.col("topic"), F.col("partition"),
                   F.when(ok, F.col("price")).alias("price"), F.col("offset"), ok.alias("ok"), timeless.alias("timeless")),
        "aggs": (F.grouping_id().alias("grouping"), F.sum("price").cast(DELTA_TYPE).alias("amt"), F.max("offset").alias("off"), F.count("*").alias("n_rows"),
                 F.count_if("ok").alias("n_valid"), F.count_if("timeless").alias("n_bad_time")),
        "rows": (F.when(which == ALL_ROWS, whole)
                 .when((which == BY_SHOP) & F.col("shop_id").isNotNull(), F.array(row(M_SHOP, key="shop_id", amt="amt")))
                 .when((which == BY_SECOND) & F.col("second").isNotNull(), F.array(row(M_TREND, key="second", amt="amt")))
                 .when(which == BY_PARTITION, F.array(row("offset", amt=F.col("off") + 1, topic="topic", partition="partition")))),
        "bad": ~ok | timeless,
        "bad_rows": log_columns("bad", key=F.coalesce("status", F.lit("bad_time")), line="value", n_fields="n_fields"),
    }


def process_batch(raw: DataFrame, batch_id: int, cfg: JobConfig) -> int:
    """Body of ``foreachBatch``; also callable on a plain batch DataFrame.

    Returns the number of records, observed during the write job.  An empty batch
    writes nothing.
    """
    slim = slim_batch(raw, cfg.time_col).persist()
    try:
        if slim.isEmpty():
            return 0
        seen = Observation(f"batch_{cfg.stream_id}_{batch_id}_{uuid.uuid4().hex[:8]}")
        out = batch_log(slim).observe(
            seen, F.coalesce(F.sum(F.when((F.col("kind") == "metric") & (F.col("key") == "n_rows"),
                                          F.col("amt"))), F.lit(0)).cast("long").alias("n_rows"))
        write_batch_log(cfg.state_root, out, cfg.stream_id, batch_id)
        return int(seen.get["n_rows"])
    finally:
        slim.unpersist()


def run(raw_stream: DataFrame, cfg: JobConfig, checkpoint: str,
        trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the job.  ``trigger`` e.g. ``{"processingTime": "5 seconds"}``
    (the batch interval) or ``{"availableNow": True}``."""
    w = (raw_stream.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, cfg))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def run_topic(spark, bootstrap_servers: str, topics: str, cfg: JobConfig, checkpoint: str,
              batch_seconds: int | None = None, starting_offsets: str = EARLIEST,
              **kafka_options: str) -> StreamingQuery:
    """The live job on a topic, with the batch interval as its trigger.

    ``starting_offsets`` counts for the first start of a checkpoint only; after
    that the stream checkpoint is the source of truth.
    """
    raw = read_topic(spark, bootstrap_servers, topics, starting_offsets, **kafka_options)
    trigger = micro_batch_trigger(batch_seconds) if batch_seconds else None
    return run(raw, cfg, checkpoint, trigger)


def micro_batch_trigger(seconds: int) -> dict:
    """The fixed batch interval as a trigger."""
    return {"processingTime": f"{int(seconds)} seconds"}
