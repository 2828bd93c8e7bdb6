"""The stateful query: running totals in the state store, and what the wallboard polls.

``running_measures`` is one streaming aggregation over grouping sets -- all rows,
shop, second -- in update mode, so a batch hands over the new amounts of the keys it
touched and nothing else.  From them ``serve_batch`` moves a small table on:

* the total, the ordered index of the best shops (``ranking_index``) and the newest
  seconds, as of the batch, in one of two slots (the batch before is in the other,
  so a replayed batch starts from what it started from the first time);
* one snapshot row ``(total_amt, ranking, trend_point)`` per batch.

Neither the batch log nor the whole state is read, but for the rare refill of the
index and for a trend point older than the seconds kept, which are read from the
state store as of the batch before.  Totals, recovery and replay are the engine's.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesboard.functions.scalar import format_time, lagged_now
from salesboard.operators.ranking import RANKING_SIZE
from salesboard.operators.ranking_index import KEEP, advance, newest_amounts
from salesboard.operators.serving import DEFAULT_LAG_SECONDS, serving_snapshot
from salesboard.operators.state import measure_rows, read_store
from salesboard.schema import M_SHOP, M_TOTAL, M_TREND
from salesboard.streaming.job import slim_batch

#: Seconds before the newest one that a slot keeps.
RECENT_SECONDS = 3600
SNAPSHOT_SCHEMA = "total_amt double, ranking string, trend_point string, refilled boolean, batch_id long"
SLOT_SCHEMA = "measure string, key string, amt decimal(28,2)"
#: A slot's rows about itself: its batch, the newest batch with a snapshot, the index's floor.
M_SLOT, SLOT_BATCH, SLOT_SNAPSHOT, SLOT_FLOOR = "slot", "batch", "snapshot", "floor"


@dataclass(frozen=True)
class ServingConfig:
    """Where the totals query keeps its state and what it serves."""

    root: str                         # slots and snapshots
    checkpoint: str                   # the stream checkpoint with the state store
    time_col: str = "event"           # event | ingest | processing
    k: int = RANKING_SIZE
    keep: int = KEEP
    clock: str = "newest"             # trend point served: newest | wall (now - lag_seconds)
    lag_seconds: int = DEFAULT_LAG_SECONDS

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshots"

    def slot(self, batch_id: int) -> str:
        return f"{self.root}/slot={batch_id % 2}"


def running_measures(raw: DataFrame, time_col: str = "event") -> DataFrame:
    """Streaming aggregation ``(shop_id, second, grouping, amt)`` over the grouping sets (), (shop_id), (second)."""
    valid = slim_batch(raw, time_col).where(F.col("status").isNull()).select(
        "shop_id", F.date_trunc("second", "bucket_time").alias("second"), "price")
    return valid.groupingSets([[], ["shop_id"], ["second"]], "shop_id", "second").agg(
        F.grouping_id().alias("grouping"), F.sum("price").alias("amt"))


def run_totals(raw_stream: DataFrame, cfg: ServingConfig, trigger: dict | None = None) -> StreamingQuery:
    """Start the totals query; it serves after every batch."""
    spark = raw_stream.sparkSession
    return (running_measures(raw_stream, cfg.time_col).writeStream.outputMode("update")
            .foreachBatch(lambda df, b: serve_batch(
                measure_rows(df, F.col("shop_id"), F.col("second"), F.col("grouping"), F.col("amt")), b, cfg, spark))
            .option("checkpointLocation", cfg.checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def serve_batch(changed: DataFrame, batch_id: int, cfg: ServingConfig, spark: SparkSession | None = None) -> None:
    """Move the served table on by the new amounts ``(measure, key, amt)`` of the touched keys.

    ``spark`` is the session to plan in; a stateful query's own has no adaptive execution,
    which would leave a file for each of the state's partitions in a slot.
    """
    spark = spark or changed.sparkSession
    changed = changed.persist()                       # the state is read and written once
    try:
        before, was = _slot_before(spark, cfg, batch_id)
        got = changed.agg(F.max(_of(M_TREND, "key")).alias("newest"), F.count("*").alias("n")).first()
        index, floor, again = advance(
            before.where(F.col("measure") == M_SHOP).select("key", "amt"), was["floor"],
            changed.where(F.col("measure") == M_SHOP).select("key", "amt"),
            lambda: read_store(spark, cfg.checkpoint, M_SHOP, batch_id - 1).select("key", "amt"), cfg.k, cfg.keep)
        others = F.col("measure").isin(M_TOTAL, M_TREND)
        rest = newest_amounts(before.where(others), changed.where(others), ("measure", "key"))
        newest = max((t for t in (was["newest"], got["newest"]) if t), default=None)
        oldest = format_time(F.to_timestamp(F.lit(newest)) - F.make_dt_interval(secs=F.lit(RECENT_SECONDS)))
        rest = rest.where((F.col("measure") == M_TOTAL) | (F.col("key") >= oldest))
        shown = batch_id if got["n"] else was["snapshot"]
        about = [(M_SLOT, SLOT_BATCH, Decimal(batch_id)), (M_SLOT, SLOT_SNAPSHOT, None if shown is None else Decimal(shown)), (M_SLOT, SLOT_FLOOR, floor)]
        rows = (index.select(F.lit(M_SHOP).alias("measure"), "key", "amt").unionByName(rest.select("measure", "key", "amt"))
                .unionByName(spark.createDataFrame(about, SLOT_SCHEMA)))
        rows.write.mode("overwrite").parquet(cfg.slot(batch_id))
        if not got["n"]:                              # an empty batch serves nothing new
            return
        served, now = spark.read.schema(SLOT_SCHEMA).parquet(cfg.slot(batch_id)), None
        if cfg.clock == "wall":
            point = spark.range(1).select(format_time(lagged_now(F.current_timestamp(), cfg.lag_seconds))).first()[0]
            now = F.to_timestamp(F.lit(point)) + F.make_dt_interval(secs=F.lit(cfg.lag_seconds))
            served = served.unionByName(_old_point(spark, cfg, batch_id, changed, served, point))
        snap = serving_snapshot(served, cfg.k, cfg.lag_seconds, now).withColumn("refilled", F.lit(again))
        snap.write.mode("overwrite").parquet(f"{cfg.snapshots}/batch_id={int(batch_id)}")
    finally:
        changed.unpersist()


def _of(measure: str, column: str, key: str | None = None) -> Column:
    """``column`` in rows of ``measure`` (and ``key``), null in others."""
    is_it = F.col("measure") == measure
    return F.when(is_it & (F.col("key") == key) if key else is_it, F.col(column))


def _about(rows: DataFrame) -> Row:
    """What a slot says of itself, and its newest second: one row."""
    return rows.agg(F.max(_of(M_SLOT, "amt", SLOT_BATCH)).cast("long").alias("batch"), F.max(_of(M_SLOT, "amt", SLOT_SNAPSHOT)).cast("long").alias("snapshot"),
                    F.max(_of(M_SLOT, "amt", SLOT_FLOOR)).alias("floor"), F.max(_of(M_TREND, "key")).alias("newest")).first()


def _slot(spark: SparkSession, cfg: ServingConfig, batch_id: int) -> tuple[DataFrame, Row] | None:
    """Rows of the slot that ``batch_id`` is written to; none before it is first written."""
    try:
        rows = spark.read.schema(SLOT_SCHEMA).option("ignoreMissingFiles", "true").parquet(cfg.slot(batch_id))
        return rows, _about(rows)
    except AnalysisException:                         # no such folder yet
        return None


def _slot_before(spark: SparkSession, cfg: ServingConfig, batch_id: int) -> tuple[DataFrame, Row]:
    """Served rows as of the batch before ``batch_id``.

    A slot that does not hold that batch (a new folder beside an old checkpoint) is
    made again from the state store.
    """
    if batch_id == 0:
        rows = spark.createDataFrame([], SLOT_SCHEMA)
        return rows, _about(rows)
    held = _slot(spark, cfg, batch_id - 1)
    if held is None or held[1]["batch"] != batch_id - 1:
        rows = read_store(spark, cfg.checkpoint, batch_id=batch_id - 1)
        return rows, _about(rows)
    return held


def _old_point(spark: SparkSession, cfg: ServingConfig, batch_id: int, changed: DataFrame, held: DataFrame, point: str) -> DataFrame:
    """The asked second from the state store, if it is older than the seconds that ``held`` keeps."""
    is_point = (F.col("measure") == M_TREND) & (F.col("key") == point)
    oldest = held.where(F.col("measure") == M_TREND).agg(F.min("key")).first()[0]
    if oldest is None or point >= oldest:
        return held.where(F.lit(False))
    now = changed.where(is_point)
    if batch_id == 0 or not now.isEmpty():
        return now.select("measure", "key", "amt")
    return read_store(spark, cfg.checkpoint, batch_id=batch_id - 1).where(is_point)


# --- reading what is served -------------------------------------------------------

def read_snapshots(spark: SparkSession, cfg: ServingConfig) -> DataFrame:
    """Every snapshot, one per batch that had rows (``live_poll`` history)."""
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(cfg.snapshots)


def _newest_slot(spark: SparkSession, cfg: ServingConfig) -> tuple[DataFrame, Row] | None:
    """The slot of the newest batch; the other one may be written anew at this moment."""
    held = [s for s in (_slot(spark, cfg, 0), _slot(spark, cfg, 1)) if s and s[1]["batch"] is not None]
    return max(held, key=lambda s: s[1]["batch"], default=None)


def latest_snapshot(spark: SparkSession, cfg: ServingConfig) -> DataFrame:
    """The newest snapshot, what a wallboard polls; its folder is known, so none is listed."""
    held = _newest_slot(spark, cfg)
    if held is None or held[1]["snapshot"] is None:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    n = held[1]["snapshot"]
    return spark.read.schema(SNAPSHOT_SCHEMA).option("basePath", cfg.snapshots).parquet(f"{cfg.snapshots}/batch_id={n}")


def served_rows(spark: SparkSession, cfg: ServingConfig, measure: str | None = None) -> DataFrame:
    """``(measure, key, amt)`` behind the newest snapshot: total, best shops, newest seconds."""
    held = _newest_slot(spark, cfg)
    rows = spark.createDataFrame([], SLOT_SCHEMA) if held is None else held[0].where(F.col("measure") != M_SLOT)
    return rows.where(F.col("measure") == measure) if measure else rows
