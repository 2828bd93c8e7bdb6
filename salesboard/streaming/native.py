"""Streams whose state the engine closes or hands over by itself.

``native_trend`` needs a watermark (a second is closed and appended once, then
forgotten); rows later than the watermark are dropped here but still counted by
the totals query and the batch log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesboard.operators.parse import parse_sales
from salesboard.operators.state import write_partitioned
from salesboard.schema import DELTA_TYPE

DEFAULT_WATERMARK = "10 minutes"


def valid_stream(raw: DataFrame) -> DataFrame:
    """Parsed valid sales of a raw envelope stream (event time as ``time``)."""
    valid, _ = parse_sales(raw, carry=("timestamp",))
    return valid


def native_trend(valid: DataFrame, step: str = "1 second",
                 watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    w = valid.where(F.col("time").isNotNull()).withWatermark("time", watermark)
    return (w.groupBy(F.window("time", step).alias("w"))
            .agg(F.sum("price").cast(DELTA_TYPE).alias("amt"))
            .select(F.col("w.start").alias("bucket"), "amt"))


def upsert_sink(agg: DataFrame, path: str, checkpoint: str, mode: str = "update",
                trigger: dict | None = None) -> StreamingQuery:
    """Write each batch's changed rows as partition ``batch_id`` (replay-safe)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_partitioned(df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")),
                          path, "batch_id")
    return (agg.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def append_sink(df: DataFrame, path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once append to a Parquet folder (file sink with its own log)."""
    return (df.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
