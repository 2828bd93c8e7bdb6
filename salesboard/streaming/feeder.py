"""Replay feeder: publish ordered slices of a log into a stream's source folder.

``log_slice`` is the slice itself (an ordinal range filter, pushed to the
scan).  ``Feeder`` stages a log once, cut into ``n`` ordinal ranges, then
appends one range at a time to a folder a file stream watches -- the way
records arrive over time.  Staging and publishing are plain Spark writes;
nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesboard.session import ensure_checkpoint_dir


def log_slice(log: DataFrame, start: int, size: int, ordinal: str = "ordinal") -> DataFrame:
    """Lines ``[start, start + size)`` of an ordered log (by its ordinal column)."""
    o = F.col(ordinal)
    return log.where((o >= F.lit(int(start))) & (o < F.lit(int(start) + int(size))))


def with_line_ordinal(lines: DataFrame, name: str = "ordinal") -> DataFrame:
    """Give a text log (``spark.read.text``) a 0-based line ordinal: by file path, block and place in the block.

    Lines are counted per block of a file (one small row each); the rows are
    range-partitioned by path and block, so that the lines before a block are
    those of earlier partitions (one row per shuffle partition) and of earlier
    blocks of its own.  The log is scanned twice and never copied.  Both scans must
    cut the files alike; a line whose block was not counted raises.
    """
    ensure_checkpoint_dir(lines.sparkSession)
    tagged = lines.select("*", F.col("_metadata.file_path").alias("_path"),
                          F.col("_metadata.file_block_start").alias("_block"),
                          F.monotonically_increasing_id().alias("_m"))
    blocks = (tagged.groupBy("_path", "_block").agg(F.count("*").alias("_n"), F.min("_m").alias("_m0"))
              .repartitionByRange("_path", "_block")
              .select("*", F.spark_partition_id().alias("_p")).checkpoint())
    parts = (blocks.groupBy("_p").agg(F.sum("_n").alias("_all"))
             .select("_p", (F.sum("_all").over(Window.orderBy("_p")) - F.col("_all")).alias("_base")))
    in_part = Window.partitionBy("_p").orderBy("_path", "_block")
    starts = (blocks.withColumn("_own", F.sum("_n").over(in_part) - F.col("_n")).join(parts, "_p")
              .select("_path", "_block", "_n", "_m0", (F.col("_base") + F.col("_own")).alias("_start")))
    place = F.col("_m") - F.col("_m0")
    ordinal = F.when((place >= 0) & (place < F.col("_n")), F.col("_start") + place).otherwise(
        F.raise_error(F.lit("the log was cut into other blocks while it was read")).cast("long"))
    return tagged.join(starts, ["_path", "_block"], "left").select(*lines.columns, ordinal.alias(name))


def chunk_expr(ordinal: Column, lo: int, hi: int, n: int) -> Column:
    """Chunk ``0..n-1`` of an ordinal in ``[lo, hi]``, equal-width ranges."""
    return F.floor((ordinal - F.lit(lo)) * F.lit(n) / F.lit(hi - lo + 1)).cast("int")


#: Rows of an arrival that go into one file at most, and at least if there are more than ``files`` files.
FILE_ROWS, FILE_LEAST_ROWS = 50_000, 1_000


def arrival_files(sizes: list[int], least: int) -> int:
    """Files of every arrival, given the rows of each: they grow with the largest, so that its
    records are written and read by as many tasks; the smallest must fill them."""
    if not sizes:
        return least
    return max(least, min(-(-max(sizes) // FILE_ROWS), min(sizes) // FILE_LEAST_ROWS))


class Feeder:
    """Stage ``log`` in ``n_chunks`` ordinal ranges; publish them one by one.

    ``files`` is the least number of files of an arrival; ``self.files`` what each has.
    """

    def __init__(self, spark: SparkSession, log: DataFrame, staging_dir: str, source_dir: str,
                 n_chunks: int, ordinal: str = "ordinal", keep=None, files: int = 2):
        self.spark, self.staging, self.source = spark, staging_dir, source_dir
        self.n_chunks = n_chunks
        self.columns = list(keep or [c for c in log.columns if c != ordinal])
        b = log.agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi")).first()
        self.lo, self.hi = int(b["lo"]), int(b["hi"])
        (log.withColumn("chunk", chunk_expr(F.col(ordinal), self.lo, self.hi, n_chunks))
         .write.mode("overwrite").partitionBy("chunk").parquet(staging_dir))
        staged = spark.read.parquet(staging_dir).where("chunk is not null").groupBy("chunk").count().collect()   # a row a chunk
        self.files = arrival_files([r["count"] for r in staged], files)
        self.schema = spark.read.parquet(staging_dir).select(*self.columns).schema

    def chunk(self, k: int) -> DataFrame:
        return self.spark.read.parquet(self.staging).where(F.col("chunk") == k).select(*self.columns)

    def publish(self, k: int) -> None:
        """One arrival: ``files`` files (a reader that takes as many a trigger takes one arrival a batch)."""
        self.chunk(k).repartition(self.files).write.mode("append").parquet(self.source)

    def publish_empty(self) -> None:
        """An empty file: the stream sees a new offset but no rows."""
        self.spark.createDataFrame([], self.schema).write.mode("append").parquet(self.source)
