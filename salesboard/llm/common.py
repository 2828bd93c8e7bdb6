"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesboard.session import ensure_checkpoint_dir, fresh_dir

#: The separators of the contracts' words ``[^\x20\x09-\x0D]+``, for JVM patterns.
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def byte_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (ASCII white space is exactly what ``bytes.split`` cuts at)."""
    return (text or "").encode().split()


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    Cuts the lineage at a table that every executor sees, so an expensive pass
    is not repeated and survives a lost executor.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps, which it does once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def map_rows(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with per-task setup: ``start()`` builds the batch function once per task.

    Arrow's pool keeps what it has freed; it is given back after every batch, as workers
    stay, idle or with other caches, while later stages need the executor's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            yield fn(batch)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


@contextmanager
def no_collection():
    """Cycle collection is off while a task fills caches of many strings without cycles, and as it was after."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


#: Characters of text that a task turns into tokens at a time (one longer text is a slice of its own).
SLICE_CHARS = 4_000_000


def text_slices(texts: pa.Array, chars: int | None = None) -> Iterator[list[str]]:
    """The texts of a batch in order, in lists of about ``chars`` characters (``SLICE_CHARS`` unless said otherwise)."""
    chars = chars or SLICE_CHARS
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def array_slices(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """The texts of a batch in order, as slices of about ``size`` bytes (``SLICE_CHARS`` unless said otherwise) without a copy."""
    held = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    past, at = np.cumsum(held), 0
    while at < len(texts):
        end = min(len(texts), int(np.searchsorted(past, past[at] - held[at] + (size or SLICE_CHARS))) + 1)
        yield texts.slice(at, end - at)
        at = end


class Tokens:
    """The tokens of several texts as codes into their distinct values.

    Work on a token is done once per distinct token and then gathered by code;
    ``at[k]:at[k + 1]`` are the codes of text ``k``.
    """

    def __init__(self, texts: Sequence[list], kind: pa.DataType):
        self.at = np.cumsum([0, *map(len, texts)])
        coded = pa.array(list(chain.from_iterable(texts)), kind).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.distinct = coded.dictionary.to_pylist()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of ``values[code]``."""
        total = np.concatenate([[0], np.cumsum(values[self.codes])])
        return total[self.at[1:]] - total[self.at[:-1]]

    def joined(self, values: list, kind: pa.DataType, by: str | bytes) -> pa.Array:
        """Per text, ``values[code]`` joined; values that are None are left out."""
        keep = np.array([v is not None for v in values], bool)
        codes, at = self.codes, self.at
        if not keep.all():
            kept = keep[codes]
            at, codes = np.concatenate([[0], np.cumsum(kept)])[at], codes[kept]
        flat = pa.array(values, kind).take(pa.array(codes))
        lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), flat.cast(pa.large_string() if kind == pa.string() else pa.large_binary()))
        return pc.binary_join(lists, pa.scalar(by, lists.type.value_type))


#: Rows of a few dozen bytes up to which a counted table is broadcast.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted), else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df
