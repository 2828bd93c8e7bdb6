"""Benchmark decontamination by greedy string tiling.

1. Documents and benchmark items are cut into words (lower case, letters and
   digits); every ``SEED_WORDS`` consecutive words give a seed hash.
2. Seeds of documents are joined with those of the items.  The item side is
   counted: up to a bound it is broadcast, beyond it the join shuffles.
3. A document must share as many seeds as tiles of the asked coverage hold at least
   (a tile of ``s`` words holds ``s - SEED_WORDS + 1`` and no tile is shorter than a
   seed, so one seed for every ``SEED_WORDS`` covered words).  For each document and item that do, greedy string tiling marks the
   longest non-overlapping matches first; matches of at least the current search
   length are found by running Karp-Rabin hashes, and the search length halves
   down to the seed length.
4. An item is leaked into a document if its tiles cover at least ``COVERAGE`` of
   its words, in whatever order the tiles stand in the document.

An item of fewer words than a seed is one tile or none: its words are looked up as
one seed of their own length.  Such a find may be chance, so ``keep_clean`` asks for
items of at least ``SEED_WORDS`` words unless told otherwise.

Edge cases: null and empty texts have no words and no item; items with the same id and other
text are searched each; repeated document rows are each searched.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import Tokens, map_rows, small_side, text_slices, whole_text, written

#: Words of a seed, which is also the shortest tile, and the share of an item's words that tiles must cover.
SEED_WORDS, COVERAGE = 5, 0.6
#: Benchmark seeds up to which their table is broadcast (two numbers a row).
BROADCAST_SEEDS = 1_000_000
WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def seed_hashes(word_hashes: np.ndarray, k: int = SEED_WORDS) -> np.ndarray:
    """A polynomial hash of every ``k`` consecutive word hashes."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _STEP + word_hashes[j:j + n]
    return out


def _seeds(rows: DataFrame, columns: str, names: list[str], k: int = SEED_WORDS, short: bool = False) -> DataFrame:
    """``names`` of ``rows`` (with ``text``) and ``seeds`` of ``k`` words, ``n_words``, ``row`` (a number of its own for each row).

    With ``short`` a text of fewer words has all of them as its one seed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for texts in text_slices(batch["text"]):
                tokens = Tokens([words(t) for t in texts], pa.string())
                hashed = np.array([xxhash.xxh64_intdigest(w) for w in tokens.distinct], np.uint64)[tokens.codes] if tokens.distinct else np.zeros(0, np.uint64)
                seeds = [seed_hashes(hashed[a:b], min(k, b - a) if short and b > a else k) for a, b in zip(tokens.at, tokens.at[1:])]
                flat = np.concatenate([np.zeros(0, np.uint64), *seeds]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, seeds)]), pa.int32()), pa.array(flat))
                n = len(texts)
                yield pa.record_batch([*(batch[c].slice(at, n) for c in names), lists, pa.array(np.diff(tokens.at), pa.int64()),
                                       pa.array(range(row, row + n), pa.int64())], names=[*names, "seeds", "n_words", "row"])
                at, row = at + n, row + n

    return rows.mapInArrow(run, f"{columns}, seeds array<long>, n_words long, row long")


# --- tiling ---------------------------------------------------------------------

def tiles(doc: list[tuple[int, int]], item: list[int], k: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling of an item over a document: ``(document word, item word, words)`` of each tile.

    ``doc`` has the places and hashes of the document's seeds that the item
    shares, ``item`` the hashes of all its seeds.  A match of ``s`` words is a run
    of ``s - k + 1`` equal seeds.
    """
    at, n_words = dict(doc), len(item) + k - 1
    doc_marked: set[int] = set()
    item_free = [True] * n_words
    found: list[tuple[int, int, int]] = []
    s = n_words
    while s >= k and any(item_free):
        longest, matches = _scan(at, item, doc_marked, item_free, s, k)
        for size, p, q in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if any(not f for f in item_free[q:q + size]) or any(p + j in doc_marked for j in range(size)):
                continue
            found.append((p, q, size))
            item_free[q:q + size] = [False] * size
            doc_marked.update(range(p, p + size))
        if s == k and not matches:
            break
        if s > k:
            s = max(k, s // 2)
    return found


def _scan(at: dict[int, int], item: list[int], doc_marked: set[int], item_free: list[bool], s: int, k: int) -> tuple[int, list[tuple[int, int, int]]]:
    """All maximal matches of at least ``s`` unmarked words, by running Karp-Rabin hashes over windows of seeds."""
    w = s - k + 1  # seeds of a window
    mask, top = (1 << 64) - 1, pow(31, w, 1 << 64)

    def windows(symbols: list[int]) -> Iterator[int]:
        h = 0
        for j, x in enumerate(symbols):
            h = (h * 31 + x) & mask
            if j >= w:
                h = (h - top * symbols[j - w]) & mask
            if j >= w - 1:
                yield h

    starts: dict[int, list[int]] = defaultdict(list)
    for q, h in enumerate(windows(item)):
        if all(item_free[q:q + s]):
            starts[h].append(q)
    longest, out = 0, []
    run: list[int] = []
    for p in [*sorted(p for p in at if p not in doc_marked), None]:
        if run and (p is None or p != run[-1] + 1):
            for j, h in enumerate(windows([at[x] for x in run])):
                for q in starts.get(h, ()):
                    if (size := _extend(at, item, doc_marked, item_free, run[j], q, k)) >= s:
                        longest = max(longest, size)
                        out.append((size, run[j], q))
                        if size == len(item_free):
                            return longest, out  # the whole item: no better match is possible
            run = []
        if p is not None:
            run.append(p)
    return longest, out


def _extend(at: dict[int, int], item: list[int], doc_marked: set[int], item_free: list[bool], p: int, q: int, k: int) -> int:
    """Words of the match that begins at document word ``p`` and item word ``q`` (0 if the seeds there differ)."""
    n = 0
    while q + n < len(item) and at.get(p + n) == item[q + n]:
        n += 1
    size = n + k - 1 if n else 0
    for j in range(size):
        if p + j in doc_marked or not item_free[q + j]:
            return j if j >= k else 0
    return size


# --- operator -------------------------------------------------------------------

def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least_words: int = 1) -> DataFrame:
    """``doc_id, item_id, n_words, n_tiles, n_covered, coverage, text_key`` of every leaked item of at least ``least_words`` words.

    ``text_key`` is the hash (MD5) of the document's text, by which a row can be found whatever its key.
    """
    items = written(_seeds(benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text")).distinct(),
                           "item_id long", ["item_id"], short=True).where(F.col("n_words") >= max(1, least_words)), "items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(whole_text().cast("binary")).alias("text_key"), whole_text().alias("text"))
    long_items = items.where(F.col("n_words") >= SEED_WORDS)
    item_seeds = long_items.select(F.col("row").alias("item"), F.explode(F.array_distinct("seeds")).alias("h"))
    rows = _seeds(texts, "doc_id long, text_key string", ["doc_id", "text_key"])
    shared = (rows.select("row", "doc_id", "text_key", F.posexplode("seeds").alias("pos", "h")).join(small_side(item_seeds, BROADCAST_SEEDS), "h")
              .groupBy("row", "doc_id", "text_key", "item").agg(F.collect_list(F.struct("pos", "h")).alias("places")))  # at most a document's words
    asked = small_side(long_items.select(F.col("row").alias("item"), "item_id", "n_words"))
    enough = F.size("places") >= F.ceil((coverage * F.col("n_words") - 1e-6) / SEED_WORDS)
    pairs = shared.join(asked, "item").where(enough).join(_bounded(long_items.select(F.col("row").alias("item"), "seeds"), "seeds"), "item")
    pairs = pairs.select("doc_id", "text_key", "places", "item_id", "seeds", "n_words")

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            mod = 1 << 64
            found = [tiles(sorted((x["pos"], x["h"] % mod) for x in places), [h % mod for h in seeds])
                     for places, seeds in zip(batch["places"].to_pylist(), batch["seeds"].to_pylist())]
            return pa.record_batch([batch["doc_id"], batch["text_key"], batch["item_id"], batch["n_words"], pa.array(map(len, found), pa.int64()),
                                    pa.array([sum(t[2] for t in f) for f in found], pa.int64())],
                                   names=["doc_id", "text_key", "item_id", "n_words", "n_tiles", "n_covered"])
        return fn

    tiled = map_rows(pairs, start, "doc_id long, text_key string, item_id long, n_words long, n_tiles long, n_covered long")
    for k in sorted(r[0] for r in items.where(F.col("n_words") < SEED_WORDS).select("n_words").distinct().collect()):  # at most four lengths
        tiled = tiled.unionByName(_short_leaks(texts, items.where(F.col("n_words") == k), k))
    return tiled.withColumn("coverage", F.col("n_covered") / F.col("n_words")).where(F.col("coverage") >= coverage)


def _short_leaks(texts: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The finds of ``items`` of ``k`` words, fewer than a seed: one tile, the whole item in place."""
    rows = _seeds(texts, "doc_id long, text_key string", ["doc_id", "text_key"], k)
    asked = items.select("item_id", "n_words", F.get("seeds", F.lit(0)).alias("h"))
    found = rows.select("doc_id", "text_key", F.explode(F.array_distinct("seeds")).alias("h")).join(small_side(asked), "h")
    return found.select("doc_id", "text_key", "item_id", "n_words", F.lit(1).cast("long").alias("n_tiles"), F.col("n_words").alias("n_covered"))


def _bounded(df: DataFrame, lists: str) -> DataFrame:
    """``df`` with a broadcast hint if its ``lists`` of numbers hold at most ``BROADCAST_SEEDS`` in all (counted)."""
    return F.broadcast(df) if (df.agg(F.sum(F.size(lists) + 1)).first()[0] or 0) <= BROADCAST_SEEDS else df


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least_words: int = SEED_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text leaks no item of at least ``least_words`` words."""
    leaked = written(leaks(docs, benchmark, coverage, least_words).select("text_key").distinct(), "leaked")
    return docs.join(small_side(leaked), F.md5(whole_text().cast("binary")) == leaked["text_key"], "left_anti")
