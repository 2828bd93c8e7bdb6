r"""Substring deduplication by recompression.

A text is a sequence of word symbols.  Every round splits the symbols into left
and right ones and names each pair of a left and a right neighbour as one new
symbol; a symbol never pairs with itself, so a run of equal symbols stays in its
parts and is named alike wherever it occurs.  A name is a 64-bit hash of what it
names, so all tasks agree on it without exchange, and whether a boundary survives
a round depends on the two symbols beside it alone.  Inside a window of
``WINDOW`` words the boundaries that outside words cannot touch are therefore the
same wherever that window occurs: each window takes as its anchor the first such
boundary of the highest round that leaves room for ``KEY_WORDS`` words.

Spark rounds:

1. of equal texts (128-bit hash) the smallest document stands for all: every window
   of the others also starts in it, so they lose all words or, below ``WINDOW`` words, none;
2. the least and greatest text of each anchor name are found over the corpus
   (pre-aggregated; one row per name): a name of a single text repeats nothing;
3. anchors whose name is shared are joined back: only their windows can repeat;
4. those windows are hashed whole (96 bits), the smallest document of each is found,
   and windows that also start in a smaller document are joined back to their rows.

Edge cases: a null text has no words; texts below ``WINDOW`` words keep all of
them; repeated rows of one document never remove from each other; rows without a
key neither remove nor lose words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import map_rows, release, whole_text, written

#: Words of a repeated window; naming rounds; words of an anchor's name.
WINDOW, ROUNDS, KEY_WORDS = 13, 5, 6


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(symbols: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, key_words: int = KEY_WORDS) -> np.ndarray:
    """The anchor (a word's place) of every window of a text; it depends on the window's own words alone."""
    n, m = len(symbols), len(symbols) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    first = np.arange(m)
    low, high, anchor = first.copy(), first + window, first.copy()  # boundaries sure on either side
    starts, names = np.arange(n + 1), symbols  # where symbols start (and the text's end), and their names
    for r in range(1, rounds + 1):
        index = np.zeros(n + 1, np.int64)
        index[starts] = np.arange(len(starts))
        left = np.append((_mix(names + np.uint64(r * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(1)).astype(bool), True)
        inside = low < high
        # a left symbol cannot join what stands before it, a right one cannot join what follows
        at = index[low]
        low = np.where(inside & ~left[at], starts[np.minimum(at + 1, len(starts) - 1)], low)
        at = index[high] - 1
        high = np.where(inside & left[at], starts[at], high)
        anchor = np.where((low < high) & (low + key_words <= first + window), low, anchor)
        paired = left[:-2] & ~left[1:-1]
        j = np.nonzero(paired)[0]
        names = names.copy()
        names[j] = _mix(names[j] * np.uint64(31) + names[j + 1])
        stays = np.append(np.append(True, ~paired), True)
        starts, names = starts[stays], names[stays[:-1]]
    return anchor


def rolling(symbols: np.ndarray, k: int, step: int) -> np.ndarray:
    """A hash of every ``k`` consecutive symbols."""
    n = len(symbols) - k + 1
    out = np.zeros(max(0, n), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(step) + symbols[j:j + n]
    return _mix(out)


#: Bytes that a task hashes at a time, and the longest word whose hash is a polynomial of its bytes.
BLOCK, POLYNOMIAL_BYTES = 1 << 20, 256
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))


@cache
def _powers(base: int) -> np.ndarray:
    """``base ** k`` modulo 2**64 for every place of a block."""
    return np.cumprod(np.append(np.uint64(1), np.full(BLOCK + POLYNOMIAL_BYTES, base, np.uint64)))


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``at, symbols``: a 64-bit hash of every word; ``at[k]:at[k + 1]`` are the words of text ``k``.

    A word's hash is a polynomial of its bytes, read from running sums over a block
    of bytes; longer words, for which polynomials modulo 2**64 are weak, are hashed one by one.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    in_word = np.concatenate([[False], ~_BLANK[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(in_word[1:-1] & (~in_word[:-2] | edge[:-1]))
    ends = np.flatnonzero(in_word[1:-1] & (~in_word[2:] | edge[1:])) + 1
    symbols = np.zeros(len(starts), np.uint64)
    long = ends - starts > POLYNOMIAL_BYTES
    short_ends = np.where(long, starts, ends)
    block_at = np.searchsorted(starts, np.arange(0, len(data) + BLOCK, BLOCK))
    for i, j in zip(block_at, block_at[1:]):
        if i < j:
            begin, end = starts[i], max(short_ends[i:j].max(), starts[j - 1])
            sums = np.append(np.uint64(0), np.cumsum(_BYTE[data[begin:end]] * _powers(_BASE)[:end - begin]))
            s, e = starts[i:j] - begin, short_ends[i:j] - begin
            symbols[i:j] = _mix((sums[e] - sums[s]) * _powers(pow(_BASE, -1, 1 << 64))[s] + (e - s).astype(np.uint64))
    for k in np.flatnonzero(long):
        symbols[k] = xxhash.xxh64_intdigest(data[starts[k]:ends[k]].tobytes())
    return np.searchsorted(starts, offsets), symbols


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ``at`` and symbols of stretches of a batch of about ``4 * BLOCK`` bytes (one longer text is a stretch of its own)."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    k = 0
    while k < len(texts):
        end = max(k + 1, int(np.searchsorted(size, size[k] + 4 * BLOCK, side="right")) - 1)
        yield k, *word_symbols(texts.slice(k, end - k))
        k = end


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, ref``: equal texts share their ``ref``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return d.withColumn("ref", F.xxhash64("text"))


def _inside(at: np.ndarray) -> np.ndarray:
    """The places at which a window of one text starts, where texts stand one after the other."""
    return np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b - WINDOW + 1) for a, b in zip(at, at[1:]))])


def _anchor_rows(batches: Iterator[pa.RecordBatch], names_only: bool = False) -> Iterator[pa.RecordBatch]:
    """``key, ref, at``: an anchor's name and the windows it stands for (first window, and their number in the low byte).

    With ``names_only`` without ``at``, which counting does not need.

    The texts of a stretch are worked on as one sequence: an anchor depends on its
    window alone, and windows across two texts are left out.
    """
    for batch in batches:
        refs = batch["ref"].to_numpy()
        for k, ends, symbols in _slices(batch["text"]):
            windows = _inside(ends)
            if len(windows):
                places = anchors(symbols)[windows]
                text = np.repeat(np.arange(len(ends) - 1), np.maximum(0, np.diff(ends) - WINDOW + 1))
                new = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (text[1:] != text[:-1])))
                key = rolling(symbols, KEY_WORDS, 0x9E3779B97F4A7C15)[places[new]]
                columns = [pa.array(key.view(np.int64)), pa.array(refs[k + text[new]])]
                if names_only:
                    yield pa.record_batch(columns, names=["key", "ref"])
                    continue
                count = np.diff(np.append(new, len(places)))
                at = windows[new] - ends[text[new]]
                yield pa.record_batch([*columns, pa.array(at << 8 | count)], names=["key", "ref", "at"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``h, e, doc_id, ref, pos`` of the candidate windows of each text (``h`` and ``e``: 64 and 32 bits of hash)."""
    for batch in batches:
        refs, ids, held = batch["ref"].to_numpy(), batch["doc_id"].to_numpy(zero_copy_only=False), batch["places"]
        for k, at, symbols in _slices(batch["text"]):
            n = len(at) - 1
            runs = held.slice(k, n)
            flat, counts = runs.flatten().to_numpy(), pc.list_value_length(runs).to_numpy()
            text = np.repeat(np.repeat(np.arange(n), counts), flat & 255)
            ends = np.cumsum(flat & 255)
            place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - (flat & 255), flat & 255) + np.repeat(flat >> 8, flat & 255)
            place = place[place <= np.diff(at)[text] - WINDOW] + at[text[place <= np.diff(at)[text] - WINDOW]]
            text = np.searchsorted(at, place, side="right") - 1
            h, e = (rolling(symbols, WINDOW, step)[place] for step in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array((e >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(ids[k + text]), pa.array(refs[k + text]),
                                   pa.array((place - at[text]).astype(np.int32))], names=["h", "e", "doc_id", "ref", "pos"])


def repeats(docs: DataFrame) -> DataFrame:
    """``ref, doc_id, copy, places array<int>`` of the rows that lose words, one row for each text of a document.

    ``copy`` rows have a text that a document with a smaller key has too; ``places`` are the windows of
    the other rows that also start in a document with a smaller key.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs).where("doc_id is not null")
    rows = written(keyed.select("ref", F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"), "doc_id"), "rows")
    firsts = written(rows.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.first("ref").alias("ref")), "first-of-texts")
    copies = rows.join(firsts.where("first < last").select("text_key", "first"), "text_key").where("doc_id > first").select("ref", "doc_id").distinct()
    names = keyed.select("ref", "text").mapInArrow(partial(_anchor_rows, names_only=True), "key long, ref long")
    shared = written(names.groupBy("key").agg(F.min("ref").alias("a"), F.max("ref").alias("b")).where("a < b").select("key"), "shared-names")
    del names
    release(spark)
    marked = keyed.select("ref", "text").mapInArrow(_anchor_rows, "key long, ref long, at long")
    # windows by text, at most a text's own: copies give the same ones
    places = marked.join(shared, "key").groupBy("ref").agg(F.collect_set("at").alias("places"))
    places = written(places.join(firsts.select("ref", F.col("first").alias("doc_id")), "ref"), "candidates")
    del marked
    release(spark)
    held = keyed.select("ref", "doc_id", "text").join(places, ["ref", "doc_id"]).mapInArrow(_windows, "h long, e int, doc_id long, ref long, pos int")
    held = written(held, "windows")
    release(spark)
    least = held.groupBy("h", "e").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("h", "e", "first")
    least = written(least, "first-documents")
    release(spark)
    found = held.join(least, ["h", "e"]).where("doc_id > first").groupBy("ref", "doc_id").agg(F.collect_set("pos").alias("places"))
    found = written(found.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True), "repeats")
    release(spark)
    return found


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row: the words no repeated window covers, joined by a space."""
    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for t, places, copy in zip(batch["text"], batch["places"], batch["copy"]):
                words = t.as_py().encode().split()
                if copy.as_py():
                    whole = len(words) >= WINDOW
                    out.append((len(words), len(words) if whole else 0, "" if whole else b" ".join(words).decode()))
                    continue
                drop = np.zeros(len(words) + 1, np.int64)
                if places.is_valid:
                    p = places.values.to_numpy()
                    np.add.at(drop, p, 1)
                    np.add.at(drop, p + WINDOW, -1)
                gone = np.cumsum(drop)[:-1] > 0
                out.append((len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone) if not g] if gone.any() else words).decode()))
            n, removed, text = zip(*out) if out else ((), (), ())
            return pa.record_batch([batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.string())],
                                   names=["doc_id", "n_words", "n_removed", "kept_text"])
        return fn

    rows = _keyed(docs).join(repeats(docs), ["ref", "doc_id"], "left").select("doc_id", "text", "places", "copy")
    return map_rows(rows, start, "doc_id long, n_words long, n_removed long, kept_text string")

