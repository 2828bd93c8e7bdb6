"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits, cut into two halves,
have a half that differs in at most one bit.  Every half is indexed with one bit
wildcarded, 2 x 32 variants a fingerprint; fingerprints that meet in a variant
are candidates and are verified on all 64 bits.

* Equal fingerprints are one entry from the start, so exact copies cost nothing.
* A variant's bucket is first counted (pre-aggregated).  The members of buckets
  with more than one entry are joined back; a bucket gives the links of a spanning
  forest of its verified pairs, never all pairs.
* A bucket above ``BUCKET`` entries is split again by variants of what is still
  free: the other half is cut in two, then the remaining quarter.  After that, 11
  bits are free, so a bucket cannot hold more than 2,048 entries, whatever the data.

Edge cases: null and empty texts (and white space) have fingerprint zero and link
like any other; rows with the same key are each reported; rows without a key take
the component's smallest key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import cut, map_rows, whole_text, written

SEED = 42
#: Entries of a bucket that are compared at once; also the most that the last split can leave.
BUCKET = 2048
_CHUNK = 200_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a whole text (A-Z lower-cased), majority by bit."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, _CHUNK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[k:k + _CHUNK], stops[k:k + _CHUNK])), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, row_key: Column | None = None) -> DataFrame:
    """``doc_id, fp long`` (the 64 bits as a signed number), and ``row_key`` if one is given."""
    carried = ["doc_id"] if row_key is None else ["doc_id", "row_key"]

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], np.uint64)
            return pa.record_batch([*(batch[c] for c in carried), pa.array(fp.view(np.int64))], names=[*carried, "fp"])
        return fn

    more = [] if row_key is None else [row_key.alias("row_key")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *more)
    return map_rows(rows, start, "doc_id long, row_key string, fp long" if more else "doc_id long, fp long")


# --- candidates -----------------------------------------------------------------

def _variants(part: str, bits: int) -> Column:
    """One number per wildcarded bit of the ``bits``-bit number ``part``: the bit's place above the number without the bit."""
    return F.expr(f"transform(sequence(0, {bits - 1}), b -> shiftleft(cast(b as bigint), {bits}) | ({part} & ~shiftleft(1L, b)))")


def _first_keys(fps: DataFrame) -> DataFrame:
    """``fp, key, free, free_bits``: both halves' variants, and the half that is still free."""
    low, high = "(fp & 4294967295L)", "shiftrightunsigned(fp, 32)"
    halves = [fps.select("fp", F.explode(_variants(part, 32)).alias("v")).select(
        "fp", (F.col("v") + F.lit(k << 40)).alias("key"), F.expr(free).alias("free")) for k, (part, free) in enumerate(((low, high), (high, low)))]
    return halves[0].unionByName(halves[1])


def _next_keys(rows: DataFrame, bits: int) -> DataFrame:
    """Split buckets by variants of the free part, ``bits`` wide, cut in two; the other half of it stays free.

    The new key hashes the old one with the variant: a chance collision adds a
    candidate, which the check on all bits removes.
    """
    half = bits // 2
    low, high = f"(free & {(1 << half) - 1}L)", f"shiftrightunsigned(free, {half})"
    parts = [rows.select("fp", "key", F.explode(_variants(part, half)).alias("v"), F.expr(free).alias("rest")).select(
        "fp", F.xxhash64("key", F.lit(k), "v").alias("key"), F.col("rest").alias("free")) for k, (part, free) in enumerate(((low, high), (high, low)))]
    return parts[0].unionByName(parts[1])


def _forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``(member, smallest member)`` over the connected parts of one bucket, under verified links."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= most
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            break
        label = least
    own = label != np.arange(len(fps))
    return fps[own], fps[label[own]]


def links(fps: DataFrame, most: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all those within ``most`` bits of each other."""
    if most > 3:
        raise ValueError("two halves with one wildcard find pairs of up to three bits")

    def start():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [_forest(np.sort(np.array(m, np.int64)).view(np.uint64), most) for m in batch["members"].to_pylist()]
            a, b = (np.concatenate([np.zeros(0, np.uint64), *(p[k] for p in pairs)]).view(np.int64) for k in (0, 1))
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])
        return fn

    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, free_bits, found = _first_keys(fps.repartition(n, "fp")), 32, []  # every entry becomes 64 rows: spread them first
    while True:
        sizes = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        last = free_bits <= 8
        fits = sizes if last else sizes.where(F.col("n") <= bucket)
        members = rows.join(fits.select("key").hint("merge"), "key").groupBy("key").agg(F.collect_list("fp").alias("members"))
        found.append(map_rows(members.select("members"), start, "a long, b long"))
        large = sizes.where(F.col("n") > bucket)
        if last or large.isEmpty():
            break
        rows = _next_keys(rows.join(large.select("key"), "key"), free_bits)
        free_bits //= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


# --- components -----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``node, root``: connected components of ``a, b``, the smallest node of each as root.

    Alternates the large-star and small-star steps: every node points its larger
    neighbours, then its smaller ones, at the smallest of them, until nothing
    changes.  Each round is checkpointed in the shared folder.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: (u, larger neighbour v) -> (v, least of u and its neighbours)
        least = smallest(both).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours -> the least of them
        least = smallest(large)
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _roots(prints: DataFrame, most: int) -> DataFrame:
    """``fp, first, root``: the fingerprints of ``doc_id, fp``, the smallest key of each and its component's root."""
    own = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(own.select("fp"), most))
    return cut(own.join(roots, own["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` (smallest key reachable) for every row."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    rooted = _roots(prints, most)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest key, then the smallest hash of key and text.

    Rows without a key come after those with one, and stay if nothing else is near.
    Rows that share a key are judged by their own texts.
    """
    row_key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), whole_text()).cast("binary"))
    prints = written(fingerprints(docs, shingle, row_key), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_key"), "doc_id", "row_key")
    kept = prints.join(_roots(prints, most), "fp").groupBy("root").agg(F.min(order).alias("least")).select(F.col("least.row_key").alias("__row_key"))
    sizes = prints.groupBy(F.col("row_key").alias("__row_key")).agg(F.count("*").alias("__n_rows"))
    # the caller's columns travel in one struct, so that none can meet a name used here
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row_key.alias("__row_key"), whole).join(written(kept.join(sizes, "__row_key"), "kept"), "__row_key")
    repeated = rows.where("__n_rows > 1").groupBy("__row_key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return rows.where("__n_rows = 1").select("row.*").unionByName(repeated)
