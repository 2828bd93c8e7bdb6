"""Token-id shards with a minimal perfect hash index.

``write_store`` lays two tables under a folder.

* ``payload``: one row per shard, in ascending document order.  A shard holds
  the raw little-endian ids of its documents one after the other (2 bytes an id
  where the vocabulary allows, else 4), the document keys and, per document, the
  end of its ids.
* ``index``: one row per hash bucket of keys.  A bucket holds a minimal perfect
  hash of its keys (hash and displace: a seed per small group of keys places all
  keys of the bucket on distinct slots ``0 .. n - 1``) and, by slot, the key's
  32-bit fingerprint and the shard and row where its ids start.

A lookup reads one index row, computes one slot, compares one fingerprint and
slices one shard: constant work per key.  Tables are Parquet files, so that every
store Spark can write to will do and a rerun task commits whole files only.

Edge cases: a null text is empty (its ids are the end id alone); a document key
that occurs on several rows keeps them all, adjacent and ordered by content, and the
index gives the first; rows without a key come first and are not in the index; an
empty table gives empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesboard.llm.bpe import tokenizer
from salesboard.llm.common import no_collection, whole_text, written
from salesboard.llm.encoding import RawIds

END_ID = 1
#: A shard is closed once it holds this many ids or documents (one longer document is a shard of its own).
SHARD_IDS, SHARD_DOCS = 1_000_000, 20_000
#: Keys an index bucket holds on average, and keys that share a seed on average.
BUCKET_KEYS, SEED_KEYS = 8192, 4

PAYLOAD = "shard long, part long, width int, n_ids long, keys array<long>, ends array<long>, payload binary"
INDEX = "bucket long, n long, seeds binary, prints binary, shards binary, rows binary"


# --- minimal perfect hash -------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, so distinct keys stay distinct)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slots(mixed: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    return _mix(mixed + seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)


def build_hash(keys: np.ndarray) -> np.ndarray:
    """Seeds of a minimal perfect hash of distinct int64 keys."""
    n, mixed = len(keys), _mix(keys.view(np.uint64))
    group = mixed % np.uint64(groups := -(-n // SEED_KEYS))
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group.astype(np.int64), minlength=groups)
    starts = np.cumsum(sizes) - sizes
    seeds, free = np.zeros(groups, np.uint32), np.ones(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        members = mixed[order[starts[g]:starts[g] + sizes[g]]]
        first, step = 1, 256
        while len(members):
            tried = np.arange(first, first + step, dtype=np.uint64)
            slots = np.sort(_slots(members[None, :], tried[:, None], n).astype(np.int64), axis=1)
            fits = free[slots].all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                seeds[g], free[slots[k]] = tried[k], False
                break
            first, step = first + step, min(4 * step, 16384)
    return seeds


def hash_slots(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    mixed = _mix(keys.view(np.uint64))
    return _slots(mixed, seeds[(mixed % np.uint64(len(seeds))).astype(np.int64)], n).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(_mix(keys.view(np.uint64)) ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


# --- writing --------------------------------------------------------------------

def _encode(name: str, width: int):
    """``doc_id, h, ids`` of ``doc_id, h, text``, each document closed by the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw_ids, end = RawIds(name, width), END_ID.to_bytes(width, "little")
        with no_collection():
            for batch in batches:
                at = 0
                for slice_ in raw_ids.of(batch["text"]):
                    n = len(slice_)
                    yield pa.record_batch([batch["doc_id"].slice(at, n), batch["h"].slice(at, n), pa.array([raw + end for raw in slice_], pa.binary())],
                                          names=["doc_id", "h", "ids"])
                    at += n
    return run


def _shards(width: int, most: int):
    """Shards of the encoded documents of a partition, in its order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        ends: list[int] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal keys, ends, held, size, seq
            out = pa.record_batch([pa.array([part << 32 | seq], pa.int64()), pa.array([part], pa.int64()), pa.array([width], pa.int32()), pa.array([size], pa.int64()),
                                   pa.array([keys], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(held)], pa.binary())],
                                  names=["shard", "part", "width", "n_ids", "keys", "ends", "payload"])
            keys, ends, held, size, seq = [], [], [], 0, seq + 1
            return out

        for batch in batches:
            for key, raw in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
                held.append(raw)
                size += len(raw) // width
                keys.append(key)
                ends.append(size)
                if size >= SHARD_IDS or len(keys) >= most:
                    yield close()
        if keys:
            yield close()
    return run


def write_store(docs: DataFrame, path: str, name: str = "word_bpe_49k.json", shard_docs: int = SHARD_DOCS) -> None:
    """Encode ``docs`` (``doc_id, text``), each document closed by the end id, into a store at ``path``.

    Texts are encoded where they are read; only their ids are sorted and shuffled.
    """
    spark = docs.sparkSession
    width = 2 if tokenizer(name).n_ids <= 1 << 16 else 4
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("h"), whole_text().alias("text"))
    encoded = written(texts.mapInArrow(_encode(name, width), "doc_id long, h long, ids binary"), "encoded")
    ordered = encoded.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "ids")
    ordered.mapInArrow(_shards(width, shard_docs), PAYLOAD).write.parquet(f"{path}/payload")
    entries = (_payload(spark, path).select("shard", F.posexplode("keys").alias("row", "key")).where("key is not null")
               .groupBy("key").agg(F.min(F.struct("shard", "row")).alias("first")))
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    (entries.select("key", "first.shard", "first.row", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
     .groupBy("bucket").applyInPandas(_index_bucket, INDEX).write.parquet(f"{path}/index"))


def _index_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows["key"].to_numpy(np.int64)
    seeds = build_hash(keys)
    slots, n = hash_slots(keys, seeds, len(keys)), len(keys)
    prints, shards, places = np.zeros(n, "<u4"), np.zeros(n, "<i8"), np.zeros(n, "<i4")
    prints[slots], shards[slots], places[slots] = fingerprints(keys), rows["shard"].to_numpy(np.int64), rows["row"].to_numpy(np.int32)
    return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "n": [n], "seeds": [seeds.astype("<u4").tobytes()], "prints": [prints.tobytes()],
                         "shards": [shards.tobytes()], "rows": [places.tobytes()]})


# --- reading --------------------------------------------------------------------

def _payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload")


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``key, shard, row`` of those ``keys`` (column ``key``, taken once each) whose fingerprint is in the index."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    buckets = max(1, index.count())
    asked = keys.select(F.col("key").cast("long").alias("key")).where("key is not null").distinct()
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def find(want: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(want) or not len(have):
            return pd.DataFrame({"key": [], "shard": [], "row": []}).astype("int64")
        entry, k = have.iloc[0], want["key"].to_numpy(np.int64)
        slot = hash_slots(k, np.frombuffer(entry["seeds"], "<u4"), int(entry["n"]))
        hit = np.frombuffer(entry["prints"], "<u4")[slot] == fingerprints(k)
        return pd.DataFrame({"key": k[hit], "shard": np.frombuffer(entry["shards"], "<i8")[slot[hit]],
                             "row": np.frombuffer(entry["rows"], "<i4")[slot[hit]].astype(np.int64)})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, "key long, shard long, row long")


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``key, ids array<long>`` of the asked documents: index first, then only the shards it names."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for r in batch.to_pylist():
                raw = np.frombuffer(r["payload"], f"<u{r['width']}")
                for a in r["asked"]:
                    k = a["row"]
                    if r["keys"][k] == a["key"]:  # a fingerprint can agree by chance
                        found.append(a["key"])
                        ids.append(raw[r["ends"][k - 1] if k else 0:r["ends"][k]])
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["key", "ids"])

    asked = lookup(spark, path, keys).groupBy("shard").agg(F.collect_list(F.struct("key", "row")).alias("asked"))  # at most a shard's rows
    return _payload(spark, path).join(asked, "shard").select("width", "keys", "ends", "payload", "asked").mapInArrow(cut, "key long, ids array<long>")


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """``shard, base``: ids before each shard -- of earlier range partitions (one row each) and of earlier shards of its own."""
    shards = _payload(spark, path).select("shard", "part", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = parts.select("part", F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    own = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return shards.withColumn("own", own).join(before, "part").select("shard", (F.col("own") + F.col("part_base")).alias("base"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of shards, one shard at a time: ``row`` is where the rows of a document's key begin in its shard, ``begin`` and the rest are its own ids."""
    for batch in batches:
        for k in range(batch.num_rows):
            keys, ends = (batch[c][k].values for c in ("keys", "ends"))
            raw = np.frombuffer(batch["payload"][k].as_buffer(), f"<u{batch['width'][k].as_py()}")
            n, begins = len(keys), [0, *ends.to_pylist()]
            known, value = keys.is_valid().to_numpy(zero_copy_only=False), keys.fill_null(0).to_numpy()
            same = (known[1:] == known[:-1]) & (value[1:] == value[:-1])
            rows = np.maximum.accumulate(np.where(np.concatenate([[False], same])[:n], 0, np.arange(n)))
            crc = [zlib.crc32(raw[a:b].astype("<u4")) for a, b in zip(begins, begins[1:])]
            yield pa.record_batch([pa.array(np.repeat(batch["shard"][k].as_py(), n), pa.int64()), pa.array(rows, pa.int64()), keys, pa.array(begins[:-1], pa.int64()),
                                   pa.array(np.diff(begins), pa.int64()), pa.array(crc, pa.int64())],
                                  names=["shard", "row", "key", "begin", "n_tokens", "ids_crc32"])


def read_all(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all asked documents, and of those without a key.

    The index gives the shard and row where the ids of a key start, and the rows in
    succession from there are read if they have that key (a fingerprint can agree by
    chance); a key's rows that go on in later shards are found by the first keys of the
    shards.  Shards are cut where they are read: their ids are not shuffled, only a
    short row for each document is.
    """
    leads = _payload(spark, path).select("shard", F.element_at("keys", 1).alias("key")).where("key is not null")
    leads = F.broadcast(leads.groupBy("key").agg(F.collect_list("shard").alias("later")))  # a shard is a megabyte or thousands of documents
    later = F.transform(F.filter(F.coalesce("later", F.array().cast("array<long>")), lambda s: s > F.col("shard")), lambda s: F.struct(s.alias("shard"), F.lit(0).cast("long").alias("row")))
    asked = (lookup(spark, path, keys).join(leads, "key", "left")
             .select("key", F.explode(F.concat(F.array(F.struct("shard", "row")), later)).alias("place"))
             .select("place.shard", "place.row", "key", F.lit(True).alias("asked")))
    read = _payload(spark, path).select("shard", "width", "keys", "ends", "payload").mapInArrow(
        _places, "shard long, row long, key long, begin long, n_tokens long, ids_crc32 long")
    read = read.join(asked, ["shard", "row", "key"], "left").where("asked or key is null")  # rows without a key are in no index
    return (read.join(F.broadcast(_bases(spark, path)), "shard")
            .select(F.col("key").alias("doc_id"), (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"))
