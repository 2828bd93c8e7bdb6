"""Best-fit packing of documents into token sequences, planned on the length histogram.

1. ``write_pieces`` encodes every document once, closes it with the end id, cuts
   only what is longer than a sequence and writes the pieces.  A task numbers its
   pieces of each length; the numbers before the task's come from the small table
   of counts by task and length, so every piece has a rank within its length
   without a sort or window over pieces.
2. ``plan`` runs best-fit decreasing over *counts*: all pieces of one length meet
   all open sequences of one remaining room at once.  The histogram has at most one
   entry a length and the open sequences at most one list a remaining room, so
   planning costs the same for a thousand pieces or a billion.
3. ``slots`` joins the pieces to the planned runs on their length and takes the
   place that their rank within the length gives.

Sequences are gapless from offset 0.  The written pieces are what later steps
read, so numbers by task hold even if an executor is lost and a task reruns.

Edge cases: a null text is empty and packs its end id alone; repeated rows, rows
that share a key and rows without one are each packed; a text of any length is
encoded whole; an empty table gives no piece and no sequence; further columns of
any name are ignored.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesboard.llm.common import no_collection, whole_text
from salesboard.llm.encoding import RawIds

END_ID = 1
SEQUENCE_IDS = 4096

PIECES = "doc_id long, place long, part int, nth long, piece long, start long, length int, ids binary"
RUNS = "length int, first long, pieces long, each long, sequence_id long, offset long"


# --- planning -------------------------------------------------------------------

def plan(counts: dict[int, int], size: int = SEQUENCE_IDS) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram ``{length: pieces}``.

    Runs ``(length, first, pieces, each, sequence_id, offset)``: the pieces of
    ``length`` with ranks ``first .. first + pieces - 1`` go ``each`` to a sequence,
    one after the other from ``offset``, into consecutive sequences from
    ``sequence_id`` on.  What is left of a room after a piece is the tightest room
    for the next piece of the same length, so a sequence takes all that fit.
    """
    rooms: list[int] = []  # remaining rooms of open sequences, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    runs, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, first, n = size, opened, -(-left // (size // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            if full:
                runs.append((length, rank, full * each, each, first, size - room))
                put(room - each * length, first, full)
            if rest:
                runs.append((length, rank + full * each, rest, rest, first + full, size - room))
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), n - full - bool(rest))
            rank, left = rank + full * each + rest, left - full * each - rest
    return runs


# --- pieces ---------------------------------------------------------------------

def _cut(name: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw_ids, part, place = RawIds(name, 4), TaskContext.get().partitionId(), 0
        seen = np.zeros(size + 1, np.int64)  # pieces of each length so far
        end = struct.pack("<I", END_ID)
        with no_collection():
            for batch in batches:
                keys, at = batch["doc_id"].to_pylist(), 0
                for slice_ in raw_ids.of(batch["text"]):
                    doc_id, piece, start, length, nth, ids = [], [], [], [], [], []
                    for raw in slice_:
                        data = raw + end
                        for k, a in enumerate(range(0, len(data) // 4, size)):
                            ids.append(data[4 * a:4 * (a + size)])
                            n = len(ids[-1]) // 4
                            doc_id.append(keys[at])
                            piece.append(k)
                            start.append(a)
                            length.append(n)
                            nth.append(seen[n])
                            seen[n] += 1
                        at += 1
                    n = len(ids)
                    yield pa.record_batch(
                        [pa.array(doc_id, pa.int64()), pa.array(np.arange(place, place + n) + (part << 40)), pa.array(np.full(n, part, np.int32)),
                         pa.array(nth, pa.int64()), pa.array(piece, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                         pa.array(ids, pa.binary())], names=["doc_id", "place", "part", "nth", "piece", "start", "length", "ids"])
                    place += n
    return run


def write_pieces(docs: DataFrame, path: str, name: str = "word_bpe_49k.json", size: int = SEQUENCE_IDS) -> None:
    """Encode ``docs`` (``doc_id, text``) and write their pieces of at most ``size`` ids (4 bytes each, little-endian) to ``path``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts.mapInArrow(_cut(name, size), PIECES).write.parquet(path)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, place, part, nth, piece, start, length, ids``; ``place`` names a piece."""
    return spark.read.schema(PIECES).parquet(path)


# --- slots ----------------------------------------------------------------------

def slots(spark: SparkSession, path: str, size: int = SEQUENCE_IDS) -> DataFrame:
    """``place, sequence_id, offset`` of every piece at ``path``."""
    pieces = read_pieces(spark, path).select("place", "part", "nth", "length")
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    before = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select("place", "length", (F.col("before") + F.col("nth")).alias("rank"))

    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    runs = spark.createDataFrame(plan(histogram, size), RUNS)
    # a row a length; the number of runs hangs on the lengths and rooms, both at most ``size``, and not on the pieces
    by_length = runs.groupBy("length").agg(F.collect_list(F.struct("first", "each", "sequence_id", "offset")).alias("runs"))
    run = F.array_max(F.filter("runs", lambda r: r["first"] <= F.col("rank")))
    return (ranked.join(F.broadcast(by_length), "length").withColumn("run", run)
            .select("place", F.expr("run.sequence_id + (rank - run.first) div run.each").alias("sequence_id"),
                    F.expr("run.offset + (rank - run.first) % run.each * length").alias("offset")))


def sequences(spark: SparkSession, path: str, size: int = SEQUENCE_IDS) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, doc_ids, starts, ids`` (4 bytes an id); at most ``size`` pieces each."""
    placed = read_pieces(spark, path).join(slots(spark, path, size), "place")
    held = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (placed.groupBy("sequence_id").agg(held.alias("held"))
            .select("sequence_id", F.aggregate("held.length", F.lit(0), lambda a, x: a + x).alias("length"), F.col("held.doc_id").alias("doc_ids"),
                    F.col("held.offset").alias("starts"),
                    F.aggregate("held.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids")))
