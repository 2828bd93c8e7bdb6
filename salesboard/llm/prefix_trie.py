"""Trie over the turns of conversations, built as a burst trie.

1. A turn becomes its 128-bit id, so texts are digested before anything is
   shuffled; a conversation becomes its path, the ids one after the other.  Equal
   conversations are merged to one path with a count, the smallest id and the
   digest of all their ids.
2. The root is the first trie head: its shards are containers of suffixes, one for
   each first turn.  In rounds, a container with more than ``limit`` turns bursts:
   a head takes the turns that all its suffixes begin with (those that its least
   and its greatest path share) and its suffixes go to new containers by next turn
   id.  A round moves only suffixes of oversized containers.  Copies are merged
   before, so a container can only stay large by different continuations.
3. Containers, now of bounded size, are sorted and swept: neighbours share the
   open nodes down to their common prefix, what lies below is closed with its
   totals.  The totals of the containers are added to the heads above them.

Which turns a conversation has comes from the caller (``sequences``); ``rebuild``
makes the forked conversations of the contract.

Edge cases: null roles and texts are empty; turns are ordered by number, null
first, and turns with the same number by their id; rows without a ``conv_id``
belong to no conversation; a conversation without turns ends at the root; an
empty table has no node, not even a root; further columns are ignored.  A
conversation's turn ids (16 bytes each, not its texts) are one value of one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import small_side, written

#: Hex digits of a turn id in a path.
WIDTH = 32
#: Turns (distinct paths' remaining turns, summed) from which a container bursts.
CONTAINER_TURNS = 200_000
#: Conversation ids that one piece of an id list holds at most.
PIECE_IDS = 50_000

NO_END = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
        "heads array<string>")


# --- conversations --------------------------------------------------------------

def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns array<struct<id, n>>`` in turn order; ``n`` is the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
                    F.length(text).alias("n"))
    return (conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # nulls first
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["n"].alias("n"))).alias("turns")))


def rebuild(turns: DataFrame, every: int = 100, forks: int = 6) -> DataFrame:
    """Forked conversations: the first ``h`` turns of conversation ``c - c % every``, then the own turns after the first ``h``.

    ``h`` is ``crc32(c) % forks``.  A source has at most ``2 * every - 1`` forks, and only its first turns travel.
    """
    source = turns.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("source"), F.slice("turns", 1, forks).alias("lent"))
    own = turns.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % forks).cast("int")).withColumn("source", F.col("conv_id") - F.col("conv_id") % every)
    lent = F.coalesce(F.expr("slice(lent, 1, h)"), F.expr("slice(turns, 1, 0)"))
    return own.join(source, "source", "left").select("conv_id", F.concat(lent, F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")).alias("turns"))


# --- equal conversations ----------------------------------------------------------

def _id_pieces(most: int):
    """Runs of at most ``most`` ids of one path as text, from rows sorted by path and id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, held = None, []
        for batch in batches:
            out = []
            for p, c in zip(batch["path_key"].to_pylist(), batch["conv_id"].to_pylist()):
                if held and (p != path or len(held) == most):
                    out.append((path, held[0], ",".join(map(str, held))))
                    held = []
                path = p
                held.append(c)
            if out:
                yield _pieces(out)
        if held:
            yield _pieces([(path, held[0], ",".join(map(str, held)))])
    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    key, first, text = zip(*rows)
    return pa.record_batch([pa.array(key, pa.string()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["path_key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of a path, read one piece at a time."""
    path, sha = None, None

    def done(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["path_key", "ends"])

    for batch in batches:
        out = []
        for p, ids in zip(batch["path_key"].to_pylist(), batch["ids"].to_pylist()):
            if sha is not None and p == path:
                sha.update(b",")
            else:
                if sha is not None:
                    out.append((path, sha.hexdigest()))
                path, sha = p, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield done(out)
    if sha is not None:
        yield done([(path, sha.hexdigest())])


def paths(turns: DataFrame, most: int = PIECE_IDS) -> DataFrame:
    """``path, lengths, n, least, ends``: each distinct sequence of turns once, with the digest of its conversations' ids.

    The ids of one sequence, which may be a third of all, are range-partitioned by
    id and joined to pieces of text first; the digest itself is one pass over them.
    """
    convs = turns.select("conv_id", F.array_join("turns.id", "").alias("path"), F.col("turns.n").alias("lengths")).withColumn("path_key", F.sha2("path", 256))
    convs = written(convs, "paths")
    merged = convs.groupBy("path_key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("lengths").alias("lengths"))
    ids = convs.select("path_key", "conv_id").repartitionByRange("path_key", "conv_id").sortWithinPartitions("path_key", "conv_id")
    pieces = ids.mapInArrow(_id_pieces(most), "path_key string, first long, ids string")
    ends = pieces.repartition("path_key").sortWithinPartitions("path_key", "first").mapInArrow(_digests, "path_key string, ends string")
    return merged.join(ends, "path_key").select("path", "lengths", "n", "least", "ends")


# --- bursting -------------------------------------------------------------------

def _id_at(path: str | Column, at: Column) -> Column:
    return F.substring(path, at * WIDTH + 1, F.lit(WIDTH))


def _shared(least: str, greatest: str) -> Column:
    """Turns that two paths have in common at their beginning."""
    return F.expr(f"""coalesce(array_min(filter(sequence(0, cast(least(length({least}), length({greatest})) / {WIDTH} as int)),
        i -> i * {WIDTH} >= least(length({least}), length({greatest})) or substr({least}, i * {WIDTH} + 1, {WIDTH}) != substr({greatest}, i * {WIDTH} + 1, {WIDTH}))), 0)""")


def _contained(suffixes: DataFrame) -> DataFrame:
    """Suffixes that go on below the head that they are at, in the containers of their next turn."""
    return (suffixes.where(F.length("path") > F.col("at") * WIDTH)
            .withColumn("shard", F.md5(F.concat(F.element_at("heads", -1), _id_at("path", F.col("at"))).cast("binary"))))


def burst(merged: DataFrame, limit: int = CONTAINER_TURNS) -> tuple[DataFrame, DataFrame]:
    """``(containers, heads)`` of the distinct ``paths``.

    A container row is a suffix: the path, ``at`` (turns that heads have taken),
    ``heads`` (from the root down), ``up`` (smallest member of the head above) and
    its ``shard``.  A head is ``head, heads, at`` (turns above it), ``chain``
    (lengths of its turns), ``n, least, up, ends``.
    """
    root = (merged.agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max(F.when(F.col("path") == "", F.col("ends"))).alias("ends"))
            .where("n is not null").select(
                F.lit("").alias("head"), F.array(F.lit("")).alias("heads"), F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("chain"),
                "n", "least", F.lit(None).cast("long").alias("up"), F.coalesce("ends", F.lit(NO_END)).alias("ends")))
    heads = written(root, "trie-heads")
    columns = ["path", "lengths", "n", "least", "ends", "at", "heads", "up", "shard"]
    top = heads.first()  # the root's row, or none
    rest = _contained(merged.withColumn("at", F.lit(0)).withColumn("heads", F.array(F.lit("")))
                      .withColumn("up", F.lit(top["least"] if top else None).cast("long"))).select(columns)
    rest, settled = written(rest, "trie-containers"), None
    while True:
        large = (rest.groupBy("shard").agg(F.sum(F.size("lengths") - F.col("at")).alias("turns"), F.count("*").alias("held"))
                 .where((F.col("turns") > limit) & (F.col("held") > 1)).select("shard"))
        large = written(large, "trie-large")
        if large.isEmpty():
            return (rest if settled is None else settled.unionByName(rest)), heads
        large = small_side(large)
        small, big = rest.join(large, "shard", "left_anti").select(columns), rest.join(large, "shard", "left_semi")
        settled = small if settled is None else settled.unionByName(small)
        made = big.groupBy("shard").agg(F.min("path").alias("lo"), F.max("path").alias("hi"), F.sum("n").alias("n"), F.min("least").alias("least"),
                                        F.first("at").alias("at"), F.first("heads").alias("above"), F.first("up").alias("up"))
        made = made.withColumn("to", _shared("lo", "hi"))
        made = written(made.select("shard", "n", "least", "at", "above", "up", "to", F.md5(F.substring("lo", F.lit(1), F.col("to") * WIDTH).cast("binary")).alias("head")), "trie-made")
        moved = big.select("shard", "path", "lengths", F.col("n").alias("own_n"), F.col("least").alias("own_least"), "ends").join(small_side(made), "shard")
        moved = written(moved, "trie-moved")
        # a head has at most one path that ends at it; its turns' lengths are those of any of its paths
        ending = F.max(F.when(F.length("path") == F.col("to") * WIDTH, F.col("ends")))
        chain = F.first(F.expr("slice(lengths, at + 1, to - at)"))
        new = moved.groupBy("head", "above", "at", "n", "least", "up").agg(chain.alias("chain"), ending.alias("ends")).select(
            "head", F.concat("above", F.array("head")).alias("heads"), "at", "chain", "n", "least", "up", F.coalesce("ends", F.lit(NO_END)).alias("ends"))
        heads = heads.unionByName(written(new, "trie-heads"))
        down = moved.select("path", "lengths", F.col("own_n").alias("n"), F.col("own_least").alias("least"), "ends", F.col("to").alias("at"),
                            F.concat("above", F.array("head")).alias("heads"), F.col("least").alias("up"))
        rest = written(_contained(down).select(columns), "trie-containers")


# --- sweeping -------------------------------------------------------------------

def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers, from suffixes sorted by container and path."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "heads"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.string())]
    shard, path, top, up, heads = None, "", 0, None, None
    open_: list[list] = []  # [least, n, children, leaves, saved, ends, length] of the open nodes, from depth top + 1 on
    out: list[tuple] = []

    def close(keep: int) -> None:
        while len(open_) > keep:
            least, n, children, leaves, saved, ends, length = open_.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * length
            above = open_[-1] if open_ else None
            if above:
                # members that are not yet added to the node above are in its count already
                above[2] += 1
                above[3] += leaves
                above[4] += saved
            out.append((least, top + 1 + len(open_), (above, up), n, children, leaves, saved, ends, None if above else heads))

    def batch_of() -> pa.RecordBatch:
        rows = [(r[0], r[1], r[2][0][0] if r[2][0] else r[2][1], *r[3:]) for r in out]
        out.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if r["shard"] != shard:
                close(0)
                if len(out) > 5000:
                    yield batch_of()
                shard, path, top, up, heads = r["shard"], "", r["at"], r["up"], r["heads"]
            new, old, same = r["path"], path, top
            while same - top < len(open_) and new[same * WIDTH:(same + 1) * WIDTH] == old[same * WIDTH:(same + 1) * WIDTH]:
                same += 1
            close(same - top)
            for node in open_:
                node[0] = min(node[0], r["least"])
                node[1] += r["n"]
            for k in range(same, len(r["lengths"])):
                open_.append([r["least"], r["n"], 0, 0, 0, NO_END, r["lengths"][k]])
            open_[-1][5] = r["ends"]
            path = new
    close(0)
    if out:
        yield batch_of()


def nodes(turns: DataFrame, limit: int = CONTAINER_TURNS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every trie node.

    ``turns`` is ``conv_id, turns`` of ``sequences`` or ``rebuild``, one row a conversation.
    """
    containers, heads = burst(written(paths(turns), "trie-paths"), limit)
    swept = written(containers.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(_sweep, NODE), "trie-nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # what containers and heads add to the heads above them: a row a container and head, not a row a member
    chain = F.aggregate("chain", F.lit(0).cast("long"), lambda a, x: a + x)
    tops = swept.where("heads is not null").select("heads", F.size("heads").alias("direct"), "n_leaves", F.col("saved_tokens").alias("saved"))
    inner = heads.where("head != ''").select(F.expr("slice(heads, 1, size(heads) - 1)").alias("heads"), (F.size("heads") - 1).alias("direct"),
                                             F.lit(0).cast("long").alias("n_leaves"), ((F.col("n") - 1) * chain).alias("saved"))
    below = (tops.unionByName(inner).select("direct", "n_leaves", "saved", F.posexplode("heads").alias("level", "head"))
             .groupBy("head").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum((F.col("level") + 1 == F.col("direct")).cast("long")).alias("children")))
    h = heads.join(below, "head", "left")
    # the turns of a head's chain; the root has none and is one node of its own
    h = h.withColumn("k", F.explode(F.expr("if(head = '', array(0), sequence(1, size(chain)))")))
    last = F.col("k") == F.size("chain")
    below_k = F.aggregate(F.expr("slice(chain, greatest(k, 1), size(chain))"), F.lit(0).cast("long"), lambda a, x: a + x)
    of_heads = h.select(
        F.col("least").alias("conv_id"), (F.col("at") + F.col("k")).cast("long").alias("depth"), F.when(F.col("k") > 1, F.col("least")).otherwise(F.col("up")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.coalesce("children", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).cast("long").alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * below_k).alias("saved_tokens"), F.when(last, F.col("ends")).otherwise(F.lit(NO_END)).alias("ends_sha256"))
    return swept.select(columns).unionByName(of_heads.select(columns))
