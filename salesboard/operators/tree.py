"""Tree operators over an adjacency frame ``(node, parent, size)``.

``tree_rollup``  value = own size + sizes of all descendants
``tree_sort``    position among siblings by value, descending
``tree_flatten`` nodes except roots, with depth, leaf flag and max depth
``tree_orphans`` nodes whose parent is not in the frame

Pointers are doubled: each round adds the sums of the descendants that the pointers
reach and squares the pointers, so a tree of depth ``d`` takes ``log2(d)`` rounds and
no depth is cut.  A parent cycle raises: its pointers never end.  An orphan counts as
the child of a root that is missing (depth 1).  A null size counts as 0.

Each round is checkpointed to the shared checkpoint dir so the lineage stays flat.
Skew: sums are aggregated before they are joined (one row per node on both sides);
the pointer join has one row per node on its build side, so AQE can split a hot
parent; ranking is range-partitioned (``rank_in_groups``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.operators.ranking import rank_in_groups
from salesboard.session import ensure_checkpoint_dir


def _edges(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("parent").isNotNull()).select("node", "parent")


def tree_orphans(nodes: DataFrame) -> DataFrame:
    """``(node, parent)`` of the nodes whose parent is not in the frame."""
    known = nodes.select(F.col("node").alias("parent"))
    return _edges(nodes).join(known, "parent", "left_anti").select("node", "parent")


def _doubled(nodes: DataFrame) -> DataFrame:
    """``(node, value, depth)`` of every node, by pointer doubling.

    After round ``k`` a row holds its ``2^k``-th ancestor (null: none), the sum of
    its descendants nearer than that, and its depth as far as that.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    size = F.coalesce(F.col("size"), F.lit(0)) if "size" in nodes.columns else F.lit(0).cast("long")
    own = nodes.select("node", "parent", size.alias("value"))
    number = own.agg(F.sum("value")).schema[0].dataType
    known = own.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    cur = own.join(known, "parent", "left").select(
        "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("value").cast(number).alias("value"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")).checkpoint()
    total, reach = cur.count(), 1
    while not cur.where("up is not null").isEmpty():
        if reach >= total:
            raise ValueError("a parent cycle: some nodes have no root")
        arrived = cur.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("value").alias("below"))
        above = cur.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        cur = (cur.join(above, "up", "left").join(arrived, "node", "left")
               .select("node", F.col("up2").alias("up"),
                       (F.col("value") + F.coalesce("below", F.lit(0))).cast(number).alias("value"),
                       (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")).checkpoint())
        reach *= 2
    return cur.select("node", "value", "depth")


def tree_rollup(nodes: DataFrame) -> DataFrame:
    """``(node, value)``: own size plus the sum over all descendants."""
    return _doubled(nodes).select("node", "value")


def tree_depth(nodes: DataFrame) -> DataFrame:
    """``(node, parent, depth)`` with roots at depth 0."""
    return nodes.select("node", "parent").join(_doubled(nodes), "node").select("node", "parent", "depth")


def tree_flatten(nodes: DataFrame) -> DataFrame:
    """Every node except the roots: ``(node, parent, depth, is_leaf, max_depth)``."""
    depth = tree_depth(nodes)
    parents = _edges(nodes).select(F.col("parent").alias("node"), F.lit(False).alias("is_leaf")).distinct()
    max_depth = depth.agg(F.max("depth")).scalar()
    out = depth.where(F.col("parent").isNotNull()).join(parents, "node", "left")
    return out.select("node", "parent", "depth",
                      F.coalesce("is_leaf", F.lit(True)).alias("is_leaf"),
                      max_depth.alias("max_depth"))


def tree_sort(nodes: DataFrame) -> DataFrame:
    """``(node, parent, value, sibling_rank)``: siblings by rolled-up value, descending."""
    v = tree_rollup(nodes).join(nodes.select("node", "parent"), "node")
    return rank_in_groups(v.select("node", "parent", "value"), ["parent"],
                          [F.desc("value"), F.asc("node")], name="sibling_rank")
