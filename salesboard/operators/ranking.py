"""Top-k rankings with explicit tie rules, positions, tiers and sorts.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only ``k x tasks`` rows reach the final merge, so a
ranking never moves the whole table.  The tie-collapse rule takes the k best
distinct amounts first (a hash aggregate of numbers), then the ids of the
shops with those k amounts alone, by a semi join against k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesboard.session import ensure_checkpoint_dir

# --- fixed values -----------------------------------------------------------
RANKING_SIZE = 5                       # entries in the served ranking
RANK_DISPLAY_CAP = 6                   # the page shows at most 6 rows
TIERS = ("gold", "silver", "bronze")   # marks for ranks 1, 2, 3
# --- end of fixed values ----------------------------------------------------

TIE_RULES = ("collapse", "all")


def top_shops(shop_amt: DataFrame, k: int = RANKING_SIZE, ties: str = "collapse",
              key: str = "shop_id", amt: str = "amt") -> DataFrame:
    """Top ``k`` shops by amount, descending.

    ``ties="collapse"`` (the served rule): shops with equal amounts take one
    place; the one with the smallest id (byte order) stays, the others drop.
    ``ties="all"``: plain order by amount desc, then id asc.
    """
    if ties == "collapse":
        amounts = shop_amt.select(amt).distinct().orderBy(F.desc(amt)).limit(k)
        winners = shop_amt.join(F.broadcast(amounts), amt, "left_semi").groupBy(amt).agg(F.min(key).alias(key))
        return winners.select(key, amt).orderBy(F.desc(amt), F.asc(key)).limit(k)
    if ties == "all":
        return shop_amt.select(key, amt).orderBy(F.desc(amt), F.asc(key)).limit(k)
    raise ValueError(f"ties must be one of {TIE_RULES}, got {ties!r}")


def rank_position(top: DataFrame, amt: str = "amt", key: str = "shop_id",
                  name: str = "rank") -> DataFrame:
    """Position 1..n beside each row of an already bounded ranking (k rows)."""
    w = Window.orderBy(F.desc(amt), F.asc(key))
    return top.select(F.row_number().over(w).alias(name), *top.columns)


def rank_tier(ranked: DataFrame, rank: str = "rank", name: str = "tier") -> DataFrame:
    """Gold / silver / bronze for ranks 1-3, null below."""
    r = F.col(rank)
    tier = (F.when(r == 1, F.lit(TIERS[0])).when(r == 2, F.lit(TIERS[1]))
            .when(r == 3, F.lit(TIERS[2])))
    return ranked.withColumn(name, tier)


def rank_cap(df: DataFrame, amt: str = "amt", key: str = "shop_id",
             cap: int = RANK_DISPLAY_CAP) -> DataFrame:
    """At most ``cap`` rows, best first (what the page can show)."""
    return df.orderBy(F.desc(amt), F.asc(key)).limit(cap)


def sort_by_measure(df: DataFrame, measure: str, ascending: bool = False,
                    tie: str | None = None) -> DataFrame:
    """Distributed sort (range partitioning) by one measure, optional tie key."""
    order = [F.asc(measure) if ascending else F.desc(measure)]
    if tie:
        order.append(F.asc(tie))
    return df.orderBy(*order)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Bounded top-k (``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(k)


def rank_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                   name: str = "rank") -> DataFrame:
    """``row_number()`` within groups, safe when one group holds a third of the rows.

    A window partitioned by the group key would sort a hot group in one task.
    Here the rows are range-partitioned on ``(group, order)`` -- a hot group
    spreads over many tasks -- and each row's position is its offset in its
    task plus the rows of its group in earlier tasks.  The per-(task, group)
    counts are small (at most groups + tasks rows).  ``order`` must be a total
    order (end it with a unique key) so positions are deterministic.  The
    sorted rows are checkpointed so both passes see the same partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(g) for g in group]
    s = (df.orderBy(*keys, *order)
         .select("*", F.spark_partition_id().alias("_p"),
                 F.monotonically_increasing_id().alias("_m"))
         .checkpoint())
    firsts = s.groupBy("_p", *group).agg(F.min("_m").alias("_m0"), F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_p")
    firsts = firsts.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))
    f = firsts.select(F.col("_p").alias("_fp"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                      "_m0", "_before")
    cond = F.col("_p") == F.col("_fp")
    for i, g in enumerate(group):          # null-safe: a null group is a group too
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = s.join(f, cond)
    pos = (F.col("_before") + F.col("_m") - F.col("_m0") + 1).alias(name)
    return out.select(*[F.col(c) for c in df.columns], pos)
