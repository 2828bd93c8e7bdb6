"""An ordered index of the best shops, kept up as amounts change.

The index holds every shop whose amount is at least ``floor`` (``None``: every
shop).  A batch brings the new amounts of the shops it touched; merging them by
key keeps the rule, since no other amount moved.  The ranking is therefore exact
as long as the index holds ``k`` distinct amounts.

* It grows past twice ``keep`` distinct amounts: the floor rises to the
  ``keep``-th best, and what lies below leaves.
* Decreases leave fewer than ``k``: the index is filled again from all shops --
  the one case in which more than the touched shops is read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesboard.operators.ranking import RANKING_SIZE

#: Distinct amounts that the index keeps at least once it has a floor.
KEEP = 64


def newest_amounts(before: DataFrame, changed: DataFrame, keys=("key",), amt: str = "amt") -> DataFrame:
    """``before`` with the amounts of ``changed`` in place of its own, and the keys it lacks."""
    both = before.select(*keys, amt, F.lit(0).alias("_v")).unionByName(changed.select(*keys, amt, F.lit(1).alias("_v")))
    return both.groupBy(*keys).agg(F.max_by(amt, "_v").alias(amt))


def best_amounts(shops: DataFrame, n: int, amt: str = "amt") -> list[Decimal]:
    """The ``n`` best distinct amounts (at most ``n`` numbers reach the driver)."""
    return [r[0] for r in shops.select(amt).distinct().orderBy(F.desc(amt)).limit(n).collect()]


def advance(index: DataFrame, floor: Decimal | None, changed: DataFrame, everything: Callable[[], DataFrame],
            k: int = RANKING_SIZE, keep: int = KEEP) -> tuple[DataFrame, Decimal | None, bool]:
    """``(index, floor, filled again)`` after ``changed`` (``key, amt``: the new amounts of touched shops).

    ``everything`` gives all shops as they were before ``changed``; it is called
    only if the index has to be filled again.
    """
    keep = max(keep, k)
    merged = newest_amounts(index, changed)
    merged = merged.where(F.col("amt") >= F.lit(floor)) if floor is not None else merged
    amounts = best_amounts(merged, 2 * keep + 1)
    again = floor is not None and len(amounts) < k
    if again:
        merged, floor = newest_amounts(everything(), changed), None
        amounts = best_amounts(merged, 2 * keep + 1)
    if len(amounts) > 2 * keep:
        floor = amounts[keep - 1]
        merged = merged.where(F.col("amt") >= F.lit(floor))
    return merged, floor, again
