"""Conversions and revenue of a raw visit row, chosen by the ``goals`` setting.

* ``goals == []``   -> every visit converts once, revenue 0;
* ``goals == [-1]`` -> e-commerce: one conversion per purchase, revenue is the
  sum of valid purchase revenue (millionths) in units, rounded to 2 places;
* ``goals == [ids]`` -> one conversion per goal hit whose id is listed (repeats
  count), revenue the sum of those goals' prices (thousandths), rounded to 2.

NULL groups, as writers store "none", count as empty and NULL amounts as 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A purchase revenue (in millionths) above this bound, or below
# zero, is treated as invalid and counts as 0.
MAX_VALID_PURCHASE_REVENUE = 112170000000
PURCHASE_REVENUE_SCALE = 1_000_000.0
GOAL_PRICE_SCALE = 1000.0


def _mode(goals: Sequence[int]) -> str:
    goals = list(goals)
    if not goals:
        return "each_visit"
    if goals == [-1]:
        return "purchases"
    return "goal_ids"


def conversions_expr(goals: Sequence[int], purchases="EPurchase", goal_col="Goals") -> Column:
    mode = _mode(goals)
    if mode == "each_visit":
        return F.lit(1).cast("long")
    if mode == "purchases":
        return F.coalesce(F.size(F.col(purchases)), F.lit(0)).cast("long")
    ids = [int(g) for g in goals]
    return F.coalesce(F.size(F.filter(F.col(goal_col), lambda g: g["ID"].isin(ids))), F.lit(0)).cast("long")


def revenue_expr(goals: Sequence[int], purchases="EPurchase", goal_col="Goals") -> Column:
    mode = _mode(goals)
    if mode == "each_visit":
        return F.lit(0.0)
    if mode == "purchases":
        def valid(p):
            r = F.coalesce(p["Revenue"], F.lit(0))
            x = (F.when(r < 0, F.lit(0)).when(r > MAX_VALID_PURCHASE_REVENUE, F.lit(0))
                 .otherwise(r).cast("double") / PURCHASE_REVENUE_SCALE)
            return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
        total = F.aggregate(F.transform(F.col(purchases), valid), F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(F.bround(total, 2), F.lit(0.0))
    ids = [int(g) for g in goals]
    prices = F.aggregate(F.filter(F.col(goal_col), lambda g: g["ID"].isin(ids)),
                         F.lit(0).cast("long"), lambda a, g: a + F.coalesce(g["Price"], F.lit(0)))
    return F.coalesce(F.bround(prices / GOAL_PRICE_SCALE, 2), F.lit(0.0))
