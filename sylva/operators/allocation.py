"""Distribution of a class's budget over its leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def allocate(leaves: DataFrame, groups: Sequence[str], weight: str, budget: str, order: str) -> DataFrame:
    """Adds ``n``: the leaf's share of the group's budget in proportion to its weight, rounded half to even, never beyond the budget; the last leaf gets the rest.

    Leaves without weight are dropped first, so the rest always lands on a leaf that can serve it; a group without weight has no rows. Closed form
    of the sequential rule by running sums: with S the sum of rounded shares so far, n = min(budget, S) - min(budget, S before).
    """
    w = Window.partitionBy(*groups)
    ordered = w.orderBy(order)
    base = leaves.where(F.col(weight) > 0).withColumn("__t", F.sum(weight).over(w))
    raw = F.rint(F.col(budget).cast("double") * F.col(weight) / F.col("__t")).cast("bigint")
    run = base.withColumn("__raw", raw).withColumn("__s", F.sum("__raw").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.least(F.col(budget), F.col("__s") - F.col("__raw"))
    last = F.lead(F.lit(1)).over(ordered).isNull()
    return run.withColumn("n", F.when(last, F.col(budget) - before).otherwise(F.least(F.col(budget), F.col("__s")) - before).cast("bigint")).drop("__t", "__raw", "__s")


def even_split(budget: Column, parts: Column, index: Column) -> Column:
    """The share of part ``index`` (from 0) of ``parts``: the first ones get one more; null for no parts."""
    q = F.when(parts > 0, F.floor(budget / parts))
    return (q + F.when(index < budget - q * parts, 1).otherwise(0)).cast("bigint")
