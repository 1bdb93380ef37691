"""Joins with a table of one row per key, evenly loaded although a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this part of all rows is hot; so there are at most as many hot keys, and their rows of the other table fit a broadcast.
HOT_PARTS = 10_000


def hot_keys(rows: DataFrame, key: str, parts: int = HOT_PARTS) -> DataFrame:
    """The keys that hold at least one in ``parts`` of the rows that have a key: at most ``parts`` of them, whatever the table. One hash aggregate with map-side combine."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    return counts.join(F.broadcast(total), F.col("__n") * parts >= F.col("__total")).select(key)


def hot_join(rows: DataFrame, one: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` joined with ``one`` (one row per key) on ``key``: the rows of hot keys meet a broadcast where they are, all others are shuffled.

    ``how`` is ``left`` or ``inner``; rows with a null key meet nothing and stay, unshuffled, in a left join. ``hot`` holds the hot keys, as from ``hot_keys``.
    ``rows`` is read twice, so it should be a written table. Columns must not clash.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    mark = F.broadcast(hot.select(key).distinct())
    few = F.broadcast(one.join(mark, key, "left_semi"))
    warm, cold = rows.join(mark, key, "left_semi"), rows.where(F.col(key).isNotNull()).join(mark, key, "left_anti")
    out = warm.join(few, key, how).unionByName(cold.join(one, key, how))
    if how == "left":
        out = out.unionByName(rows.where(F.col(key).isNull()).withColumns({c: F.lit(None).cast(one.schema[c].dataType) for c in one.columns if c != key}), allowMissingColumns=True)
    return out
