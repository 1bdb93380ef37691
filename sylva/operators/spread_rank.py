"""Ranks and running sums inside groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spread_running(df: DataFrame, groups: Sequence[str], tie: Sequence[str], weight: str | None = None, *, salts: int = 64, out: str = "start") -> DataFrame:
    """Adds ``out``: the sum of ``weight`` (1 each if None) over the rows before this one in its group.

    Rows of a group are ordered by a hash of ``tie``. A group is cut by that hash into ``salts`` parts; parts are
    numbered by a window over at most ``salts`` totals, rows inside a part by a window of their own. A group
    with a third of all rows so falls to ``salts`` tasks, and no join or collect is needed beyond
    the totals. Null weights count 0. Equal ``tie`` values keep distinct, though arbitrary, places.
    """
    value = F.lit(1).cast("bigint") if weight is None else F.coalesce(F.col(weight).cast("bigint"), F.lit(0).cast("bigint"))
    base = df.withColumn("__h", F.xxhash64(*tie)).withColumn("__salt", F.pmod("__h", F.lit(salts)).cast("int")).withColumn("__w", value)
    part = Window.partitionBy(*groups, "__salt").orderBy("__h", *tie)
    inside = base.withColumn(out, F.sum("__w").over(part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__w"))
    before = Window.partitionBy(*groups).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        base.groupBy(*groups, "__salt")
        .agg(F.sum("__w").alias("__t"))
        .withColumn("__off", F.coalesce(F.sum("__t").over(before), F.lit(0).cast("bigint")))
        .select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__salt").alias("__s"), "__off")
    )
    match = F.col("__salt") == F.col("__s")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return inside.join(totals, match, "left").withColumn(out, F.col(out) + F.col("__off")).drop("__h", "__salt", "__w", "__s", "__off", *[f"__g{i}" for i in range(len(groups))])


def global_place(df: DataFrame, order: str, tie: str, *, top: int = 1 << 48, parts: int = 1024, out: str = "place") -> DataFrame:
    """Adds ``out``: the row's place, from 0, in the order of ``order`` (a hash in [0, top)), without one task that holds all rows.

    The hash's range is cut to ``parts`` equal parts; a window over their counts, at most ``parts`` rows, gives where each begins.
    """
    base = df.withColumn("__part", F.floor(F.col(order) / F.lit(top / parts)).cast("int"))
    counts = base.groupBy(F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__off", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__off")
    ranked = base.withColumn("__rn", F.row_number().over(Window.partitionBy("__part").orderBy(order, tie)) - 1)
    return ranked.join(F.broadcast(before), F.col("__part") == F.col("__p")).withColumn(out, F.col("__off") + F.col("__rn")).drop("__part", "__p", "__off", "__rn")
