"""Per-key results without imbalance: multi-level tree aggregation.

Rows are cut into chunks of about ``chunk_rows`` by a hash of columns that tell rows apart, each chunk combines its rows per key, and states merge
in rounds of ``fan_in`` chunks until one is left. A key with a third of all rows so reaches its last reducer as at most
``fan_in`` states, whatever the number of input tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import written


@dataclass(frozen=True)
class TreeParams:
    """Rows of a chunk at the leaves of the tree and ``fan_in`` of each round: ceil(log(rows / chunk_rows) / log(fan_in)) rounds of merging.

    ``chunks`` fixes their number instead, which saves counting the rows; counting costs nothing where the input is a written table.
    """

    chunk_rows: int = 262_144
    fan_in: int = 16
    mantissa_bits: int = 10
    chunks: int | None = None


#: How partial states of an aggregate merge.
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def tree_aggregate(df: DataFrame, keys: Sequence[str], spread: Sequence[str], aggs: dict[str, tuple[str, Column]], params: TreeParams = TreeParams()) -> DataFrame:
    """``aggs``: output name -> (merge, column) with merge one of ``sum``, ``min``, ``max``.

    ``spread`` are the columns whose hash picks the chunk. Null keys form a group like any other; nulls in an aggregated
    column are ignored, a group of only nulls gives null. An empty table gives no rows.
    """
    chunks = max(1, params.chunks or -(-df.count() // params.chunk_rows))
    state = df.withColumn("__chunk", F.pmod(F.xxhash64(*spread), F.lit(chunks)).cast("int")).groupBy(*keys, "__chunk").agg(*[MERGE[m](c).alias(name) for name, (m, c) in aggs.items()])
    while chunks > 1:
        chunks = math.ceil(chunks / params.fan_in)
        state = state.withColumn("__chunk", F.floor(F.col("__chunk") / F.lit(params.fan_in)).cast("int")).groupBy(*keys, "__chunk").agg(*[MERGE[m](F.col(name)).alias(name) for name, (m, _) in aggs.items()])
    return state.drop("__chunk")


def length_bin(col: str, bits: int) -> Column:
    """A bin number that rises with the value: its binary exponent, then ``bits`` bits of mantissa; the sign is kept."""
    a = F.abs(F.col(col).cast("decimal(38,0)")).cast("double")
    e = F.when(a < 1, F.lit(0)).otherwise(F.floor(F.log2(a)).cast("int"))
    mantissa = F.floor((a / F.pow(F.lit(2.0), e.cast("double")) - 1) * F.lit(float(1 << bits))).cast("int")
    size = F.when(a < 1, F.lit(0)).otherwise((e + 1) * F.lit(1 << bits) + F.greatest(F.lit(0), mantissa))
    return F.when(F.col(col) < 0, -size).otherwise(size).cast("int")


def tree_median(df: DataFrame, keys: Sequence[str], value: str, spread: Sequence[str], params: TreeParams = TreeParams()) -> DataFrame:
    """Exact median per key (the mean of the middle two for even counts), as ``(keys, median)``; nulls in ``value`` are ignored.

    Equal values of a key become one row with a count, merged in the tree like any other state, so a value that most rows of a key share is no hot
    key either; these counts are written once. They are grouped by a bin of the value (at most about 64 x 2^mantissa_bits bins a key);
    a window over the bins' counts finds the bin with the middle, a window inside each bin the value. No task sees more of a key than its
    bins or one bin's distinct values.
    """
    counted = written(tree_aggregate(df.where(F.col(value).isNotNull()), [*keys, value], spread, {"__n": ("sum", F.lit(1).cast("bigint"))}, params))
    counted = counted.withColumn("__bin", length_bin(value, params.mantissa_bits))
    rows = lambda w: F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    bins = (
        counted.groupBy(*keys, "__bin")
        .agg(F.sum("__n").alias("__n"))
        .withColumn("__before", rows(Window.partitionBy(*keys).orderBy("__bin")))
        .withColumn("__all", F.sum("__n").over(Window.partitionBy(*keys)))
        .where((F.col("__before") <= F.expr("__all div 2")) & (F.col("__before") + F.col("__n") > F.expr("(__all - 1) div 2")))
        .select(*[F.col(k).alias(v) for k, v in names.items()], F.col("__bin").alias("__b"), "__before", "__all")
    )
    on = F.col("__bin") == F.col("__b")
    for k, v in names.items():
        on = on & F.col(k).eqNullSafe(F.col(v))
    inside = counted.join(bins, on).withColumn("__from", F.col("__before") + rows(Window.partitionBy(*keys, "__bin").orderBy(value)))
    middle = lambda rank: F.max(F.when((F.col("__from") <= rank) & (F.col("__from") + F.col("__n") > rank), F.col(value)))
    return inside.groupBy(*keys).agg(((middle(F.expr("(__all - 1) div 2")).cast("double") + middle(F.expr("__all div 2")).cast("double")) / 2).alias("median"))
