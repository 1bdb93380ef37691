"""Current rows: one row per key, by the greatest ordering value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of each key's row with the greatest ``order``, as one hash aggregate with map-side combine.

    Rows that tie on ``order`` count as equal; where they differ after all the greatest values win, so
    the result doesn't depend on the order of rows. A null in ``order`` comes before everything. Null keys
    form one group of their own. An empty table gives an empty result; other columns aren't read.
    """
    state = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    best = df.groupBy(*keys).agg(F.max(state).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.v{i}").alias(c) for i, c in enumerate(values)])
