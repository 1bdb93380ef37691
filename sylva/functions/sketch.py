"""Bottom-k sketches and the similarities read from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.functions.sequence import chunks, windows

#: Identity bins, highest first.
ANI_BINS = ((0.95, "ANI>=95%"), (0.90, "ANI 90-95%"), (0.85, "ANI 85-90%"))
ANI_REST = "ANI<85%"


def crc_hash(w: Column) -> Column:
    return F.crc32(w.cast("binary"))


def md5_hash(w: Column) -> Column:
    """The hash that SQL engines without crc32 can compute as well."""
    return F.conv(F.substring(F.md5(w.cast("binary")), 1, 12), 16, 10).cast("bigint")


def bottom_k(df: DataFrame, keys: list[str], seq: str, k: int = 21, size: int = 200, hash_: Callable[[Column], Column] = crc_hash) -> DataFrame:
    """``keys, sketch``: the ``size`` least distinct window hashes of each key, sorted.

    Long sequences are cut to chunks, every chunk is reduced to its own bottom ``size`` before the shuffle, and these are merged;
    so a key with a third of all bases passes on at most ``size`` hashes a chunk. Sequences shorter than k give an empty sketch, null ones too.
    """
    cut = df.select(*keys, F.explode_outer(chunks(seq, k)).alias("__c"))
    part = cut.select(*keys, F.slice(F.array_sort(F.array_distinct(F.transform(windows(F.coalesce("__c", F.lit("")), k), hash_))), 1, size).alias("__s"))
    # hashes as rows: the partial aggregate per task keeps distinct ones only
    rows = part.select(*keys, F.explode_outer("__s").alias("__h")).groupBy(*keys, "__h").agg(F.lit(1).alias("__x"))
    return rows.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list("__h")), 1, size).alias("sketch"))


def jaccard(a: Column | str, b: Column | str, size: int = 200) -> Column:
    """Share of the ``size`` least hashes of the union that both hold; 0 if either sketch is empty."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    merged = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    both = F.size(F.array_intersect(F.array_intersect(a, b), merged))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(merged))


def ani_proxy(j: Column | str, k: int = 21) -> Column:
    """1 + ln(2j / (1 + j)) / k within [0, 1]; 0 where j is not positive."""
    j = F.col(j) if isinstance(j, str) else j
    return F.when(j <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) + F.ln(F.lit(2.0) * j / (F.lit(1.0) + j)) / F.lit(float(k)))))


def ani_bin(ani: Column | str) -> Column:
    ani = F.col(ani) if isinstance(ani, str) else ani
    out = None
    for low, name in ANI_BINS:
        out = F.when(ani >= low, name) if out is None else out.when(ani >= low, name)
    return out.otherwise(ANI_REST)
