"""Scalar functions over sequences, all inside whole-stage code generation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: IUPAC codes and their complements, in the same order.
IUPAC = "ACGTYRWSKMDHVBN"
COMPLEMENT = "TGCARYWSMKHDBVN"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq: Column | str) -> Column:
    """Upper-case reverse complement; letters outside IUPAC become N; null stays null."""
    return F.translate(F.reverse(F.regexp_replace(F.upper(_col(seq)), f"[^{IUPAC}]", "N")), IUPAC, COMPLEMENT)


def windows(seq: Column | str, k: int) -> Column:
    """Array of all substrings of length k; empty if the sequence is shorter, or null."""
    s = _col(seq)
    n = F.length(s) - F.lit(k - 1)
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda p: F.substr(s, p, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def chunks(seq: Column | str, k: int, size: int = 1 << 16) -> Column:
    """Overlapping chunks so that each window of length k lies in exactly one: a long sequence becomes many rows before its windows are listed."""
    s = _col(seq)
    last = F.greatest(F.lit(0), F.floor((F.length(s) - F.lit(k)) / F.lit(size)).cast("int"))
    return F.when(s.isNotNull(), F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(s, i * F.lit(size) + 1, F.lit(size + k - 1)))).otherwise(F.array().cast("array<string>"))


def is_pure(seq: Column | str) -> Column:
    return F.coalesce(_col(seq).rlike("^[ACGT]+$"), F.lit(False))


def gc_fraction(seq: Column | str) -> Column:
    """(G + C) / length; null for the empty sequence."""
    s = _col(seq)
    return F.when(F.length(s) > 0, F.regexp_count(s, F.lit("[GC]")) / F.length(s))


def percent_slice(seq: Column | str, start: Column, end: Column) -> Column:
    """Characters floor(len * start) to floor(len * end)."""
    s = _col(seq)
    lo, hi = F.floor(F.length(s) * start).cast("int"), F.floor(F.length(s) * end).cast("int")
    return F.substr(s, lo + 1, F.greatest(hi - lo, F.lit(0)))


def leaf_weight(length: Column | str, k: int) -> Column:
    """Number of windows of length k."""
    return F.greatest(F.lit(0), F.coalesce(_col(length), F.lit(0)) - F.lit(k - 1)).cast("bigint")


def kmer_vocabulary(spark: SparkSession, k: int) -> DataFrame:
    """All 4^k k-mers; k at most 8, so at most 65,536 rows."""
    if not 1 <= k <= 8:
        raise ValueError("k must be from 1 to 8")
    return spark.createDataFrame([("".join(p),) for p in product("ACGT", repeat=k)], "kmer string")
