"""Identifiers, digests and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def virtual_id(parent: Column | str, purpose: Column | str) -> Column:
    """A 16-digit id: 9, then the first 15 hex digits of sha256(parent:purpose) as a number modulo 10^15."""
    digest = F.substring(F.sha2(F.concat_ws(":", _col(parent), _col(purpose)).cast("binary"), 256), 1, 15)
    number = F.conv(digest, 16, 10).cast("decimal(20,0)") % F.lit(10**15).cast("decimal(20,0)")
    return F.concat(F.lit("9"), F.lpad(number.cast("string"), 15, "0"))


def path_name(name: Column | str) -> Column:
    """A name as a path component: blanks and slashes become underscores."""
    return F.translate(_col(name), " /", "__")


def hash_order(seed: int, *ids: Column | str) -> Column:
    """A number to order by at random but alike in every run and engine: the first 12 hex digits of md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(i).cast("string") for i in ids]).cast("binary")), 1, 12), 16, 10).cast("bigint")
