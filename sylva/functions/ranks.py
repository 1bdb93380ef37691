"""Ranks of a hierarchy: order, depth, protected and virtual ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The major ranks from the root down; the place in this list is the depth.
CANONICAL = ("superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species")

#: The rank of routing nodes, and how ranks of all other nodes made by the engine begin.
ROUTING, VIRTUAL = "realm_group", "virtual_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_depth(rank: Column | str) -> Column:
    """0 for superkingdom to 7 for species; null for anything else."""
    at = F.array_position(F.array(*[F.lit(r) for r in CANONICAL]), _col(rank))
    return F.when(at > 0, (at - 1).cast("int"))


def is_canonical(rank: Column | str) -> Column:
    return F.coalesce(_col(rank).isin(*CANONICAL), F.lit(False))


def is_protected(rank: Column | str) -> Column:
    """Made by the engine, and so never bucketed again. Null isn't."""
    return F.coalesce((_col(rank) == ROUTING) | _col(rank).startswith(VIRTUAL), F.lit(False))


def ends_recursion(rank: Column | str) -> Column:
    """Virtual nodes aren't entered; ``realm_group`` is."""
    return F.coalesce(_col(rank).startswith(VIRTUAL), F.lit(False))


def _boundary(boundary: str) -> int:
    if boundary not in CANONICAL:
        raise ValueError(f"no canonical rank: {boundary!r}")
    return CANONICAL.index(boundary)


def at_or_below(rank: Column | str, boundary: str) -> Column:
    return F.coalesce(rank_depth(rank) >= F.lit(_boundary(boundary)), F.lit(False))


def below(rank: Column | str, boundary: str) -> Column:
    return F.coalesce(rank_depth(rank) > F.lit(_boundary(boundary)), F.lit(False))
