"""The hierarchy as tables: cleaned paths, nodes, ancestor closure, depths. No object tree is ever built.

``path`` columns are ``ARRAY<STRUCT<taxid, rank, name>>`` from leaf to root, as the catalogue stores them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class NoiseRules:
    """Administrative nodes to leave out: ranks (any letter case) and name patterns (any letter case, found anywhere)."""

    patterns: tuple[str, ...] = ()
    ranks: tuple[str, ...] = ()

    @staticmethod
    def of(config: Mapping) -> NoiseRules:
        """From a configuration; patterns under ``name_patterns`` or ``patterns``. Broken patterns are skipped, missing parts are permissive."""
        good = []
        for p in [*config.get("name_patterns", []), *config.get("patterns", [])]:
            try:
                re.compile(p["regex"])
                good.append(p["regex"])
            except (re.error, KeyError, TypeError):
                continue
        ranks = config.get("rank_blacklist", {}).get("ranks", []) if isinstance(config.get("rank_blacklist", {}), dict) else []
        return NoiseRules(tuple(good), tuple(str(r).lower() for r in ranks))


def is_noise(name: Column | str, rank: Column | str, rules: NoiseRules) -> Column:
    """The cheap rank test first, then one combined pattern; an empty or null name matches none."""
    by_rank = F.coalesce(F.lower(_col(rank)).isin(*rules.ranks), F.lit(False)) if rules.ranks else F.lit(False)
    if not rules.patterns:
        return by_rank
    return by_rank | F.coalesce((_col(name) != "") & _col(name).rlike("(?i)(?:" + "|".join(f"(?:{p})" for p in rules.patterns) + ")"), F.lit(False))


def explain_noise(name: Column | str, rank: Column | str, rules: NoiseRules) -> Column:
    """``rank:<rank>``, the first pattern that matches, or null."""
    out = F.when(F.coalesce(F.lower(_col(rank)).isin(*rules.ranks), F.lit(False)) if rules.ranks else F.lit(False), F.concat(F.lit("rank:"), F.lower(_col(rank))))
    for p in rules.patterns:
        out = out.when(F.coalesce((_col(name) != "") & _col(name).rlike(f"(?i){p}"), F.lit(False)), F.lit(p))
    return out


def noise_counts(df: DataFrame, name: str, rank: str, rules: NoiseRules) -> DataFrame:
    """One row: evaluated, rank_hits, name_hits."""
    by_rank = F.coalesce(F.lower(F.col(rank)).isin(*rules.ranks), F.lit(False)) if rules.ranks else F.lit(False)
    return df.agg(F.count(F.lit(1)).alias("evaluated"), F.count_if(by_rank).alias("rank_hits"), F.count_if(is_noise(name, rank, rules) & ~by_rank).alias("name_hits"))


def in_scope(path: Column | str, domain: str | None) -> Column:
    """The path holds the domain; without a domain everything is in scope, without a path nothing is if one is given."""
    if domain is None:
        return F.lit(True)
    return F.coalesce(F.exists(_col(path), lambda x: x["taxid"] == domain), F.lit(False))


def clean_path(path: Column | str, target: Column | str, rules: NoiseRules) -> Column:
    """Taxids from root to leaf without noise; the target is appended if it got lost, unless it is noise itself."""
    p = _col(path)
    noisy = lambda x: is_noise(x["name"], x["rank"], rules)
    kept = F.transform(F.filter(F.reverse(p), lambda x: ~noisy(x)), lambda x: x["taxid"])
    target_noisy = F.coalesce(F.exists(p, lambda x: (x["taxid"] == _col(target)) & noisy(x)), F.lit(False))
    return F.when(target_noisy | F.coalesce(F.array_contains(kept, _col(target)), F.lit(False)), kept).otherwise(F.array_append(F.coalesce(kept, F.array().cast("array<string>")), _col(target)))


def anchor(ids: Column | str, domain: str) -> Column:
    """Ids from root to leaf that start at the domain: cut there, or with the domain put before."""
    a = _col(ids)
    at = F.array_position(a, domain)
    return F.when(at > 0, F.slice(a, at.cast("int"), F.size(a))).otherwise(F.concat(F.array(F.lit(domain)), a))


@dataclass(frozen=True)
class Scope:
    """Routing of one domain: ``redirections`` of taxids to targets, ``default_id`` for what has no rule, labels of virtual ids."""

    domain: str
    redirections: Mapping[str, str] = field(default_factory=dict)
    default_id: str | None = None
    labels: Mapping[str, str] = field(default_factory=dict)


def redirect(ids: Column | str, scope: Scope, all_ranks: bool = False) -> Column:
    """Put a rule's target above the taxon it is for; without a rule fall back to ``[domain, default_id, last]``.

    Only paths of at least two ids that start with the domain change. The taxon looked at is the second, or with ``all_ranks`` the first
    after the domain that has a rule. A rule onto itself changes nothing. Rules are configuration, so they go into the plan as a literal map.
    """
    a = _col(ids)
    if not scope.redirections:
        rules = F.create_map().cast("map<string,string>")
    else:
        rules = F.create_map(*[F.lit(x) for pair in sorted(scope.redirections.items()) for x in pair])
    rest = F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    hit = F.get(F.filter(rest, lambda x: F.map_contains_key(rules, x)), F.lit(0)) if all_ranks else F.when(F.map_contains_key(rules, F.get(a, F.lit(1))), F.get(a, F.lit(1)))
    target = F.element_at(rules, hit)
    at = F.array_position(a, hit).cast("int")
    inserted = F.concat(F.slice(a, 1, F.greatest(at - 1, F.lit(0))), F.array(target), F.slice(a, at, F.size(a)))
    miss = a if scope.default_id is None else F.array(F.lit(scope.domain), F.lit(scope.default_id), F.element_at(a, -1))
    return F.when((F.size(a) <= 1) | (F.get(a, F.lit(0)) != scope.domain), a).when(hit.isNull(), miss).when(target == hit, a).otherwise(inserted)


def nodes(paths: DataFrame, ids: str = "ids", info: DataFrame | None = None, labels: Mapping[str, str] | None = None) -> DataFrame:
    """``node_id, parent_id, depth, rank, sci_name`` of paths from root to leaf; repeated prefixes collapse.

    ``info(taxid, rank, name)`` names nodes. Virtual ids take their label and the rank ``realm_group``; nodes without information
    the rank ``unknown`` and their id as name. A node met under several parents keeps the least.
    """
    pos = paths.where(F.size(ids) > 0).select(F.posexplode(ids).alias("depth", "node_id"), F.col(ids).alias("__p"))
    edges = pos.select("node_id", F.when(F.col("depth") > 0, F.element_at("__p", F.col("depth"))).alias("parent_id"), "depth").groupBy("node_id").agg(F.min(F.struct("depth", "parent_id")).alias("m"))
    out = edges.select("node_id", F.col("m.parent_id").alias("parent_id"), F.col("m.depth").alias("depth"))
    if info is not None:
        named = info.where("taxid is not null").groupBy("taxid").agg(F.max(F.struct("rank", "name")).alias("i"))
        out = out.join(named, out.node_id == named.taxid, "left").select("node_id", "parent_id", "depth", F.col("i.rank").alias("rank"), F.col("i.name").alias("sci_name"))
    else:
        out = out.withColumns({"rank": F.lit(None).cast("string"), "sci_name": F.lit(None).cast("string")})
    label = F.create_map(*[F.lit(x) for pair in sorted(labels.items()) for x in pair]) if labels else F.create_map().cast("map<string,string>")
    virtual = F.element_at(label, F.col("node_id"))
    return out.select("node_id", "parent_id", "depth", F.when(virtual.isNotNull(), "realm_group").otherwise(F.coalesce("rank", F.lit("unknown"))).alias("rank"), F.coalesce(virtual, "sci_name", "node_id").alias("sci_name"))


def closure(paths: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """``(key, ancestor, distance)``: every node of a path from root to leaf above its end, the end itself at distance 0.

    Full paths are known, so this is one explode; no recursion and no self-join.
    """
    return paths.select(F.col(key), F.posexplode(F.reverse(ids)).alias("distance", "ancestor")).select(key, "ancestor", "distance")


def child_counts(node_table: DataFrame) -> DataFrame:
    """``node_id, n_children, is_passthrough``: exactly one taxonomic child makes a passthrough."""
    kids = node_table.where("parent_id is not null and rank <> 'sequence'").groupBy(F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("n_children"))
    return node_table.select("node_id").join(kids, "node_id", "left").select("node_id", F.coalesce("n_children", F.lit(0)).alias("n_children"), (F.coalesce("n_children", F.lit(0)) == 1).alias("is_passthrough"))


def decidable_depth(paths: DataFrame, node_table: DataFrame, ids: str = "ids") -> DataFrame:
    """``node_id, decidable_depth``: nodes from the root down to this one, itself included, that have more or less than one child."""
    above = paths.select(F.posexplode(ids).alias("p", "node_id"), F.col(ids).alias("__ids")).select("node_id", F.slice("__ids", 1, F.col("p") + 1).alias("up")).groupBy("node_id").agg(F.min("up").alias("up"))
    flat = above.select("node_id", F.explode("up").alias("a"))
    flags = child_counts(node_table).select(F.col("node_id").alias("a"), "is_passthrough")
    return flat.join(flags, "a").groupBy("node_id").agg(F.sum(F.when(F.col("is_passthrough"), 0).otherwise(1)).alias("decidable_depth"))


def prune(paths: DataFrame, held_out: DataFrame, ids: str = "ids") -> DataFrame:
    """Paths that touch none of ``held_out(taxid)``; the key of a path must be in column ``taxid``."""
    hit = paths.select("taxid", F.explode(ids).alias("__a")).join(held_out.select(F.col("taxid").alias("__a")).distinct(), "__a", "left_semi").select("taxid").distinct()
    return paths.join(hit, "taxid", "left_anti")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


#: Names accepted instead of a taxid.
SHORTCUTS = {"viruses": "10239", "bacteria": "2", "archaea": "2157", "eukaryota": "2759"}


def resolve_root(root: str, info: DataFrame | None = None) -> str | None:
    """``all`` is None; shortcuts and digits are taken as they are; else the node of that name, which must be the only one."""
    text = root.strip()
    if text.lower() == "all":
        return None
    if text.lower() in SHORTCUTS:
        return SHORTCUTS[text.lower()]
    if text.isdigit():
        return text
    hits = [] if info is None else [r["taxid"] for r in info.where(F.lower("name") == text.lower()).select("taxid").distinct().limit(2).collect()]
    if len(hits) != 1:
        raise ValueError(f"{root!r} names {len(hits) or 'no'} node(s)")
    return hits[0]
