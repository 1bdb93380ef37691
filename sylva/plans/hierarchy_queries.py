"""Queries of predicates, hierarchy, capacity and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions import ranks, sequence
from sylva.functions.ids import path_name, virtual_id
from sylva.operators import hierarchy, selection, windows
from sylva.plans import base
from sylva.plans.base import ACC, CLOSURE, INFO, LIN, NODES, PATHS, SEQ
from sylva.session import table

RULES = hierarchy.NoiseRules((r" virus sp\.$", r"^[a-d]\w+ii?a$", r"\bnecrosis\b"), ("serotype", "strain", "phylum"))
_NAME_HIT = " OR ".join(f"regexp_matches(name, '(?i){p}')" for p in RULES.patterns)
_RANK_HIT = "coalesce(lower(rank) IN ('serotype', 'strain', 'phylum'), false)"
SCOPE = hierarchy.Scope("1000", {"100500": "999001", "100501": "100501", "100502": "999002"}, "999000", {"999000": "fallback", "999001": "group one", "999002": "group two"})
DOMAIN = "1000"
K = 12


def _info(s: SparkSession, d: str) -> DataFrame:
    return base.info(s, d)


def noise_filter(s: SparkSession, d: str) -> DataFrame:
    return _info(s, d).select("taxid", hierarchy.is_noise("name", "rank", RULES).alias("is_noise"), hierarchy.explain_noise("name", "rank", RULES).alias("why"))


def noise_stats(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.noise_counts(_info(s, d), "name", "rank", RULES)


def scope_filter(s: SparkSession, d: str) -> DataFrame:
    return base.lineages(s, d).where(hierarchy.in_scope("path", DOMAIN)).select("taxid", F.size("path").alias("n"))


def pending_accessions(s: SparkSession, d: str) -> DataFrame:
    return selection.pending(base.accessions(s, d)).select("accession", "length")


def scope_pending(s: SparkSession, d: str) -> DataFrame:
    return selection.scope_pending(base.accessions(s, d), base.lineages(s, d), DOMAIN).select("accession", "taxid")


def rank_properties(s: SparkSession, d: str) -> DataFrame:
    r = _info(s, d).select("rank").unionByName(table(s, d, "label_map", ["rank"])).distinct()
    return r.select("rank", ranks.rank_depth("rank").alias("depth"), ranks.is_canonical("rank").alias("canonical"), ranks.is_protected("rank").alias("protected"), ranks.ends_recursion("rank").alias("ends"), ranks.at_or_below("rank", "family").alias("at_or_below"), ranks.below("rank", "family").alias("below"))


def clean_lineages(s: SparkSession, d: str) -> DataFrame:
    return base.lineages(s, d).select("taxid", hierarchy.clean_path("path", "taxid", RULES).alias("ids"))


def anchored_lineages(s: SparkSession, d: str) -> DataFrame:
    return clean_lineages(s, d).select("taxid", hierarchy.anchor("ids", DOMAIN).alias("ids"))


def redirected_lineages(s: SparkSession, d: str) -> DataFrame:
    return base.paths(s, d).select("taxid", hierarchy.redirect("ids", SCOPE).alias("canonical_mode"), hierarchy.redirect("ids", SCOPE, all_ranks=True).alias("all_ranks_mode"))


def redirected_nodes(s: SparkSession, d: str) -> DataFrame:
    p = base.paths(s, d).select(hierarchy.redirect("ids", SCOPE, all_ranks=True).alias("ids"))
    return hierarchy.nodes(p, "ids", _info(s, d), SCOPE.labels).groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest"))


def hierarchy_nodes(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.nodes(base.paths(s, d), "ids", _info(s, d))


def hierarchy_closure(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.closure(base.paths(s, d), "taxid")


def passthroughs(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.child_counts(hierarchy_nodes(s, d))


def decidable_depth(s: SparkSession, d: str) -> DataFrame:
    return hierarchy.decidable_depth(base.paths(s, d), hierarchy_nodes(s, d))


def pruned_lineages(s: SparkSession, d: str) -> DataFrame:
    held = _info(s, d).where("rank = 'family' and cast(taxid as bigint) % 3 = 0").select("taxid")
    return hierarchy.prune(base.paths(s, d), held).select("taxid")


def node_paths(s: SparkSession, d: str) -> DataFrame:
    names = F.transform(F.reverse("path"), lambda x: path_name(x["name"]))
    return base.lineages(s, d).select("taxid", F.array_join(names, "/").alias("path"))


def sequence_leaves(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "accessions", ["accession", "taxid", "headers", "ord", "last_update"])
    h = a.select("taxid", "ord", "accession", F.explode("headers").alias("h")).where("h.id is not null and taxid is not null").select("taxid", F.col("h.id").alias("header_id"), "ord", "accession")
    return hierarchy.first_wins(h, ["taxid", "header_id"], ["ord", "accession"]).select("taxid", "header_id", "ord")


def accession_lineages(s: SparkSession, d: str) -> DataFrame:
    return base.accessions(s, d).join(base.lineages(s, d), "taxid").select("accession", "taxid", F.element_at("path", -1)["taxid"].alias("root"))


def virtual_ids(s: SparkSession, d: str) -> DataFrame:
    return _info(s, d).select("taxid", virtual_id("taxid", F.lit("low_capacity")).alias("low_capacity"), virtual_id("taxid", F.lit("reject")).alias("reject"))


def reverse_complements(s: SparkSession, d: str) -> DataFrame:
    return base.sequences(s, d).select("header_id", sequence.reverse_complement("seq").alias("rc"))


def sequence_measures(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d)
    return q.select("header_id", F.length("seq").alias("len"), F.round(sequence.gc_fraction("seq"), 6).alias("gc"), sequence.is_pure("seq").alias("pure"), sequence.leaf_weight(F.length("seq"), 100).alias("weight"), sequence.percent_slice("seq", F.lit(0.25), F.lit(0.5)).alias("part"))


def kmer_counts(s: SparkSession, d: str) -> DataFrame:
    w = base.sequences(s, d).select("taxid", F.explode(sequence.windows("seq", 3)).alias("kmer"))
    return w.join(F.broadcast(sequence.kmer_vocabulary(s, 3)), "kmer", "left_semi").groupBy("taxid", "kmer").agg(F.count(F.lit(1)).alias("n"))


def _seqs_in_tree(s: SparkSession, d: str) -> DataFrame:
    return base.sequences(s, d).join(base.lineages(s, d).select("taxid"), "taxid", "left_semi")


def capacity_by_taxon(s: SparkSession, d: str) -> DataFrame:
    return windows.node_capacity(base.sequences(s, d), ["taxid"], "seq", K)


def capacity_by_language(s: SparkSession, d: str) -> DataFrame:
    """Whole texts of documents as sequences: distinct 16-character windows by language."""
    t = table(s, d, "documents", ["text", "lang"])
    return windows.capacity(t.withColumn("lang", F.coalesce(F.lower("lang"), F.lit("none"))), ["lang"], "text", 16)


def capacity_hierarchy(s: SparkSession, d: str) -> DataFrame:
    return windows.capacity_by_closure(_seqs_in_tree(s, d), "taxid", "seq", K, hierarchy_closure(s, d))


def capacity_rollup(s: SparkSession, d: str) -> DataFrame:
    top = base.paths(s, d).select("taxid", F.get("ids", F.lit(0)).alias("l0"), F.get("ids", F.lit(1)).alias("l1"))
    return windows.capacity_rollup(base.sequences(s, d).join(top, "taxid"), ["l0", "l1"], "seq", K)


def capacity_ambiguous(s: SparkSession, d: str) -> DataFrame:
    return windows.ambiguous_windows(base.sequences(s, d).withColumn("first", F.substring("header_id", 1, 7)), ["first"], "seq", K)


def capacity_approximate(s: SparkSession, d: str) -> DataFrame:
    return windows.node_capacity(base.sequences(s, d), ["taxid"], "seq", K, mode="approximate")


def size_proxy(s: SparkSession, d: str) -> DataFrame:
    return selection.size_proxy(base.accessions(s, d), base.lineages(s, d))


def label_index(s: SparkSession, d: str) -> DataFrame:
    return selection.label_index(base.accessions(s, d), base.lineages(s, d))


def pending_volume(s: SparkSession, d: str) -> DataFrame:
    return selection.pending_volume(base.accessions(s, d))


def selection_until(s: SparkSession, d: str) -> DataFrame:
    c = selection.pending(base.accessions(s, d)).where("taxid is not null").withColumn("need", F.lit(20_000_000))
    return selection.select_until(c, "taxid", "need").select("taxid", "accession", "taken_before")


def deferred_accessions(s: SparkSession, d: str) -> DataFrame:
    a = base.accessions(s, d)
    return selection.defer(a, selection_until(s, d)).select("accession", "download_deferred")


def capacity_shortfalls(s: SparkSession, d: str) -> DataFrame:
    t = _info(s, d).where("rank in ('family', 'order')").select(F.col("taxid").alias("label"), F.lit(100_000_000).alias("target"))
    return selection.shortfalls(size_proxy(s, d), t)


_CREDIT = f"{ACC}, {LIN}, credited AS (SELECT a.*, unnest(list_distinct(list_concat([a.taxid], coalesce(list_transform(l.path, lambda x: x.taxid), [])))) AS label FROM acc a LEFT JOIN lin l USING (taxid) WHERE a.taxid IS NOT NULL)"
_PENDING = "NOT coalesce(downloaded, false) AND NOT coalesce(download_deferred, false) AND coalesce(download_attempts, 0) < 3"
_UNTIL = f"""until AS (SELECT taxid, accession, CAST(coalesce(sum(coalesce(length, 0)) OVER (PARTITION BY taxid ORDER BY coalesce(is_reference, false) DESC, coalesce(length, 0) DESC, accession ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS taken_before
  FROM acc WHERE {_PENDING} AND taxid IS NOT NULL)"""
_CLEAN = f"""{LIN}, cleaned AS (SELECT taxid, path, list_transform(list_filter(list_reverse(path), lambda x: NOT (coalesce(lower(x.rank) IN ('serotype', 'strain', 'phylum'), false) OR coalesce({' OR '.join(f"regexp_matches(x.name, '(?i){p}')" for p in RULES.patterns)}, false))), lambda x: x.taxid) AS kept,
  len(list_filter(path, lambda x: x.taxid = taxid AND (coalesce(lower(x.rank) IN ('serotype', 'strain', 'phylum'), false) OR coalesce({' OR '.join(f"regexp_matches(x.name, '(?i){p}')" for p in RULES.patterns)}, false)))) > 0 AS self_noise FROM lin),
clean AS (SELECT taxid, CASE WHEN self_noise OR list_contains(kept, taxid) THEN kept ELSE list_append(kept, taxid) END AS ids FROM cleaned)"""
_REDIRECT = """CASE WHEN len(ids) <= 1 OR ids[1] <> '1000' THEN ids WHEN {hit} IS NULL THEN ['1000', '999000', ids[-1]] WHEN {hit} = '100501' THEN ids
  ELSE list_concat(ids[1:list_position(ids, {hit}) - 1], [CASE WHEN {hit} = '100500' THEN '999001' ELSE '999002' END], ids[list_position(ids, {hit}):]) END"""
_R1 = _REDIRECT.format(hit="(CASE WHEN ids[2] IN ('100500', '100501', '100502') THEN ids[2] END)")
_R2 = _REDIRECT.format(hit="(list_filter(ids[2:], lambda x: x IN ('100500', '100501', '100502'))[1])")
_W = "SELECT DISTINCT {g}, substr(seq, CAST(i AS INT), {k}) AS w FROM (SELECT {g}, seq, unnest(generate_series(1, length(seq) - {k} + 1)) AS i FROM {t} WHERE length(seq) >= {k})"

QUERIES = {
    f.__name__: f
    for f in (
        noise_filter, noise_stats, scope_filter, pending_accessions, scope_pending, rank_properties, clean_lineages, anchored_lineages, redirected_lineages, redirected_nodes, hierarchy_nodes, hierarchy_closure,
        passthroughs, decidable_depth, pruned_lineages, node_paths, sequence_leaves, accession_lineages, virtual_ids, reverse_complements, sequence_measures, kmer_counts, capacity_by_taxon, capacity_by_language,
        capacity_hierarchy, capacity_rollup, capacity_ambiguous, capacity_approximate, size_proxy, label_index, pending_volume, selection_until, deferred_accessions, capacity_shortfalls,
    )
}
ORACLE = {
    "noise_filter": f"""WITH {LIN}, {INFO}, i AS (SELECT taxid, m.rank AS rank, m.name AS name FROM info) SELECT taxid, {_RANK_HIT} OR ({_NAME_HIT}) AS is_noise,
      CASE WHEN {_RANK_HIT} THEN 'rank:' || lower(rank) {' '.join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{p}'" for p in RULES.patterns)} END AS why FROM i""",
    "noise_stats": f"WITH {LIN}, {INFO}, i AS (SELECT m.rank AS rank, m.name AS name FROM info) SELECT count(*) AS evaluated, count(*) FILTER ({_RANK_HIT}) AS rank_hits, count(*) FILTER (NOT {_RANK_HIT} AND ({_NAME_HIT})) AS name_hits FROM i",
    "scope_filter": f"WITH {LIN} SELECT taxid, CAST(len(path) AS INT) AS n FROM lin WHERE len(list_filter(path, lambda x: x.taxid = '1000')) > 0",
    "pending_accessions": f"WITH {ACC} SELECT accession, length FROM acc WHERE {_PENDING}",
    "scope_pending": f"WITH {ACC}, {LIN} SELECT accession, taxid FROM acc WHERE NOT coalesce(downloaded, false) AND taxid IN (SELECT taxid FROM lin WHERE len(list_filter(path, lambda x: x.taxid = '1000')) > 0)",
    "rank_properties": f"""WITH {LIN}, {INFO}, r AS (SELECT m.rank AS rank FROM info UNION SELECT rank FROM label_map), c AS (SELECT ['superkingdom', 'kingdom', 'phylum', 'class', 'order', 'family', 'genus', 'species'] AS c)
      SELECT rank, CAST(nullif(coalesce(list_position(c, rank), 0), 0) - 1 AS INT) AS depth, coalesce(list_contains(c, rank), false) AS canonical, coalesce(rank = 'realm_group' OR rank LIKE 'virtual\\_%' ESCAPE '\\', false) AS protected,
      coalesce(rank LIKE 'virtual\\_%' ESCAPE '\\', false) AS ends, coalesce(list_position(c, rank) >= 6, false) AS at_or_below, coalesce(list_position(c, rank) > 6, false) AS below FROM r, c""",
    "clean_lineages": f"WITH {_CLEAN} SELECT taxid, ids FROM clean",
    "anchored_lineages": f"WITH {_CLEAN} SELECT taxid, CASE WHEN list_contains(ids, '1000') THEN ids[list_position(ids, '1000'):] ELSE list_prepend('1000', ids) END AS ids FROM clean",
    "redirected_lineages": f"WITH {PATHS} SELECT taxid, {_R1} AS canonical_mode, {_R2} AS all_ranks_mode FROM paths",
    "redirected_nodes": f"""WITH {PATHS}, {INFO}, r AS (SELECT {_R2} AS ids FROM paths), e AS (SELECT node_id, min(depth) AS depth FROM (SELECT unnest(ids) AS node_id, generate_subscripts(ids, 1) - 1 AS depth FROM r) GROUP BY 1)
      SELECT CASE WHEN node_id IN ('999000', '999001', '999002') THEN 'realm_group' ELSE coalesce(m.rank, 'unknown') END AS rank, count(*) AS n, CAST(max(depth) AS INT) AS deepest FROM e LEFT JOIN info ON node_id = taxid GROUP BY 1""",
    "hierarchy_nodes": f"WITH {NODES} SELECT * FROM nodes",
    "hierarchy_closure": f"WITH {PATHS}, {CLOSURE} SELECT taxid, ancestor, CAST(distance AS INT) AS distance FROM closure",
    "passthroughs": f"WITH {NODES}, c AS (SELECT parent_id, count(*) AS n FROM nodes WHERE parent_id IS NOT NULL GROUP BY 1) SELECT node_id, coalesce(n, 0) AS n_children, coalesce(n, 0) = 1 AS is_passthrough FROM nodes LEFT JOIN c ON node_id = c.parent_id",
    "decidable_depth": f"""WITH RECURSIVE {NODES}, c AS (SELECT parent_id, count(*) AS n FROM nodes WHERE parent_id IS NOT NULL GROUP BY 1), up AS (SELECT node_id, min(ids[1:depth + 1]) AS up FROM pos GROUP BY 1),
      f AS (SELECT node_id, unnest(up) AS a FROM up) SELECT f.node_id AS node_id, CAST(sum(CASE WHEN coalesce(c.n, 0) = 1 THEN 0 ELSE 1 END) AS BIGINT) AS decidable_depth FROM f LEFT JOIN c ON f.a = c.parent_id GROUP BY 1""",
    "pruned_lineages": f"WITH {PATHS}, {INFO} SELECT taxid FROM paths WHERE len(list_intersect(ids, (SELECT list(taxid) FROM info WHERE m.rank = 'family' AND CAST(taxid AS BIGINT) % 3 = 0))) = 0",
    "node_paths": f"WITH {LIN} SELECT taxid, array_to_string(list_transform(list_reverse(path), lambda x: translate(x.name, ' /', '__')), '/') AS path FROM lin",
    "sequence_leaves": """SELECT taxid, header_id, ord FROM (SELECT taxid, h.id AS header_id, ord, accession, row_number() OVER (PARTITION BY taxid, h.id ORDER BY ord, accession) AS rn
      FROM (SELECT taxid, ord, accession, unnest(headers) AS h FROM accessions WHERE taxid IS NOT NULL) WHERE h.id IS NOT NULL) WHERE rn = 1""",
    "accession_lineages": f"WITH {ACC}, {LIN} SELECT accession, taxid, path[-1].taxid AS root FROM acc JOIN lin USING (taxid)",
    "virtual_ids": f"""WITH {LIN}, {INFO} SELECT taxid, {', '.join(f"'9' || lpad(CAST(CAST('0x' || substr(sha256(taxid || ':{p}'), 1, 15) AS UBIGINT) % 1000000000000000 AS VARCHAR), 15, '0') AS {p}" for p in ('low_capacity', 'reject'))} FROM info""",
    "reverse_complements": f"WITH {SEQ} SELECT header_id, translate(reverse(regexp_replace(seq, '[^ACGTYRWSKMDHVBN]', 'N', 'g')), 'ACGTYRWSKMDHVBN', 'TGCARYWSMKHDBVN') AS rc FROM seqs",
    "sequence_measures": f"""WITH {SEQ} SELECT header_id, CAST(length(seq) AS INT) AS len, round(len(regexp_extract_all(seq, '[GC]')) / length(seq), 6) AS gc, regexp_full_match(seq, '[ACGT]+') AS pure, CAST(greatest(0, length(seq) - 99) AS BIGINT) AS weight,
      substr(seq, CAST(floor(length(seq) * 0.25) AS INT) + 1, CAST(floor(length(seq) * 0.5) - floor(length(seq) * 0.25) AS INT)) AS part FROM seqs""",
    "kmer_counts": f"WITH {SEQ} SELECT taxid, w AS kmer, count(*) AS n FROM (SELECT taxid, substr(seq, CAST(i AS INT), 3) AS w FROM (SELECT taxid, seq, unnest(generate_series(1, length(seq) - 2)) AS i FROM seqs WHERE length(seq) >= 3)) WHERE regexp_full_match(w, '[ACGT]+') GROUP BY 1, 2",
    "capacity_by_taxon": f"WITH {SEQ} SELECT taxid, count(*) AS capacity FROM ({_W.format(g='taxid', k=K, t='seqs')}) GROUP BY 1",
    "capacity_by_language": f"WITH d AS (SELECT coalesce(lower(lang), 'none') AS lang, text AS seq FROM documents) SELECT lang, count(*) AS capacity FROM ({_W.format(g='lang', k=16, t='d')}) GROUP BY 1",
    "capacity_hierarchy": f"WITH {PATHS}, {CLOSURE}, {SEQ}, w AS ({_W.format(g='taxid', k=K, t='seqs')}) SELECT ancestor, count(DISTINCT w) AS capacity FROM w JOIN closure USING (taxid) GROUP BY 1",
    "capacity_rollup": f"WITH {PATHS}, {SEQ}, t AS (SELECT s.seq AS seq, ids[1] AS l0, ids[2] AS l1 FROM seqs s JOIN paths USING (taxid)), w AS ({_W.format(g='l0, l1', k=K, t='t')}) SELECT l0, l1, count(DISTINCT w) AS capacity FROM w GROUP BY ROLLUP (l0, l1)",
    "capacity_ambiguous": f"WITH {SEQ}, t AS (SELECT substr(header_id, 1, 7) AS first, seq FROM seqs), w AS ({_W.format(g='first', k=K, t='t')}) SELECT first, count(*) AS capacity, count(*) FILTER (NOT regexp_full_match(w, '[ACGT]+')) AS ambiguous FROM w GROUP BY 1",
    "size_proxy": f"WITH {_CREDIT} SELECT label, CAST(sum(length) AS BIGINT) AS capacity FROM credited WHERE length > 0 GROUP BY 1",
    "label_index": f"""WITH {_CREDIT} SELECT label, CAST(sum(CASE WHEN coalesce(downloaded, false) THEN coalesce(length, 0) ELSE 0 END) AS BIGINT) AS downloaded_size, count(*) FILTER (NOT coalesce(downloaded, false)) AS n_pending,
      CAST(sum(CASE WHEN NOT coalesce(downloaded, false) THEN coalesce(length, 0) ELSE 0 END) AS BIGINT) AS pending_size, count(*) FILTER (NOT coalesce(downloaded, false) AND coalesce(download_deferred, false)) AS n_deferred FROM credited GROUP BY 1""",
    "pending_volume": f"WITH {ACC} SELECT count(*) AS n_pending, CAST(sum(coalesce(length, 0)) AS BIGINT) AS pending_size FROM acc WHERE NOT coalesce(downloaded, false)",
    "selection_until": f"WITH {ACC}, {_UNTIL} SELECT * FROM until WHERE taken_before < 20000000",
    "deferred_accessions": f"WITH {ACC}, {_UNTIL} SELECT accession, CASE WHEN coalesce(downloaded, false) THEN coalesce(download_deferred, false) ELSE accession NOT IN (SELECT accession FROM until WHERE taken_before < 20000000) END AS download_deferred FROM acc",
    "capacity_shortfalls": f"""WITH {_CREDIT}, {INFO}, cap AS (SELECT label, CAST(sum(length) AS BIGINT) AS capacity FROM credited WHERE length > 0 GROUP BY 1)
      SELECT taxid AS label, coalesce(capacity, 0) AS capacity, 100000000 AS target, 100000000 - coalesce(capacity, 0) AS missing FROM info LEFT JOIN cap ON taxid = label WHERE m.rank IN ('family', 'order') AND coalesce(capacity, 0) < 100000000""",
}
