"""Queries of the problems tagged llm over the test tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions.text import accession_key
from sylva.llm import garbled, grouped_split, leakage, packing, proportions, tokenize_corpus
from sylva.session import table, written

_CURRENT = "SELECT DISTINCT ON (accession) * FROM accessions ORDER BY accession, last_update DESC NULLS LAST"
_TAXID = "CAST(nullif(regexp_extract({}, '[0-9]+'), '') AS BIGINT)"


def _p1_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, sf_dir, "label_map"), table(spark, sf_dir, "sample_requests"), table(spark, sf_dir, "sample_targets")


def p1_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn and wanted windows of each head and category."""
    return proportions.plan(*_p1_tables(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_plan(spark, sf_dir).where("short").select("head_taxid", "axis_name", "category")


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn windows of each head and class."""
    label_map, requests, targets = _p1_tables(spark, sf_dir)
    return proportions.materialise(label_map, targets, written(proportions.plan(label_map, requests, targets)))


def p1_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per head: windows drawn, windows drawn twice or outside their class, and categories that hold another number than planned."""
    label_map, requests, targets = _p1_tables(spark, sf_dir)
    plan = written(proportions.plan(label_map, requests, targets))
    drawn = written(proportions.materialise(label_map, targets, plan))
    most = proportions.availability(label_map, targets).select("head_taxid", "class_idx", "n_windows")
    d = drawn.join(most, ["head_taxid", "class_idx"]).select("*", F.size("windows").alias("n"), (F.array_max("windows") >= F.col("n_windows")).alias("beyond"))
    # rows of a class are ranges apart from each other and rise inside, so repeats would show in a row
    d = d.withColumn("twice", F.size("windows") - F.size(F.array_distinct("windows")))
    by = d.groupBy("head_taxid", F.coalesce("category", F.lit(proportions.OTHER)).alias("category")).agg(F.sum("n").alias("n"), (F.sum("twice") + F.count_if("beyond")).alias("wrong"))
    j = plan.join(by, ["head_taxid", "category"], "left").fillna(0, ["n", "wrong"])
    return j.groupBy("head_taxid").agg(F.sum("n").alias("drawn"), F.sum("wrong").alias("wrong"), F.count_if(F.col("n") != F.col("n_drawn")).alias("unlike_plan"))


def p4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box of every accession, or of each piece of one that is too long, for each container type."""
    return packing.pack(packing.current_lengths(table(spark, sf_dir, "accessions")), table(spark, sf_dir, "containers"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accessions that had to be cut: those whose pieces lie in several boxes."""
    return packing.split_items(p4_pack(spark, sf_dir))


def p4_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per container type: pieces and bases packed, boxes that are overfull, and whether the boxes are within 2 percent (and two boxes) of the least possible number."""
    f = packing.fill(p4_pack(spark, sf_dir), table(spark, sf_dir, "containers"))
    return f.select("container", "n_pieces", "bases", "overfull", "lower_bound", (F.col("boxes") <= F.col("lower_bound") * 1.02 + 2).alias("tight"))


def _p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_split.records(table(spark, sf_dir, "accessions"), table(spark, sf_dir, "plasmid_records"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_split.tied_pairs(grouped_split.components(grouped_split.taxid_ties(_p5_records(spark, sf_dir))))


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every record."""
    rows = written(_p5_records(spark, sf_dir))
    return grouped_split.assign(rows, grouped_split.components(grouped_split.taxid_ties(rows)), table(spark, sf_dir, "split_targets"))


def p5_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row about the splits: records, taxids and accession spellings that lie in two splits, and whether each split is within a thousandth of its target."""
    rows = written(p5_splits(spark, sf_dir))
    n = rows.groupBy("split_name").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(table(spark, sf_dir, "split_targets")), "split_name")
    total = rows.count()
    torn = lambda key: rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.min("split_name") != F.max("split_name")).alias("t")).agg(F.count_if("t").alias(f"torn_{key}"))
    keyed = rows.withColumn("key", accession_key("accession"))
    torn_keys = keyed.where("key is not null").groupBy("key").agg((F.min("split_name") != F.max("split_name")).alias("t")).agg(F.count_if("t").alias("torn_keys"))
    shares = n.agg((F.max(F.abs(F.col("n") / total - F.col("target_share"))) < 0.001).alias("on_target"), F.sum("n").alias("n_records"))
    return shares.select("on_target", "n_records", torn("taxid").scalar().alias("torn_taxid"), torn_keys.scalar().alias("torn_keys"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_corpus.encode_corpus(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text from its ids."""
    return tokenize_corpus.decode_corpus(p6_ids(spark, sf_dir))


def _p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.longest_matches(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "eval_items", ["item_id", "text"]))


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest match of each document with each item, with its places."""
    return _p7_matches(spark, sf_dir)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p7_matches(spark, sf_dir).select("doc_id", "item_id")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are left for training."""
    return leakage.without_leaks(table(spark, sf_dir, "documents"), _p7_matches(spark, sf_dir))


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled documents, with the original text where it can be had."""
    return garbled.garbled_documents(table(spark, sf_dir, "documents", ["doc_id", "text"]))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_restored(spark, sf_dir).select("doc_id")


#: Places (from 0) at which a document and an item agree in 13 words.
_MATCHES = """w AS (SELECT doc_id, regexp_extract_all(replace(lower(text), 'ς', 'σ'), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL), v AS (SELECT item_id, regexp_extract_all(replace(lower(text), 'ς', 'σ'), '[\\p{L}\\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
g AS (SELECT item_id, q, array_to_string(w[q + 1:q + 13], ' ') AS g FROM (SELECT *, unnest(generate_series(0, len(w) - 13)) AS q FROM v WHERE len(w) >= 13)),
h AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 13], ' ') AS g FROM (SELECT *, unnest(generate_series(0, len(w) - 13)) AS p FROM w WHERE len(w) >= 13)),
pairs AS (SELECT doc_id, item_id, p, q FROM h JOIN g USING (g))"""

QUERIES = {"p1_found": p1_found, "p1_plan": p1_plan, "p1_sample": p1_sample, "p1_check": p1_check, "p4_found": p4_found, "p4_pack": p4_pack, "p4_fill": p4_fill, "p5_found": p5_found, "p5_splits": p5_splits, "p5_check": p5_check, "p6_ids": p6_ids, "p6_decoded": p6_decoded, "p7_found": p7_found, "p7_matches": p7_matches, "p7_clean": p7_clean, "p8_found": p8_found, "p8_restored": p8_restored}
ORACLE = {
    "p1_found": """
WITH current AS (SELECT DISTINCT ON (head_taxid, class_idx) * FROM label_map ORDER BY head_taxid, class_idx, exported_at DESC NULLS LAST),
have AS (SELECT head_taxid, coalesce(nullif(lower(trim(rank, chr(32) || chr(9) || chr(10) || chr(160))), ''), 'unknown') AS rank, CAST(class_idx AS VARCHAR) AS class_idx, coalesce(n_windows, 0) AS n
  FROM current WHERE class_idx >= 0),
by_category AS (SELECT head_taxid, 'rank' AS axis_name, rank AS category, sum(n) AS n FROM have GROUP BY ALL
  UNION ALL SELECT head_taxid, 'class_idx', class_idx, sum(n) FROM have GROUP BY ALL)
SELECT t.head_taxid, t.axis_name, t.category FROM sample_targets t JOIN sample_requests r USING (head_taxid)
LEFT JOIN by_category c ON (t.head_taxid, t.axis_name, t.category) = (c.head_taxid, c.axis_name, c.category)
WHERE coalesce(c.n, 0) < greatest(t.min_windows, round(t.target_share * r.sample_size))""",
    "p4_found": f"SELECT container, accession FROM ({_CURRENT}) a JOIN containers c ON a.total_sequence_length > c.max_bases",
    "p4_fill": f"""
SELECT container, CAST(sum((total_sequence_length - 1) // max_bases + 1) AS BIGINT) AS n_pieces, CAST(sum(total_sequence_length) AS BIGINT) AS bases, 0 AS overfull,
CAST((sum(total_sequence_length) + max_bases - 1) // max_bases AS BIGINT) AS lower_bound, true AS tight
FROM ({_CURRENT}) a JOIN containers ON max_bases > 0 WHERE total_sequence_length > 0 GROUP BY container, max_bases""",
    "p5_found": f"""
WITH RECURSIVE rec AS (
  SELECT accession, {_TAXID.format('taxid')} AS t FROM ({_CURRENT}) UNION ALL SELECT accession, {_TAXID.format('host_taxid')} FROM plasmid_records),
keyed AS (SELECT DISTINCT regexp_replace(lower(trim(accession, chr(32) || chr(9) || chr(10) || chr(160))), '\\.[0-9]+$', '') AS k, t FROM rec WHERE accession IS NOT NULL AND t IS NOT NULL),
tie AS (SELECT DISTINCT a.t AS a, b.t AS b FROM keyed a JOIN keyed b ON a.k = b.k AND a.k <> '' AND a.t <> b.t),
reach(a, b) AS (SELECT a, b FROM tie UNION SELECT r.a, t.b FROM reach r JOIN tie t ON r.b = t.a)
SELECT DISTINCT a AS taxid_a, b AS taxid_b FROM reach WHERE a < b""",
    "p5_check": """SELECT true AS on_target, (SELECT count(DISTINCT accession) FROM accessions WHERE accession IS NOT NULL) + (SELECT count(*) FROM plasmid_records) AS n_records, 0 AS torn_taxid, 0 AS torn_keys""",
    "p1_check": """
WITH current AS (SELECT DISTINCT ON (head_taxid, class_idx) * FROM label_map WHERE head_taxid IS NOT NULL ORDER BY head_taxid, class_idx, exported_at DESC NULLS LAST),
have AS (SELECT head_taxid, sum(greatest(coalesce(n_windows, 0), 0)) AS n FROM current WHERE class_idx >= 0 GROUP BY 1), size AS (SELECT head_taxid, max(sample_size) AS size FROM sample_requests GROUP BY 1)
SELECT head_taxid, CAST(least(coalesce(size, 0), coalesce(n, 0)) AS BIGINT) AS drawn, 0 AS wrong, 0 AS unlike_plan FROM (SELECT DISTINCT head_taxid FROM sample_targets WHERE head_taxid IS NOT NULL) LEFT JOIN have USING (head_taxid) LEFT JOIN size USING (head_taxid)""",
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p7_found": f"WITH {_MATCHES} SELECT DISTINCT doc_id, item_id FROM pairs",
    "p7_matches": f"""WITH {_MATCHES}, isl AS (SELECT doc_id, item_id, q - p AS diag, q - row_number() OVER (PARTITION BY doc_id, item_id, q - p ORDER BY q) AS isle, p, q FROM pairs),
runs AS (SELECT doc_id, item_id, count(*) + 12 AS n_words, min(p) AS doc_from, min(q) AS item_from FROM isl GROUP BY doc_id, item_id, diag, isle)
SELECT DISTINCT ON (doc_id, item_id) doc_id, item_id, n_words, doc_from, item_from FROM runs ORDER BY doc_id, item_id, n_words DESC, doc_from, item_from""",
    "p7_clean": f"WITH {_MATCHES} SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM pairs)",
}
