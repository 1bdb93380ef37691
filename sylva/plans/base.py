"""Views of the test tables that the queries of the reference's operators share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions.text import strip_white, taxid_number
from sylva.operators.latest import latest
from sylva.session import table

ACC_COLUMNS = ["taxid", "is_reference", "total_sequence_length", "downloaded", "download_deferred", "download_attempts", "cross_domain"]


def accessions(spark: SparkSession, d: str) -> DataFrame:
    """Current rows, taxids as plain numbers in text."""
    a = latest(table(spark, d, "accessions"), ["accession"], ["last_update"], ACC_COLUMNS)
    return a.withColumn("taxid", taxid_number("taxid").cast("string")).withColumnRenamed("total_sequence_length", "length")


def lineages(spark: SparkSession, d: str) -> DataFrame:
    """One row per taxid (repeated rows are equal), without empty paths."""
    return table(spark, d, "lineages").where(F.size("path") > 0).groupBy("taxid").agg(F.first("path").alias("path"))


def paths(spark: SparkSession, d: str) -> DataFrame:
    """``taxid, ids`` from root to leaf."""
    return lineages(spark, d).select("taxid", F.transform(F.reverse("path"), lambda x: x["taxid"]).alias("ids"))


def info(spark: SparkSession, d: str) -> DataFrame:
    """``taxid, rank, name`` of all nodes."""
    x = lineages(spark, d).select(F.explode("path").alias("x")).select("x.taxid", "x.rank", "x.name").where("taxid is not null and rank is not null and name is not null")
    return x.groupBy("taxid").agg(F.max(F.struct("rank", "name")).alias("m")).select("taxid", "m.rank", "m.name")


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """``header_id, taxid, seq`` of records with a sequence, one row per accession."""
    r = table(spark, d, "plasmid_records", ["accession", "host_taxid", "sequence"]).where("sequence <> ''")
    r = r.select(strip_white("accession").alias("header_id"), taxid_number("host_taxid").alias("t"), F.upper("sequence").alias("s")).where("header_id <> ''")
    return r.groupBy("header_id").agg(F.max("t").cast("string").alias("taxid"), F.max("s").alias("seq"))


_TRIM = "trim({}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))"
ACC = """acc AS (SELECT accession, CAST(CAST(nullif(regexp_extract(taxid, '[0-9]+'), '') AS BIGINT) AS VARCHAR) AS taxid, is_reference, total_sequence_length AS length, downloaded, download_deferred, download_attempts, cross_domain
  FROM (SELECT DISTINCT ON (accession) * FROM accessions ORDER BY accession, last_update DESC NULLS LAST))"""
LIN = "lin AS (SELECT taxid, any_value(path) AS path FROM lineages WHERE len(path) > 0 GROUP BY taxid)"
PATHS = f"{LIN}, paths AS (SELECT taxid, list_transform(list_reverse(path), lambda x: x.taxid) AS ids FROM lin)"
INFO = "info AS (SELECT x.taxid AS taxid, max({'rank': x.rank, 'name': x.name}) AS m FROM (SELECT unnest(path) AS x FROM lin) WHERE x.taxid IS NOT NULL AND x.rank IS NOT NULL AND x.name IS NOT NULL GROUP BY 1)"
SEQ = f"""seqs AS (SELECT {_TRIM.format('accession')} AS header_id, CAST(max(CAST(nullif(regexp_extract(host_taxid, '[0-9]+'), '') AS BIGINT)) AS VARCHAR) AS taxid, max(upper(sequence)) AS seq
  FROM plasmid_records WHERE sequence <> '' AND {_TRIM.format('accession')} <> '' GROUP BY 1)"""
NODES = f"""{PATHS}, {INFO}, pos AS (SELECT unnest(ids) AS node_id, generate_subscripts(ids, 1) - 1 AS depth, ids FROM paths),
nodes AS (SELECT node_id, e.m.p AS parent_id, CAST(e.m.d AS INT) AS depth, coalesce(info.m.rank, 'unknown') AS rank, coalesce(info.m.name, node_id) AS sci_name
  FROM (SELECT node_id, min({{'d': depth, 'p': CASE WHEN depth > 0 THEN ids[depth] END}}) AS m FROM pos GROUP BY 1) e LEFT JOIN info ON e.node_id = info.taxid)"""
CLOSURE = "closure AS (SELECT taxid, unnest(list_reverse(ids)) AS ancestor, generate_subscripts(ids, 1) - 1 AS distance FROM paths)"
HASH = "CAST('0x' || substr(md5({}), 1, 12) AS BIGINT)"
