"""Listings and manifests of releases, summary reports, and records turned into catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva import schema

#: What release files are called, levels that make an assembly a reference.
RELEASE_FILE = r'href="(plasmid[^"?/]*\.genomic\.gbff\.gz)"'
RELEASE_SUFFIX = ".genomic.gbff.gz"
REFERENCE_LEVELS = ("Complete Genome", "Chromosome")


def manifest_entries(lines: DataFrame) -> DataFrame:
    """``name, md5`` of manifest lines (``value``): the checksum by its shape, wherever it stands, the first other word as the file; lines of other files are dropped."""
    tokens = F.filter(F.split("value", r"\s+"), lambda t: t != "")
    is_sum = lambda t: t.rlike("^[0-9a-f]{32}$")
    out = lines.select(F.regexp_extract(F.get(F.filter(tokens, lambda t: ~is_sum(t)), F.lit(0)), r"([^/]*)$", 1).alias("name"), F.get(F.filter(tokens, is_sum), F.lit(0)).alias("md5"))
    return out.where(F.col("name").endswith(RELEASE_SUFFIX))


def html_listing(html: Column | str, pattern: str = RELEASE_FILE) -> Column:
    """Sorted distinct file names linked in a page."""
    h = F.col(html) if isinstance(html, str) else html
    return F.array_sort(F.array_distinct(F.regexp_extract_all(h, F.lit(pattern), F.lit(1))))


def stale_files(present: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries to fetch: absent, or with another md5 than listed. ``present(name, content)``."""
    have = present.select("name", F.md5("content").alias("have"))
    return entries.join(have, "name", "left").where("have is null or (md5 is not null and md5 <> have)").select("name", "md5")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Summary reports, one JSON object a line; broken lines and such without a taxid are dropped."""
    rows = spark.read.schema(schema.REPORT).option("mode", "DROPMALFORMED").json(path)
    return rows.where("organism.tax_id is not null and accession is not null")


def report_rows(reports: DataFrame) -> DataFrame:
    """Catalogue rows of reports, all not downloaded yet."""
    return reports.select(
        "accession", F.col("organism.tax_id").cast("string").alias("taxid"), F.col("organism.organism_name").alias("organism"),
        F.coalesce(F.col("assembly_info.assembly_level").isin(*REFERENCE_LEVELS), F.lit(False)).alias("is_reference"),
        F.coalesce(F.col("assembly_stats.total_sequence_length"), F.lit(0)).cast("bigint").alias("total_sequence_length"), F.lit(False).alias("downloaded"),
    )


def reference_sample(reports: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` reports of reference assemblies, the least accessions first; none for a limit of 0 or less. Repeated reports count once."""
    good = reports.where(F.col("assembly_info.assembly_level").isin(*REFERENCE_LEVELS) & F.col("accession").isNotNull()).dropDuplicates(["accession"])
    return good.orderBy("accession").limit(max(0, limit))


def group_reports(reports: DataFrame) -> DataFrame:
    """``taxid, accessions``: the accessions reported for each taxon, sorted."""
    return report_rows(reports).groupBy("taxid").agg(F.array_sort(F.collect_set("accession")).alias("accessions"))


def record_reports(records: DataFrame) -> DataFrame:
    """Reports made of flat-file records: complete, of their host's taxid, as long as the record says."""
    return records.select(
        "accession", F.struct(F.col("host_taxid").cast("bigint").alias("tax_id"), F.col("organism").alias("organism_name")).alias("organism"), F.struct(F.lit("Complete Genome").alias("assembly_level")).alias("assembly_info"),
        F.struct(F.col("length").alias("total_sequence_length")).alias("assembly_stats"),
    )


def ranks_to_path(classification: DataFrame, ranks: tuple[str, ...]) -> DataFrame:
    """``taxid, path`` from columns of structs ``(id, name)`` named by rank, species first; null ranks are left out. ``acellular_root`` stands in for a missing superkingdom."""
    cols = []
    for r in ranks:
        c = F.coalesce(F.col("superkingdom"), F.col("acellular_root")) if r == "superkingdom" and "acellular_root" in classification.columns else F.col(r)
        cols.append(F.when(c["id"].isNotNull(), F.struct(c["id"].cast("string").alias("taxid"), F.lit(r).alias("rank"), c["name"].alias("name"))))
    return classification.select("taxid", F.filter(F.array(*cols), lambda x: x.isNotNull()).alias("path"))
