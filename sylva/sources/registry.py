"""The catalogue as one JSON document, read to and written from the engine's tables; configuration files."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva import schema
from sylva.operators.hierarchy import NoiseRules, Scope

_ACC = f"struct<taxid: string, organism: string, is_reference: boolean, total_sequence_length: bigint, downloaded: boolean, download_deferred: boolean, download_attempts: int, local_path: string, headers: {schema.HEADERS}>"
DOCUMENT = (
    f"last_update string, taxons map<string, array<string>>, accessions map<string, {_ACC}>, lineages map<string, {schema.PATH}>, "
    "capacities map<string, map<string, bigint>>, cross_domain_negatives array<string>"
)


def read_registry(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``taxon_acc, accession, lineage, capacity`` of a catalogue document; missing sections are empty tables."""
    doc = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    edges = doc.select(F.explode("taxons").alias("taxid", "a")).select("taxid", F.posexplode("a").alias("ord", "accession")).select("taxid", "accession", F.col("ord").cast("bigint").alias("ord"))
    cross = doc.select(F.explode("cross_domain_negatives").alias("accession")).distinct().withColumn("__c", F.lit(True))
    acc = doc.select(F.posexplode(F.map_entries("accessions")).alias("ord", "e")).select(F.col("e.key").alias("accession"), "e.value.*", F.col("ord").cast("bigint").alias("ord"))
    acc = acc.join(cross, "accession", "left").withColumn("cross_domain", F.coalesce("__c", F.lit(False))).drop("__c")
    order = "accession taxid organism is_reference total_sequence_length downloaded download_deferred download_attempts local_path cross_domain headers ord".split()
    return {
        "taxon_acc": edges,
        "accession": acc.select(*order),
        "lineage": doc.select(F.explode("lineages").alias("taxid", "path")),
        "capacity": doc.select(F.explode("capacities").alias("taxid", "m")).select("taxid", F.explode("m").alias("min_len", "capacity")).select("taxid", F.col("min_len").cast("int").alias("min_len"), "capacity"),
    }


def read_json_config(path: str, optional: bool = False) -> dict:
    """A configuration file; with ``optional`` a missing or broken one is empty."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        if optional:
            return {}
        raise


def noise_rules(path: str | None) -> NoiseRules:
    return NoiseRules.of(read_json_config(path, optional=True)) if path else NoiseRules()


def scope_of(mapping: Mapping, domain: str) -> Scope:
    """The routing of a domain; a domain that isn't configured routes nothing."""
    s = mapping.get("scopes", {}).get(domain, {})
    rules = {k: v["target_id"] for k, v in s.get("redirections", {}).items()}
    return Scope(domain, rules, s.get("default_id"), s.get("virtual_id_labels", {}))


def merge_new(existing: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Insert-only merge: rows of keys not known yet are added, known ones never overwritten."""
    return existing.unionByName(found.dropDuplicates([key]).join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def cached_capacities(existing: DataFrame, changed: DataFrame, lineages: DataFrame) -> DataFrame:
    """Cached capacities of all window lengths without those of changed taxids and of every ancestor of theirs.

    ``changed(taxid)`` are taxa with new accessions, ``lineages(taxid, path)`` their paths; a changed taxid without a lineage drops itself only.
    """
    gone = changed.select("taxid").where("taxid is not null").distinct()
    above = lineages.join(gone, "taxid", "left_semi").select(F.explode("path").alias("x")).select(F.col("x.taxid").alias("taxid"))
    return existing.join(gone.unionByName(above).distinct(), "taxid", "left_anti")


def reconcile(accessions: DataFrame, sequences: DataFrame) -> DataFrame:
    """Accessions marked downloaded of which no header is in the sequence table lose the mark."""
    known = accessions.select("accession", F.explode("headers").alias("h")).join(sequences.select(F.col("header_id")).distinct(), F.col("h.id") == F.col("header_id"), "left_semi").select("accession").distinct().withColumn("__k", F.lit(True))
    j = accessions.join(known, "accession", "left")
    return j.withColumn("downloaded", F.coalesce("downloaded", F.lit(False)) & F.col("__k").isNotNull()).drop("__k")
