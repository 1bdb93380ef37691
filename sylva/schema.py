"""Schemas of the engine's tables; always given, never inferred."""

from __future__ import annotations

HEADERS = "array<struct<id: string, name: string>>"
PATH = "array<struct<taxid: string, rank: string, name: string>>"
ACCESSION = (
    "accession string, taxid string, organism string, is_reference boolean, total_sequence_length bigint, downloaded boolean, "
    f"download_deferred boolean, download_attempts int, local_path string, cross_domain boolean, headers {HEADERS}, ord bigint"
)
TAXON_ACC = "taxid string, accession string, ord bigint"
LINEAGE = f"taxid string, path {PATH}"
CAPACITY = "taxid string, min_len int, capacity bigint"
SEQUENCE = "header_id string, seq string, length bigint"
NODE = "node_id string, parent_id string, depth int, rank string, sci_name string"
TASK = "head string, child string, class_idx int, header_id string, genome_key string, n bigint, length bigint, split string, start_pct double, end_pct double, pool string"
SAMPLE = "head string, split string, seq string, class_idx int"
PREDICTION = "read_id string, predicted_taxid string, predicted_rank string"
REPORT = (
    "accession string, organism struct<tax_id: bigint, organism_name: string>, assembly_info struct<assembly_level: string>, "
    "assembly_stats struct<total_sequence_length: bigint>"
)
