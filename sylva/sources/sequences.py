"""Sequence files: FASTA, GenBank flat files (gzip or not), zipped archives, and the sequence table."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Extensions of sequence files.
FASTA_GLOB = "*.{fna,fasta,fa}"
GBFF_GLOB = "*.{gbff,gbff.gz}"


def fasta_records(chunks: DataFrame, order: list[str]) -> DataFrame:
    """``header_id, name, seq`` from ``value`` columns that each hold one record without its ``>``.

    The first word is the id, the rest the name (the id if there is none), lines are joined without blanks. The first record of an id,
    by ``order``, wins. Records without an id are dropped.
    """
    head, body = F.regexp_extract("value", r"^([^\r\n]*)", 1), F.regexp_replace("value", r"^[^\r\n]*", "")
    h = F.trim(head)
    out = chunks.select(*order, F.regexp_extract(h, r"^(\S+)", 1).alias("header_id"), F.trim(F.regexp_replace(h, r"^\S+", "")).alias("name"), F.regexp_replace(body, r"\s+", "").alias("seq")).where("header_id <> ''")
    first = out.withColumn("__rn", F.row_number().over(Window.partitionBy("header_id").orderBy(*order))).where("__rn = 1")
    return first.select("header_id", F.when(F.col("name") != "", F.col("name")).otherwise(F.col("header_id")).alias("name"), "seq")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """All FASTA files of a folder; records are split by the reader at lines that begin with ``>``, so a large file is many tasks' work.

    A ``>`` inside a description is part of it. Text before a file's first header is read as a record unless it is blank.
    """
    raw = spark.read.option("lineSep", "\n>").option("pathGlobFilter", FASTA_GLOB).option("recursiveFileLookup", True).text(path)
    rows = raw.select(F.regexp_replace("value", r"^\s*>", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).where(F.trim("value") != "")
    return fasta_records(rows.withColumn("no", F.monotonically_increasing_id()), ["file", "at", "no"])


def excluded_molecule(name: Column | str, word: str = "plasmid") -> Column:
    """Plasmids (or what else ``word`` names) are left out of genomes."""
    n = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.contains(F.lower(n), F.lit(word)), F.lit(False))


def _line(pattern: str) -> Column:
    return F.regexp_extract("value", rf"(?m)^{pattern}", 1)


def gbff_records(chunks: DataFrame) -> DataFrame:
    """``accession, host_taxid, organism, length, sequence`` from ``value`` columns that each hold one flat-file record.

    VERSION before ACCESSION, the ``/organism`` qualifier before the ORGANISM line, the LOCUS length before that of the sequence; letters after
    ORIGIN in upper case. Records without accession or ``taxon:`` number are dropped.
    """
    some = lambda *cols: F.coalesce(*[F.when(c != "", c) for c in cols])
    origin = F.regexp_extract("value", r"(?s)(?:^|\n)ORIGIN[^\n]*\n(.*)$", 1)
    seq = F.upper(F.regexp_replace(origin, r"[^\p{L}]", ""))
    out = chunks.select(
        some(_line(r"VERSION\s+(\S+)"), _line(r"ACCESSION\s+(\S+)")).alias("accession"),
        some(F.regexp_extract("value", r'/db_xref="taxon:(\d+)"', 1)).alias("host_taxid"),
        F.coalesce(some(F.regexp_extract("value", r'/organism="([^"]+)"', 1), F.trim(_line(r"\s*ORGANISM\s+([^\r\n]+)"))), F.lit("")).alias("organism"),
        F.coalesce(some(F.regexp_extract("value", r"(?mi)^LOCUS\s+\S+\s+(\d+)\s+bp", 1)).cast("bigint"), F.length(seq).cast("bigint")).alias("length"),
        seq.alias("sequence"),
    )
    return out.where("accession is not null and host_taxid is not null")


def read_gbff(spark: SparkSession, path: str) -> DataFrame:
    """A folder of flat files; gzip is read as it is, the record mark ``//`` splits them, a last record without one counts."""
    raw = spark.read.option("lineSep", "\n//").option("pathGlobFilter", GBFF_GLOB).text(path)
    return gbff_records(raw.select(F.regexp_replace("value", r"^[^\n]*\n(?=LOCUS)", "").alias("value")).where(F.trim("value") != ""))


def unzip_archives(spark: SparkSession, path: str, inner: str = "ncbi_dataset/data/") -> DataFrame:
    """``archive, name, text`` of the files under ``inner`` in the zip archives of a folder, an archive a task's row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for n in sorted(z.namelist()):
                            if n.startswith(inner) and not n.endswith("/"):
                                yield pd.DataFrame({"archive": [p], "name": [n[len(inner) :]], "text": [z.read(n).decode("utf-8", "replace")]})
                except zipfile.BadZipFile:
                    continue

    return files.mapInPandas(run, "archive string, name string, text string")


def sequence_table(records: DataFrame) -> DataFrame:
    """``header_id, seq, length`` ready to be written; sequences in upper case, null ones as empty text."""
    seq = F.upper(F.coalesce("seq", F.lit("")))
    return records.select("header_id", seq.alias("seq"), F.length(seq).cast("bigint").alias("length"))


def look_up(keys: DataFrame, sequences: DataFrame, key: str = "header_id") -> DataFrame:
    """``keys`` with ``seq``; what is missing has the empty sequence."""
    s = sequences.select(F.col("header_id").alias("__h"), F.upper("seq").alias("seq"))
    return keys.join(s, F.col(key) == F.col("__h"), "left").drop("__h").withColumn("seq", F.coalesce("seq", F.lit("")))
