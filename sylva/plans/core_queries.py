"""Queries of the general problems 2 and 3 over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions.text import taxid_number
from sylva.operators import incremental
from sylva.operators.latest import latest
from sylva.operators.tree_aggregate import tree_aggregate, tree_median
from sylva.session import shared_dir, table, written


def _state(df: DataFrame) -> DataFrame:
    return df.select("accession", F.coalesce("downloaded", F.lit(False)).alias("downloaded"), F.when(F.col("local_path") != "", F.col("local_path")).alias("local_path"))


def registry_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(latest(table(spark, sf_dir, "accessions"), ["accession"], ["last_update"], ["downloaded", "local_path"]))


def logged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What successful runs last logged: sync_runs has a fixed number of rows, so it is broadcast."""
    good = table(spark, sf_dir, "sync_runs").where("status = 'success'").select("run_id").distinct()
    log = table(spark, sf_dir, "sync_log").where("accession is not null").join(F.broadcast(good), "run_id", "left_semi")
    return _state(latest(log, ["accession"], ["run_id", "logged_at"], ["downloaded", "local_path"]))


_KEYS, _VALUES = ["accession"], ["downloaded", "local_path"]
_CHANGE = "accession string, downloaded boolean, local_path string"


def _p2_store(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/p2-{uuid.uuid4().hex}"


def _p2_run(now: DataFrame, before: DataFrame, store: str, on_written: Callable[[], None] | None = None) -> None:
    """One run over the registry: the records of changed partitions that differ from what was logged come out."""
    work = lambda part: incremental.differing_rows(part, incremental.handled_now(before, _KEYS, store), _KEYS, _VALUES)
    incremental.run_incremental(now, _KEYS, _VALUES, store, work, on_written=on_written)


def p2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records a run must handle, with the state it has to bring about: what successful runs logged is taken as handled, then one run is made."""
    now, before, store = written(registry_state(spark, sf_dir)), written(logged_state(spark, sf_dir)), _p2_store(spark)
    incremental.adopt(before, _KEYS, _VALUES, store)
    _p2_run(now, before, store)
    return incremental.output(spark, store, _CHANGE)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_changes(spark, sf_dir).select("accession")


class Lost(RuntimeError):
    """The driver of a run is lost."""


def p2_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``p2_changes``, after a run over the oldest rows of the registry that was lost between its output and its fingerprints."""
    old = table(spark, sf_dir, "accessions").groupBy("accession").agg(F.min(F.struct("last_update", "downloaded", "local_path")).alias("m"))
    first = written(_state(old.select("accession", "m.downloaded", "m.local_path")))
    now, before, store = written(registry_state(spark, sf_dir)), written(logged_state(spark, sf_dir)), _p2_store(spark)
    incremental.adopt(before, _KEYS, _VALUES, store)

    def lost() -> None:
        raise Lost

    try:
        _p2_run(first, before, store, lost)
    except Lost:
        pass
    _p2_run(now, before, store)
    return incremental.output(spark, store, _CHANGE)


def _current_taxids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``accession, taxid, length`` of current rows, written once: all aggregates below read this table, and counting it reads no rows."""
    rows = latest(table(spark, sf_dir, "accessions"), ["accession"], ["last_update"], ["taxid", "total_sequence_length"])
    return written(rows.select("accession", taxid_number("taxid").alias("taxid"), F.when(F.col("total_sequence_length") > 0, F.col("total_sequence_length")).alias("length")))


def p3_per_taxid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count of accessions, sum and median of their positive lengths, for each taxid (accessions without one form the group null)."""
    rows = _current_taxids(spark, sf_dir)
    totals = tree_aggregate(rows, ["taxid"], ["accession"], {"n_accessions": ("sum", F.lit(1).cast("bigint")), "sum_length": ("sum", F.col("length"))})
    middle = tree_median(rows, ["taxid"], "length", ["accession"]).select(F.col("taxid").alias("__t"), F.col("median").alias("median_length"))
    return totals.join(middle, F.col("taxid").eqNullSafe(F.col("__t")), "left").select("taxid", "n_accessions", "sum_length", "median_length")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _current_taxids(spark, sf_dir)
    counts = tree_aggregate(rows, ["taxid"], ["accession"], {"n": ("sum", F.lit(1).cast("bigint"))})
    return counts.where(F.col("taxid").isNotNull() & (F.col("n") * 100 >= rows.count())).select("taxid")


_CURRENT = "SELECT DISTINCT ON (accession) * FROM accessions ORDER BY accession, last_update DESC NULLS LAST"
_TAXID = "CAST(nullif(regexp_extract({}, '[0-9]+'), '') AS BIGINT)"
_P2 = f"""
WITH now AS (SELECT accession, coalesce(downloaded, false) AS downloaded, nullif(local_path, '') AS local_path FROM ({_CURRENT})),
logged AS (SELECT DISTINCT ON (accession) accession, coalesce(downloaded, false) AS downloaded, nullif(local_path, '') AS local_path
  FROM sync_log WHERE run_id IN (SELECT run_id FROM sync_runs WHERE status = 'success') ORDER BY accession, run_id DESC, logged_at DESC NULLS LAST)
SELECT {{}} FROM now LEFT JOIN logged USING (accession)
WHERE logged.accession IS NULL OR now.downloaded IS DISTINCT FROM logged.downloaded OR now.local_path IS DISTINCT FROM logged.local_path
"""

_P2_STATE = "now.accession AS accession, now.downloaded AS downloaded, now.local_path AS local_path"

QUERIES = {"p2_found": p2_found, "p2_changes": p2_changes, "p2_recovered": p2_recovered, "p3_found": p3_found, "p3_per_taxid": p3_per_taxid}
ORACLE = {
    "p2_found": _P2.format("now.accession"),
    "p2_changes": _P2.format(_P2_STATE),
    "p2_recovered": _P2.format(_P2_STATE),
    "p3_found": f"""WITH t AS (SELECT {_TAXID.format('taxid')} AS taxid, count(*) AS n FROM ({_CURRENT}) GROUP BY 1)
SELECT taxid FROM t WHERE taxid IS NOT NULL AND n * 100 >= (SELECT sum(n) FROM t)""",
    "p3_per_taxid": f"""SELECT {_TAXID.format('taxid')} AS taxid, count(*) AS n_accessions,
CAST(sum(CASE WHEN total_sequence_length > 0 THEN total_sequence_length END) AS BIGINT) AS sum_length,
CAST(median(CASE WHEN total_sequence_length > 0 THEN total_sequence_length END) AS DOUBLE) AS median_length FROM ({_CURRENT}) GROUP BY 1""",
}
