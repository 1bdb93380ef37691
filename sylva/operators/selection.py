"""Which accessions to fetch: size proxies per label, pending volume, selection until a need is met."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.operators.hierarchy import in_scope
from sylva.session import cut

MAX_ATTEMPTS = 3


def pending(accessions: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Not downloaded, not deferred, fewer than ``max_attempts`` attempts; nulls count as false and 0."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return accessions.where(~flag("downloaded") & ~flag("download_deferred") & (F.coalesce("download_attempts", F.lit(0)) < max_attempts))


def credited(accessions: DataFrame, lineages: DataFrame) -> DataFrame:
    """One row per accession and label it counts for: its taxid and every ancestor, each once. Accessions without a lineage count for their taxid only."""
    joined = accessions.join(lineages.select("taxid", "path"), "taxid", "left")
    labels = F.array_distinct(F.concat(F.array("taxid"), F.coalesce(F.transform("path", lambda x: x["taxid"]), F.array().cast("array<string>"))))
    return joined.where("taxid is not null").withColumn("label", F.explode(labels)).drop("path")


def size_proxy(accessions: DataFrame, lineages: DataFrame) -> DataFrame:
    """``label, capacity``: summed positive lengths of a label's accessions; labels without any are left out."""
    return credited(accessions.where("length > 0"), lineages).groupBy("label").agg(F.sum("length").alias("capacity"))


def label_index(accessions: DataFrame, lineages: DataFrame) -> DataFrame:
    """``label, downloaded_size, n_pending, pending_size, n_deferred``."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    size = F.coalesce("length", F.lit(0))
    open_ = ~flag("downloaded")
    return credited(accessions, lineages).groupBy("label").agg(
        F.sum(F.when(~open_, size).otherwise(0)).alias("downloaded_size"),
        F.count_if(open_).alias("n_pending"),
        F.sum(F.when(open_, size).otherwise(0)).alias("pending_size"),
        F.count_if(open_ & flag("download_deferred")).alias("n_deferred"),
    )


def pending_volume(accessions: DataFrame) -> DataFrame:
    """One row: accessions not downloaded and their summed length, each accession once."""
    open_ = accessions.where(~F.coalesce("downloaded", F.lit(False))).groupBy("accession").agg(F.max(F.coalesce("length", F.lit(0))).alias("length"))
    return open_.agg(F.count(F.lit(1)).alias("n_pending"), F.coalesce(F.sum("length"), F.lit(0)).alias("pending_size"))


def select_until(candidates: DataFrame, group: str, need: str) -> DataFrame:
    """Candidates of each group, references first, then the longest, until ``need`` is met; the one that crosses it is taken too.

    Ties go by accession. Nothing is taken where the need is 0 or less, or null.
    """
    w = Window.partitionBy(group).orderBy(F.coalesce("is_reference", F.lit(False)).desc(), F.coalesce("length", F.lit(0)).desc(), "accession").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.coalesce("length", F.lit(0))).over(w), F.lit(0))
    return candidates.withColumn("taken_before", before).where(F.col("taken_before") < F.col(need))


def scope_pending(accessions: DataFrame, lineages: DataFrame, domain: str | None) -> DataFrame:
    """Accessions not downloaded yet whose lineage holds the domain; without a domain all with a lineage."""
    inside = lineages.where(in_scope("path", domain)).select("taxid").distinct()
    return accessions.where(~F.coalesce("downloaded", F.lit(False))).join(inside, "taxid", "left_semi")


def shortfalls(capacities: DataFrame, targets: DataFrame) -> DataFrame:
    """``label, capacity, target, missing`` of labels below their target; an unmeasured label has capacity 0."""
    return targets.join(capacities, "label", "left").select("label", F.coalesce("capacity", F.lit(0)).alias("capacity"), "target").where("capacity < target").withColumn("missing", F.col("target") - F.col("capacity"))


def defer(accessions: DataFrame, selected: DataFrame) -> DataFrame:
    """Pending accessions that weren't selected get download_deferred; selected ones lose it. Downloaded ones stay as they are."""
    mark = selected.select("accession").distinct().withColumn("__s", F.lit(True))
    j = accessions.join(mark, "accession", "left")
    deferred = F.when(F.coalesce("downloaded", F.lit(False)), F.coalesce("download_deferred", F.lit(False))).otherwise(F.col("__s").isNull())
    return j.withColumn("download_deferred", deferred).drop("__s")


def selective_download(accessions: DataFrame, lineages: DataFrame, targets: DataFrame) -> DataFrame:
    """``accessions`` with ``download_deferred`` set anew: what no label needs to reach its target, beyond what is downloaded already, is deferred.

    ``targets(label, target)``. References go first, then the longest, per label; an accession that any of its labels needs is fetched.
    """
    fresh = accessions.withColumn("download_deferred", F.lit(False))
    have = label_index(fresh, lineages).select("label", F.col("downloaded_size").alias("capacity"))
    need = shortfalls(have, targets).select("label", F.col("missing").alias("need"))
    wanted = select_until(credited(pending(fresh), lineages).join(need, "label"), "label", "need")
    return defer(fresh, wanted)


#: Rounds after which a refinement ends, whatever is missing.
ROUNDS = 5


def refine(accessions: DataFrame, lineages: DataFrame, targets: DataFrame, measure: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``accessions`` with fewer of them deferred, after at most ``rounds`` rounds of fetching and measuring.

    ``measure`` fetches what isn't deferred and returns ``label, capacity`` as found. Labels below their target take back deferred accessions until the
    gap is covered or none are left; a round in which nothing is missing, or nothing can be taken back, is the last. Each round is a checkpoint.
    """
    now = accessions
    for _ in range(rounds):
        short = shortfalls(measure(now), targets).select("label", F.col("missing").alias("need"))
        deferred = now.where(F.coalesce("download_deferred", F.lit(False)))
        back = cut(select_until(credited(deferred, lineages).join(short, "label"), "label", "need").select("accession").distinct())
        if back.isEmpty():
            break
        mark = back.withColumn("__b", F.lit(True))
        now = cut(now.join(mark, "accession", "left").withColumn("download_deferred", F.coalesce("download_deferred", F.lit(False)) & F.col("__b").isNull()).drop("__b"))
    return now


#: Published planning factors of what a base takes in the store, while windows are counted, and as output; megabytes a second from slow to fast; seconds an accession.
SIZES = {"store": 1.5, "spill": 3.0, "output": 0.05}
SPEEDS = {"download": (5, 20), "analysis": (2, 20)}
BUILD_SECONDS = (0.2, 1.0)


def preflight(accessions: DataFrame) -> DataFrame:
    """One row: what fetching all pending accessions and building from them will take, in bytes and seconds from best to worst; planning factors, not measurements."""
    p = pending(accessions).agg(F.count(F.lit(1)).alias("n_accessions"), F.coalesce(F.sum(F.greatest(F.coalesce("length", F.lit(0)), F.lit(0))), F.lit(0)).alias("raw_bytes"))
    raw, n = F.col("raw_bytes"), F.col("n_accessions")
    sizes = {f"{k}_bytes": F.floor(raw * v).cast("bigint") for k, v in SIZES.items()}
    times = {f"{k}_seconds_{w}": F.round(raw / (v * 1e6), 3) for k, (slow, fast) in SPEEDS.items() for w, v in (("best", fast), ("worst", slow))}
    return p.withColumns(sizes).withColumns(times).withColumns({"build_seconds_best": F.round(n * BUILD_SECONDS[0], 3), "build_seconds_worst": F.round(n * BUILD_SECONDS[1], 3)})
