"""Queries over operators whose draws are random, reduced to what SQL can say about their results; and sources and sinks read back.

Every query runs the operator over its whole tables; only what is compared is reduced: counts, budgets met, and rules broken, of which there must be none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions import sketch
from sylva.functions.sequence import reverse_complement
from sylva.operators import audit, openset, sampling, selection, similarity, splitting, windows
from sylva.plans import base
from sylva.plans import dataset_queries as dq
from sylva.plans import hierarchy_queries as hq
from sylva.session import shared_dir, table, written
from sylva.sources import predictions, registry, release


def _split_checks(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Per class: windows, genomes cut although they were to stay whole, and whether all splits are filled where there are three genomes."""
    torn = rows.where("start_pct = 0 and end_pct = 1").groupBy("child", "genome_key").agg(F.count_distinct("split").alias("s")).groupBy("child").agg(F.count_if(F.col("s") > 1).alias("torn"))
    c = rows.groupBy("child").agg(F.sum("n").alias("n"), F.count_distinct("split").alias("splits"))
    g = whole.groupBy("child").agg(F.count_distinct("genome_key").alias("genomes"))
    out = c.join(g, "child").join(torn, "child", "left")
    return out.select("child", "n", "genomes", F.coalesce("torn", F.lit(0)).alias("torn"), F.when(F.col("genomes") >= 3, F.col("splits") == 3).alias("filled"))


def class_split_checks(s: SparkSession, d: str) -> DataFrame:
    return _split_checks(written(dq.class_splits(s, d)), dq._tasks(s, d))


def negative_split_checks(s: SparkSession, d: str) -> DataFrame:
    return _split_checks(written(dq.negative_splits(s, d)), dq._tasks(s, d)).select("child", "n", "genomes", "torn")


def genome_split_repaired(s: SparkSession, d: str) -> DataFrame:
    """Whole genomes with the repair: classes of three genomes or more fill every split."""
    t = dq._tasks(s, d)
    v = splitting.split_volumes(splitting.assign_genomes(t))
    return v.groupBy("child").agg(F.sum("genomes").alias("genomes"), F.sum("windows").alias("windows"), F.count(F.lit(1)).alias("splits")).where("genomes >= 3")


def _slice_tasks(s: SparkSession, d: str) -> DataFrame:
    t = splitting.window_slices(dq._tasks(s, d))
    return t.select(F.col("child").alias("head"), "split", "class_idx", "header_id", "n", "start_pct", "end_pct")


def slice_sample_counts(s: SparkSession, d: str) -> DataFrame:
    """Per task its law and whether it got its windows: exactly n of the tiled laws; of the random one at most n, all different, and n where ten times as many exist."""
    t, p = _slice_tasks(s, d), sampling.DrawParams(10, dq.MAX_LEN)
    got = sampling.extract(t, base.sequences(s, d), p).groupBy("head", "header_id", "split").agg(F.count(F.lit(1)).alias("got"), F.count_distinct("seq").alias("different"), F.count_distinct("i").alias("places"))
    lengths = base.sequences(s, d).select("header_id", F.length("seq").alias("l"))
    j = t.join(lengths, "header_id").withColumn("l", (F.floor(F.col("l") * F.col("end_pct")) - F.floor(F.col("l") * F.col("start_pct"))).cast("int")).join(got, ["head", "header_id", "split"], "left").fillna(0)
    law = sampling.strategy("l", "n", p)
    return j.withColumn("law", law).where("law is not null").select(
        "head", "header_id", "split", "law", F.when(F.col("law") != "bounded_random", F.col("got")).otherwise(F.col("n")).alias("n"),
        ((F.col("got") <= F.col("n")) & (F.col("places") == F.col("got")) & ((F.col("law") != "bounded_random") | (F.col("different") == F.col("got")))).alias("within"), (F.col("got") > 0).alias("some"),
    )


def samples_are_windows(s: SparkSession, d: str) -> DataFrame:
    """Per split: samples that are no window of their sequence, on neither strand, or of a length outside the limits."""
    x = dq.samples(s, d).join(base.sequences(s, d).select("header_id", F.col("seq").alias("whole")), "header_id")
    inside = F.contains("whole", F.col("seq")) | F.contains("whole", reverse_complement("seq"))
    return x.groupBy("split").agg(F.count_if(~inside | ~F.length("seq").between(10, dq.MAX_LEN)).alias("wrong"))


def substitution_counts(s: SparkSession, d: str) -> DataFrame:
    """Places changed of every sequence of bases only, at a rate of 5 percent."""
    q = base.sequences(s, d).where(F.col("seq").rlike("^[ACGT]+$")).select("header_id", "seq", sampling.substitute("seq", 0.05, 42, F.col("header_id")).alias("new"))
    changed = F.size(F.filter(F.zip_with(F.split("seq", ""), F.split("new", ""), lambda a, b: a != b), lambda x: x))
    return q.select("header_id", F.length("new").alias("length"), changed.alias("changed"))


def exact_reads(s: SparkSession, d: str) -> DataFrame:
    """Reads of a model without errors are the sequences."""
    return sampling.noisy_reads(base.sequences(s, d).select(F.col("header_id").alias("read_id"), "seq"), sampling.ErrorModel(0.0, 0.0, 0.0))


def noisy_read_rates(s: SparkSession, d: str) -> DataFrame:
    """One row: whether all reads together are as long as insertions and deletions leave them, and no letter is new."""
    q = base.sequences(s, d).where(F.col("seq").rlike("^[ACGT]+$")).select(F.col("header_id").alias("read_id"), "seq")
    r = sampling.noisy_reads(q, sampling.ErrorModel(insertion=0.05, deletion=0.0, homopolymer_boost=1.0))
    n = q.agg(F.sum(F.length("seq"))).scalar()
    return r.agg((F.abs(F.sum(F.length("seq")) / n - 1.05) < 0.01).alias("as_long"), F.count_if(~F.col("seq").rlike("^[ACGT]+$")).alias("strange"))


def augmented_counts(s: SparkSession, d: str) -> DataFrame:
    """Per split: how many times as many rows there are with augmentation."""
    x = written(_sampled(s, d))
    a = sampling.augment_train(x, 0.05).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return a.join(x.groupBy("split").agg(F.count(F.lit(1)).alias("m")), "split").select("split", (F.col("n") / F.col("m")).cast("int").alias("times"))


def _sampled(s: SparkSession, d: str) -> DataFrame:
    return sampling.extract(_slice_tasks(s, d), base.sequences(s, d), sampling.DrawParams(10, dq.MAX_LEN))


def pool_checks(s: SparkSession, d: str) -> DataFrame:
    """Per head: sizes of its pools, and leaves in them that lie under the head."""
    zero, one = F.lit(0), F.lit(1)
    pools = dq.near_far_pools(s, d).select("head", "leaf", (F.col("pool") == "near").cast("int").alias("near"), (F.col("pool") == "far").cast("int").alias("far"), zero.alias("own"))
    own = dq._leaf_closure(s, d).select(F.col("ancestor").alias("head"), "leaf").join(dq._heads(s, d).select("head"), "head", "left_semi").select("head", "leaf", zero.alias("near"), zero.alias("far"), one.alias("own"))
    each = pools.unionByName(own).groupBy("head", "leaf").agg(F.sum("near").alias("near"), F.sum("far").alias("far"), F.max("own").alias("own"))
    drawn = F.col("near") + F.col("far")
    j = each.groupBy("head").agg(F.sum("near").alias("n_near"), F.sum("far").alias("n_far"), F.sum(F.when(F.col("own") == 1, drawn).otherwise(0)).alias("inside"), F.sum(F.greatest(drawn - 1, F.lit(0).cast("bigint"))).alias("repeated"))
    return j.where("n_near + n_far > 0")


def _pool_budgets(s: SparkSession, d: str) -> DataFrame:
    b = dq.reject_budgets(s, d)
    return b.select("head", F.explode(F.array(F.struct(F.lit("near").alias("pool"), F.col("near").alias("budget")), F.struct(F.lit("far").alias("pool"), F.col("far").alias("budget")))).alias("x")).select("head", "x.pool", "x.budget")


def reject_task_checks(s: SparkSession, d: str) -> DataFrame:
    """Per head: pools that hold windows and yet don't meet their budget, or hold none and have tasks."""
    pools = written(dq._weighted_pools(s, d))
    room = pools.groupBy("head", "pool").agg(F.sum("weight").alias("room"))
    made = dq.reject_tasks(s, d, pools).groupBy("head", "pool").agg(F.sum("n").alias("n"))
    j = _pool_budgets(s, d).join(room, ["head", "pool"], "left").join(made, ["head", "pool"], "left").fillna(0)
    return j.groupBy("head").agg(F.count_if(F.col("n") != F.when(F.col("room") > 0, F.col("budget")).otherwise(0)).alias("unmet"))


def reject_provenance_checks(s: SparkSession, d: str) -> DataFrame:
    p = dq.reject_provenance(s, d).join(_pool_budgets(s, d), ["head", "pool"])
    return p.select("head", "pool", "pool_leaves", F.col("windows").isin(F.lit(0), F.col("budget")).alias("met"))


def dereplication_checks(s: SparkSession, d: str) -> DataFrame:
    """One row: genomes, kept ones that resemble each other, dropped ones that resemble none that is kept."""
    rows = written(dq.dereplicated(s, d))
    reps = similarity.sketch_classes(dq._md5_sketches(s, d), "taxid", "header_id")
    kept = rows.where("kept_as = header_id").select("taxid", "header_id")
    near = written(similarity.similar_pairs(dq._md5_sketches(s, d), "taxid", "header_id", 0.1, 50))
    one = near.join(kept.select("taxid", F.col("header_id").alias("a")), ["taxid", "a"], "left_semi").join(kept.select("taxid", F.col("header_id").alias("b")), ["taxid", "b"], "left_semi")
    both = near.select("taxid", "a", "b").unionByName(near.select("taxid", F.col("b").alias("a"), F.col("a").alias("b")))
    why = rows.where("kept_as <> header_id").join(reps, ["taxid", "header_id"]).where("rep <> kept_as").join(both.select("taxid", F.col("a").alias("rep"), F.col("b").alias("kept_as")), ["taxid", "rep", "kept_as"], "left_anti")
    return rows.agg(F.count(F.lit(1)).alias("genomes")).select("genomes", one.agg(F.count(F.lit(1))).scalar().alias("alike"), why.agg(F.count(F.lit(1))).scalar().alias("unlike"))


def holdout_members(s: SparkSession, d: str) -> DataFrame:
    return dq.holdout_manifest(s, d).select("taxid", "rank", "n_genomes", F.array_join("member_headers", ",").alias("members"), "expected_commit_taxid", "expected_commit_rank")


def evaluation_read_checks(s: SparkSession, d: str) -> DataFrame:
    """Per held-out clade: its reads, and those that aren't part of their sequence or have another lineage than its taxid."""
    q = base.sequences(s, d).select(F.col("header_id").alias("source_header"), F.col("seq").alias("whole"))
    r = dq.evaluation_reads(s, d).join(q, "source_header")
    wrong = ~F.contains("whole", F.col("seq")) | (F.length("seq") != 50) | (F.get(openset.lineage_ids("true_lineage"), F.lit(0)) != F.col("true_leaf_taxid"))
    return r.groupBy("held_out_taxid").agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong"))


def capacity_error(s: SparkSession, d: str) -> DataFrame:
    """Approximate capacities that are off by more than 5 percent and one window."""
    q = base.sequences(s, d).where("taxid is not null")
    a = windows.capacity_approximate(q, ["taxid"], "seq", hq.K).withColumnRenamed("capacity", "near")
    j = windows.capacity(q, ["taxid"], "seq", hq.K).join(a, "taxid", "full")
    return j.select("taxid", F.coalesce(F.abs(F.col("capacity") - F.col("near")) > 0.05 * F.col("capacity") + 1, F.lit(True)).alias("off"))


def ani_proxies(s: SparkSession, d: str) -> DataFrame:
    """Identity and its bin for every pair of similar genomes."""
    p = dq.similar_genomes(s, d)
    ani = sketch.ani_proxy("jaccard", 7)
    return p.select("taxid", "a", "b", F.round(ani, 6).alias("ani"), sketch.ani_bin(F.round(ani, 6)).alias("bin"))


# --- sources and sinks read back --------------------------------------------------------------------------


def _folder(s: SparkSession) -> str:
    return f"{shared_dir(s)}/check-{uuid.uuid4().hex}"


#: Accessions of a part of the catalogue document: a part is one value, in memory as a whole where it is written and read.
ENTRIES = 20_000


def _document(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The catalogue of the test tables written as a JSON document and read back: one file up to ``ENTRIES`` accessions, and as many as that takes beyond; an entry is in one of them."""
    a = base.accessions(s, d).withColumn("headers", F.array(F.struct(F.concat("accession", F.lit("_h")).alias("id"), F.col("taxid").alias("name"))))
    a = written(a)
    n = max(1, -(-a.count() // ENTRIES))
    part = lambda key: F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("part")
    entry = F.struct("accession", F.struct("taxid", "is_reference", F.col("length").alias("total_sequence_length"), "downloaded", "download_deferred", "download_attempts", "headers").alias("v"))
    acc = a.groupBy(part("accession")).agg(F.map_from_entries(F.collect_list(entry)).alias("accessions"), F.collect_set(F.when(F.coalesce("cross_domain", F.lit(False)), F.col("accession"))).alias("cross_domain_negatives"))
    of = a.where("taxid is not null").groupBy("taxid").agg(F.array_sort(F.collect_list("accession")).alias("l")).groupBy(part("taxid")).agg(F.map_from_entries(F.collect_list(F.struct("taxid", "l"))).alias("taxons"))
    lin = base.lineages(s, d).groupBy(part("taxid")).agg(F.map_from_entries(F.collect_list(F.struct("taxid", "path"))).alias("lineages"))
    path = _folder(s)
    whole = acc.join(of, "part", "full").join(lin, "part", "full")
    whole.select("part", F.to_json(F.struct("accessions", "cross_domain_negatives", "taxons", "lineages")).alias("value")).write.partitionBy("part").text(path)
    return registry.read_registry(s, path)


def catalogue_document(s: SparkSession, d: str) -> DataFrame:
    return _document(s, d)["accession"].select("accession", "taxid", "is_reference", F.col("total_sequence_length").alias("length"), "downloaded", "download_attempts", "cross_domain", F.get("headers", F.lit(0))["id"].alias("header"))


def catalogue_lineages(s: SparkSession, d: str) -> DataFrame:
    return _document(s, d)["lineage"].select("taxid", F.size("path").alias("n"), F.array_join(F.transform("path", lambda x: F.concat_ws(":", x["taxid"], x["rank"], x["name"])), ";").alias("path"))


def catalogue_taxa(s: SparkSession, d: str) -> DataFrame:
    return _document(s, d)["taxon_acc"].select("taxid", "accession", "ord")


def reconciled_catalogue(s: SparkSession, d: str) -> DataFrame:
    """Accessions stay downloaded only if a sequence of theirs is stored; stored are those whose spelling hashes low."""
    a = table(s, d, "accessions", ["accession", "downloaded", "last_update", "headers"])
    now = a.groupBy("accession").agg(F.max(F.struct("last_update", "downloaded", "headers")).alias("m")).select("accession", "m.downloaded", "m.headers")
    h = now.select(F.explode("headers").alias("h")).select(F.col("h.id").alias("header_id")).where(F.md5(F.col("header_id").cast("binary")) < "8")
    return registry.reconcile(now, h).select("accession", "downloaded")


def capacity_cache(s: SparkSession, d: str) -> DataFrame:
    """Cached size proxies after new accessions arrived for taxa whose number divides by 50."""
    caps = hq.size_proxy(s, d).select(F.col("label").alias("taxid"), F.lit(100).alias("min_len"), "capacity")
    changed = base.accessions(s, d).where(F.col("taxid").cast("bigint") % 50 == 0).select("taxid")
    return registry.cached_capacities(caps, changed, base.lineages(s, d))


def sample_sink(s: SparkSession, d: str) -> DataFrame:
    """Names of classes as samples: written by head and split, partly replaced, and read back."""
    c = dq._classes(s, d)
    rows = c.select(F.col("head"), F.when(F.col("class_idx") % 3 == 0, "train").when(F.col("class_idx") % 3 == 1, "val").otherwise("test").alias("split"), F.col("name").alias("seq"), "class_idx")
    path = _folder(s)
    predictions.write_samples(rows, path)
    predictions.write_samples(rows.where("split = 'val'").withColumn("seq", F.upper("seq")), path)
    return s.read.schema("seq string, class_idx int, head string, split string").parquet(path).select("head", "split", "class_idx", "seq")


def predictions_file(s: SparkSession, d: str) -> DataFrame:
    """Predictions written as tab-separated text and read back; empty ones abstain."""
    path = f"{_folder(s)}.tsv"
    p = dq._predictions(s, d).select("read_id", F.when(F.length("predicted_taxid") % 2 == 0, F.lit(" ")).otherwise(F.col("predicted_taxid")).alias("predicted_taxid"), "predicted_rank")
    p.write.option("header", True).option("sep", "\t").csv(path)
    return predictions.read_predictions(s, path)


def reference_map(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d)
    kept = openset.retained_leaves(q.select("header_id", F.col("taxid").alias("node_id")).where("node_id is not null"), dq._node_closure(s, d), dq._held(s, d))
    return openset.reference_map(kept, q.select("header_id", "seq"))


def reference_sample(s: SparkSession, d: str) -> DataFrame:
    """The first hundred reference assemblies, of reports made of the catalogue."""
    a = base.accessions(s, d).select("accession", F.struct(F.when(F.coalesce("is_reference", F.lit(False)), "Chromosome").otherwise("Contig").alias("assembly_level")).alias("assembly_info"))
    return release.reference_sample(a, 100).select("accession")


def download_estimate(s: SparkSession, d: str) -> DataFrame:
    return selection.preflight(base.accessions(s, d))


def _targets(s: SparkSession, d: str) -> DataFrame:
    return base.info(s, d).where("rank in ('genus', 'family')").select(F.col("taxid").alias("label"), F.lit(20_000_000).alias("target"))


def selected_downloads(s: SparkSession, d: str) -> DataFrame:
    """Per label whether what is downloaded or to be fetched reaches its target, or all it has is taken."""
    a = selection.selective_download(base.accessions(s, d), base.lineages(s, d), _targets(s, d))
    c = selection.credited(a, base.lineages(s, d)).join(_targets(s, d), "label")
    have = F.coalesce("downloaded", F.lit(False))
    left = F.coalesce("download_deferred", F.lit(False)) & ~have & (F.coalesce("download_attempts", F.lit(0)) < selection.MAX_ATTEMPTS)
    size = F.coalesce("length", F.lit(0))
    got = F.sum(F.when(have | ~F.coalesce("download_deferred", F.lit(False)), size).otherwise(0))
    return c.groupBy("label").agg(((got >= F.max("target")) | (F.count_if(left) == 0)).alias("served"))


def refined_downloads(s: SparkSession, d: str) -> DataFrame:
    """Accessions deferred after refinement, where labels turn out to hold half of what their sizes promise; none of a label that is still short."""
    lin, targets = base.lineages(s, d), _targets(s, d)
    first = written(selection.selective_download(base.accessions(s, d), lin, targets))
    size = F.when(~F.coalesce("download_deferred", F.lit(False)), F.coalesce("length", F.lit(0))).otherwise(0)
    measure = lambda now: selection.credited(now, lin).groupBy("label").agg(F.floor(F.sum(size) / 2).cast("bigint").alias("capacity"))
    last = selection.refine(first, lin, targets, measure)
    left = selection.credited(last.where("download_deferred"), lin).groupBy("label").agg(F.count(F.lit(1)).alias("left"))
    return selection.shortfalls(measure(last), targets).join(left, "label").agg(F.count(F.lit(1)).alias("short_with_deferred"))


def composition_enriched(s: SparkSession, d: str) -> DataFrame:
    """Label maps of the heads with their audit."""
    c = audit.composition(dq._class_seqs(s, d)).withColumn("is_virtual", F.col("class_idx").cast("bigint") % 2 == 0)
    maps = base.paths(s, d).select(F.get("ids", F.lit(0)).alias("head")).distinct()
    e = audit.enrich(maps, audit.composition_summary(audit.audit(c)), "composition_audit")
    return e.select("head", "composition_audit.n_classes", "composition_audit.n_virtual", "composition_audit.n_flagged", F.size("composition_audit.flagged").alias("n_listed"), F.round("composition_audit.canonical_gc_mean", 6).alias("gc_mean"))


QUERIES = {
    f.__name__: f
    for f in (
        class_split_checks, negative_split_checks, genome_split_repaired, slice_sample_counts, samples_are_windows, substitution_counts, exact_reads, noisy_read_rates, augmented_counts, pool_checks, reject_task_checks, reject_provenance_checks,
        dereplication_checks, holdout_members, evaluation_read_checks, capacity_error, ani_proxies, catalogue_document, catalogue_lineages, catalogue_taxa, reconciled_catalogue, capacity_cache, sample_sink, predictions_file, reference_map, reference_sample, download_estimate, selected_downloads, refined_downloads, composition_enriched,
    )
}
_GENOMES = "gn AS (SELECT child, count(DISTINCT substr(header_id, 1, 8)) AS genomes, CAST(sum(n) AS BIGINT) AS n FROM alloc WHERE n > 0 GROUP BY 1)"
_SLICES = f"""{dq._ALLOC}, c AS (SELECT *, {dq._COUNTS.format(n='n')} AS c FROM alloc WHERE n > 0), u AS (SELECT child, header_id, length, unnest(c) AS n, generate_subscripts(c, 1) AS i FROM c),
sl AS (SELECT child AS head, header_id, ['train', 'val', 'test'][i] AS split, n, CAST(floor(length * CASE WHEN i < 3 THEN i / 3 ELSE 1.0 END) - floor(length * ((i - 1) / 3)) AS BIGINT) AS l FROM u WHERE n > 0),
law AS (SELECT *, CASE WHEN l < 10 THEN NULL WHEN l >= 40 * n THEN 'non_overlapping' WHEN l >= 20 * n AND l // 20 - n <= 0 THEN 'contiguous' WHEN l >= 20 * n THEN 'flanked' ELSE 'bounded_random' END AS law FROM sl)"""
_BUDGETS = dq.ORACLE["reject_budgets"]
_SIZES = dq.ORACLE["near_pool_sizes"]
_REC = "SELECT DISTINCT ON (accession) accession, downloaded, headers FROM accessions ORDER BY accession, last_update DESC NULLS LAST, downloaded DESC NULLS LAST"
ORACLE = {
    "class_split_checks": f"WITH {dq._ALLOC}, {_GENOMES} SELECT child, n, genomes, 0 AS torn, CASE WHEN genomes >= 3 THEN true END AS filled FROM gn",
    "negative_split_checks": f"WITH {dq._ALLOC}, {_GENOMES} SELECT child, n, genomes, 0 AS torn FROM gn",
    "genome_split_repaired": f"WITH {dq._ALLOC}, {_GENOMES} SELECT child, genomes, n AS windows, 3 AS splits FROM gn WHERE genomes >= 3",
    "slice_sample_counts": f"WITH {_SLICES} SELECT head, header_id, split, law, n, true AS within, true AS some FROM law WHERE law IS NOT NULL",
    "samples_are_windows": "SELECT unnest(['train', 'val', 'test']) AS split, 0 AS wrong",
    "substitution_counts": f"WITH {dq.SEQ} SELECT header_id, CAST(length(seq) AS INT) AS length, CAST(round_even(length(seq) * 0.05::DOUBLE, 0) AS INT) AS changed FROM seqs WHERE regexp_full_match(seq, '[ACGT]+')",
    "exact_reads": f"WITH {dq.SEQ} SELECT header_id AS read_id, seq FROM seqs",
    "noisy_read_rates": "SELECT true AS as_long, 0 AS strange",
    "augmented_counts": "SELECT unnest(['train', 'val', 'test']) AS split, unnest([2, 1, 1]) AS times",
    "pool_checks": f"SELECT head, least(n_near, 1000) AS n_near, least(n_far, 1000) AS n_far, 0 AS inside, 0 AS repeated FROM ({_SIZES})",
    "reject_task_checks": f"SELECT head, 0 AS unmet FROM ({_BUDGETS})",
    "reject_provenance_checks": f"SELECT head, pool, pool_leaves, true AS met FROM (SELECT head, unnest(['near', 'far']) AS pool, unnest([least(n_near, 1000), least(n_far, 1000)]) AS pool_leaves FROM ({_SIZES})) WHERE pool_leaves > 0",
    "dereplication_checks": f"WITH {dq.SEQ} SELECT count(*) AS genomes, 0 AS alike, 0 AS unlike FROM seqs WHERE taxid IS NOT NULL",
    "holdout_members": f"""WITH {dq._HELD}, m AS (SELECT ancestor AS taxid, count(DISTINCT header_id) AS n_genomes, string_agg(DISTINCT header_id, ',' ORDER BY header_id) AS members FROM seqs JOIN nc ON seqs.taxid = nc.node_id GROUP BY 1),
      up AS (SELECT node_id, arg_min(ancestor, (distance, ancestor)) AS rho FROM nc WHERE distance > 0 AND node_id IN (SELECT node_id FROM held) AND ancestor NOT IN (SELECT node_id FROM held) GROUP BY 1)
      SELECT h.node_id AS taxid, n.rank AS rank, n_genomes, members, rho AS expected_commit_taxid, r.rank AS expected_commit_rank FROM held h JOIN nodes n ON h.node_id = n.node_id LEFT JOIN m ON h.node_id = m.taxid LEFT JOIN up ON h.node_id = up.node_id LEFT JOIN nodes r ON rho = r.node_id""",
    "evaluation_read_checks": f"""WITH {dq._HELD} SELECT nc.ancestor AS held_out_taxid, 2 * count(DISTINCT header_id) AS n, 0 AS wrong FROM seqs JOIN nc ON seqs.taxid = nc.node_id WHERE nc.ancestor IN (SELECT node_id FROM held) AND length(seq) >= 50 GROUP BY 1""",
    "capacity_error": f"WITH {dq.SEQ} SELECT DISTINCT taxid, false AS off FROM seqs WHERE taxid IS NOT NULL AND length(seq) >= {hq.K}",
    "ani_proxies": f"""WITH {dq._PAIRS}, a AS (SELECT taxid, a, b, round(greatest(0.0, least(1.0, 1.0 + ln(2.0 * round(jaccard, 6) / (1.0 + round(jaccard, 6))) / 7.0)), 6) AS ani FROM pairs WHERE jaccard >= 0.05)
      SELECT *, CASE WHEN ani >= 0.95 THEN 'ANI>=95%' WHEN ani >= 0.90 THEN 'ANI 90-95%' WHEN ani >= 0.85 THEN 'ANI 85-90%' ELSE 'ANI<85%' END AS bin FROM a""",
    "catalogue_document": f"WITH {dq.ACC} SELECT accession, taxid, is_reference, length, downloaded, download_attempts, coalesce(cross_domain, false) AS cross_domain, accession || '_h' AS header FROM acc",
    "catalogue_lineages": f"WITH {dq.LIN} SELECT taxid, CAST(len(path) AS INT) AS n, array_to_string(list_transform(path, lambda x: concat_ws(':', x.taxid, x.rank, x.name)), ';') AS path FROM lin",
    "catalogue_taxa": f"WITH {dq.ACC} SELECT taxid, accession, row_number() OVER (PARTITION BY taxid ORDER BY accession) - 1 AS ord FROM acc WHERE taxid IS NOT NULL",
    "reconciled_catalogue": f"SELECT accession, coalesce(downloaded, false) AND len(list_filter(coalesce(headers, []), lambda h: md5(h.id) < '8')) > 0 AS downloaded FROM ({_REC})",
    "capacity_cache": f"""WITH {hq._CREDIT}, ch AS (SELECT DISTINCT taxid FROM acc WHERE CAST(taxid AS BIGINT) % 50 = 0), up AS (SELECT taxid FROM ch UNION SELECT unnest(list_transform(path, lambda x: x.taxid)) FROM lin WHERE taxid IN (SELECT taxid FROM ch))
      SELECT label AS taxid, 100 AS min_len, CAST(sum(length) AS BIGINT) AS capacity FROM credited WHERE length > 0 AND label NOT IN (SELECT taxid FROM up WHERE taxid IS NOT NULL) GROUP BY 1""",
    "sample_sink": f"WITH {dq._CLS} SELECT head, CASE class_idx % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, class_idx, CASE WHEN class_idx % 3 = 1 THEN upper(name) ELSE name END AS seq FROM cls",
    "predictions_file": f"WITH {dq._READS} SELECT read_id, CASE WHEN length(pt) % 2 = 1 THEN pt END AS predicted_taxid, nullif(trim(pr), '') AS predicted_rank FROM pd",
    "reference_map": f"WITH {dq._HELD} SELECT header_id || chr(9) || taxid AS value FROM seqs WHERE taxid IS NOT NULL AND taxid NOT IN (SELECT node_id FROM nc WHERE ancestor IN (SELECT node_id FROM held))",
    "reference_sample": f"WITH {dq.ACC} SELECT accession FROM acc WHERE is_reference ORDER BY accession LIMIT 100",
    "download_estimate": f"""WITH {dq.ACC}, p AS (SELECT count(*) AS n, coalesce(sum(greatest(coalesce(length, 0), 0)), 0) AS raw FROM acc WHERE {hq._PENDING})
      SELECT n AS n_accessions, CAST(raw AS BIGINT) AS raw_bytes, CAST(floor(raw * 1.5) AS BIGINT) AS store_bytes, CAST(floor(raw * 3.0) AS BIGINT) AS spill_bytes, CAST(floor(raw * 0.05::DOUBLE) AS BIGINT) AS output_bytes,
      round(raw / 20e6, 3) AS download_seconds_best, round(raw / 5e6, 3) AS download_seconds_worst, round(raw / 20e6, 3) AS analysis_seconds_best, round(raw / 2e6, 3) AS analysis_seconds_worst, round(n * 0.2::DOUBLE, 3) AS build_seconds_best, round(n * 1.0::DOUBLE, 3) AS build_seconds_worst FROM p""",
    "selected_downloads": f"WITH {hq._CREDIT}, {dq.INFO} SELECT DISTINCT label, true AS served FROM credited WHERE label IN (SELECT taxid FROM info WHERE m.rank IN ('genus', 'family'))",
    "refined_downloads": "SELECT 0 AS short_with_deferred",
    "composition_enriched": f"""WITH {dq._AUDIT}, h AS (SELECT DISTINCT ids[1] AS head FROM paths), a AS (SELECT head, count(*) AS n_classes, count(*) FILTER (is_virtual) AS n_virtual, count(*) FILTER (flagged) AS n_flagged FROM audit GROUP BY 1),
      g AS (SELECT head, round(avg(CASE WHEN NOT is_virtual THEN gc_mean END), 6) AS gc_mean FROM v GROUP BY 1) SELECT h.head AS head, n_classes, n_virtual, n_flagged, n_flagged AS n_listed, gc_mean FROM h LEFT JOIN a USING (head) LEFT JOIN g USING (head)""",
}
