"""Queries of bucketing, allocation, splitting, negatives, similarity, sampling, audits, open-set evaluation and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.functions import sketch
from sylva.functions.ids import hash_order
from sylva.functions.text import rank_key
from sylva.operators import allocation, audit, bucketing, negatives, openset, sampling, similarity, splitting
from sylva.operators.latest import latest
from sylva.plans import base
from sylva.plans import hierarchy_queries as hq
from sylva.plans.base import ACC, CLOSURE, HASH, INFO, LIN, NODES, PATHS, SEQ
from sylva.session import cut, table, written
from sylva.sources import predictions, release, sequences

#: Sequences of the test tables are short, so windows are too.
MAX_LEN = 20
BALANCE = bucketing.BalanceParams(min_num_seqs=20_000_000, cutoff_percentage=70.0, max_n_per_class=100_000_000, min_leaves=3)
_TRIM = "trim({}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))"


def _tree_children(s: SparkSession, d: str) -> DataFrame:
    """Children of all nodes with leaves (accessions below) and size-proxy capacity."""
    n = hq.hierarchy_nodes(s, d).where("parent_id is not null").select(F.col("parent_id").alias("head"), F.col("node_id").alias("child"), "rank", F.col("node_id").cast("bigint").alias("ord"))
    acc = base.accessions(s, d).select("accession", "taxid").join(hq.hierarchy_closure(s, d), "taxid").groupBy("ancestor").agg(F.count(F.lit(1)).alias("n_leaves"))
    cap = hq.size_proxy(s, d).select(F.col("label").alias("child"), "capacity")
    return n.join(acc.select(F.col("ancestor").alias("child"), "n_leaves"), "child", "left").join(cap, "child", "left")


def _classes(s: SparkSession, d: str) -> DataFrame:
    """Current classes of heads."""
    c = latest(table(s, d, "label_map"), ["head_taxid", "class_idx"], ["exported_at"], ["taxid", "name", "rank", "n_windows", "head_rank"]).where("class_idx >= 0 and head_taxid is not null")
    return c.select(F.col("head_taxid").alias("head"), "class_idx", "taxid", F.coalesce("name", "taxid").alias("name"), rank_key("rank").alias("rank"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"), F.coalesce("head_rank", F.lit("unknown")).alias("head_rank"))


def _class_children(s: SparkSession, d: str) -> DataFrame:
    return _classes(s, d).select("head", F.col("class_idx").cast("string").alias("child"), "rank", F.col("class_idx").cast("bigint").alias("ord"))


def modal_rank(s: SparkSession, d: str) -> DataFrame:
    return bucketing.modal_rank(_class_children(s, d))


def rank_buckets(s: SparkSession, d: str) -> DataFrame:
    return bucketing.rank_buckets(_class_children(s, d)).select("head", "child", "bucket_id", "bucket_rank")


def virtual_id_collisions(s: SparkSession, d: str) -> DataFrame:
    """Ids cut to four digits, so that some collide."""
    b = rank_buckets(s, d).where("bucket_id is not null").select(F.substring("bucket_id", 1, 4).alias("virtual_id"), F.col("head").alias("parent"), F.col("bucket_rank").alias("purpose"))
    return bucketing.check_virtual_ids(b)


def leaf_counts(s: SparkSession, d: str) -> DataFrame:
    """Distinct sequences below each child."""
    kids = hq.hierarchy_nodes(s, d).where("parent_id is not null").select(F.col("parent_id").alias("head"), F.col("node_id").alias("child"))
    return bucketing.leaf_counts(kids, _leaf_closure(s, d)).select("child", "n_leaves")


def rare_partition(s: SparkSession, d: str) -> DataFrame:
    return bucketing.rare_partition(_tree_children(s, d), BALANCE).select("head", "child", "is_rare")


def balanced_plan(s: SparkSession, d: str) -> DataFrame:
    return bucketing.balanced_plan(_tree_children(s, d), BALANCE)


def absorbing_buckets(s: SparkSession, d: str) -> DataFrame:
    return bucketing.absorbing_buckets(balanced_plan(s, d))


def keep_imbalance(s: SparkSession, d: str) -> DataFrame:
    return bucketing.keep_imbalance(balanced_plan(s, d), BALANCE).select("head", "child", "target")


def label_targets(s: SparkSession, d: str) -> DataFrame:
    return bucketing.label_targets(balanced_plan(s, d), BALANCE)


def class_indices(s: SparkSession, d: str) -> DataFrame:
    kept = balanced_plan(s, d).where("status = 'retained'").withColumn("ord", F.col("child").cast("bigint"))
    return audit.class_indices(kept).select("head", "child", "class_idx")


def _leaves(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d).where("taxid is not null")
    return q.select(F.col("taxid").alias("child"), "header_id", F.length("seq").cast("bigint").alias("length"), F.greatest(F.lit(0), F.length("seq") - 49).cast("bigint").alias("weight"), F.lit(500).cast("bigint").alias("budget"))


def proportional_allocation(s: SparkSession, d: str) -> DataFrame:
    return allocation.allocate(_leaves(s, d), ["child"], "weight", "budget", "header_id").select("child", "header_id", "n")


def even_split(s: SparkSession, d: str) -> DataFrame:
    return _classes(s, d).select("head", "class_idx", allocation.even_split(F.col("n_windows"), F.lit(5), F.pmod("class_idx", F.lit(5))).alias("share"))


def stratified_counts(s: SparkSession, d: str) -> DataFrame:
    n = _classes(s, d).select("n_windows").distinct()
    return n.select("n_windows", splitting.stratified_counts("n_windows").alias("c")).select("n_windows", "c.train", "c.val", "c.test")


def _tasks(s: SparkSession, d: str) -> DataFrame:
    """A class per host, a genome per two sequences of it."""
    t = proportional_allocation(s, d).where("n > 0").join(_leaves(s, d).select("header_id", "length"), "header_id")
    return t.select(F.lit("h").alias("head"), "child", F.lit(0).alias("class_idx"), "header_id", F.substring("header_id", 1, 8).alias("genome_key"), "n", "length")


def window_slices(s: SparkSession, d: str) -> DataFrame:
    return splitting.window_slices(_tasks(s, d)).select("child", "header_id", "split", "n", F.round("start_pct", 6).alias("start_pct"), F.round("end_pct", 6).alias("end_pct"))


def block_stratified(s: SparkSession, d: str) -> DataFrame:
    return splitting.block_stratified(_tasks(s, d), MAX_LEN).select("child", "header_id", "split", "n", "start_pct", "end_pct")


def block_counts(s: SparkSession, d: str) -> DataFrame:
    return _tasks(s, d).select("header_id", splitting.n_blocks("length", MAX_LEN).alias("n_blocks"))


def genome_split(s: SparkSession, d: str) -> DataFrame:
    t = _tasks(s, d)
    big = t.groupBy("child").agg(F.count_distinct("genome_key").alias("g")).where("g >= 3").select("child")
    return splitting.split_volumes(splitting.assign_genomes(t.join(big, "child", "left_semi"), repair=False))


def class_splits(s: SparkSession, d: str) -> DataFrame:
    return splitting.split_classes(_tasks(s, d), MAX_LEN).select("child", "header_id", "genome_key", "split", "n", "start_pct", "end_pct")


def negative_splits(s: SparkSession, d: str) -> DataFrame:
    return splitting.split_classes(_tasks(s, d), MAX_LEN, block_large=True).select("child", "header_id", "genome_key", "split", "n", "start_pct", "end_pct")


def head_reliability(s: SparkSession, d: str) -> DataFrame:
    return audit.head_reliability(class_splits(s, d).withColumn("head", F.col("child")))


def _leaf_closure(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d).select(F.col("header_id").alias("leaf"), "taxid")
    return q.join(hq.hierarchy_closure(s, d), "taxid").select("leaf", "ancestor", "distance")


def _heads(s: SparkSession, d: str) -> DataFrame:
    return base.info(s, d).where("rank in ('genus', 'family', 'order')").select(F.col("taxid").alias("head"), "name")


def near_pool_sizes(s: SparkSession, d: str) -> DataFrame:
    return negatives.near_pool_sizes(_heads(s, d), _leaf_closure(s, d))


def near_far_pools(s: SparkSession, d: str) -> DataFrame:
    return negatives.near_far_pools(_heads(s, d), _leaf_closure(s, d))


def near_ratios(s: SparkSession, d: str) -> DataFrame:
    return hq.decidable_depth(s, d).select("node_id", F.round(negatives.near_ratio("decidable_depth"), 6).alias("ratio"))


def reject_budgets(s: SparkSession, d: str) -> DataFrame:
    p = near_pool_sizes(s, d).join(near_ratios(s, d), F.col("head") == F.col("node_id"))
    return p.select("head", negatives.reject_budget(F.lit(1001), F.col("n_near"), F.col("n_far"), F.col("ratio")).alias("b")).select("head", "b.near", "b.far")


def _weighted_pools(s: SparkSession, d: str) -> DataFrame:
    """Pools with the weight and the clade of each leaf, which come along from the ring: pools are never joined with all leaves."""
    w = _leaves(s, d).select(F.col("header_id").alias("leaf"), "weight", F.col("child").alias("clade"))
    return negatives.near_far_pools(_heads(s, d), _leaf_closure(s, d), leaves=w)


def reject_tasks(s: SparkSession, d: str, pools: DataFrame | None = None) -> DataFrame:
    """``pools`` as from ``_weighted_pools``."""
    b = reject_budgets(s, d)
    budgets = b.select("head", F.lit("near").alias("pool"), F.col("near").alias("budget")).unionByName(b.select("head", F.lit("far").alias("pool"), F.col("far").alias("budget")))
    return negatives.reject_tasks((pools or _weighted_pools(s, d)).select("head", "leaf", "pool", "weight"), budgets)


def reject_provenance(s: SparkSession, d: str) -> DataFrame:
    pools = written(_weighted_pools(s, d))
    return negatives.provenance(pools, reject_tasks(s, d, pools))


def reject_nodes(s: SparkSession, d: str) -> DataFrame:
    return negatives.reject_nodes(_heads(s, d))


def binary_heads(s: SparkSession, d: str) -> DataFrame:
    alive = hq.passthroughs(s, d).where("not is_passthrough").select(F.col("node_id").alias("head"))
    cap = hq.size_proxy(s, d).select(F.col("label").alias("head"), "capacity")
    return negatives.binary_heads(alive.join(cap, "head", "left").withColumn("capacity", F.coalesce("capacity", F.lit(0))), 20_000_000)


def _md5_sketches(s: SparkSession, d: str) -> DataFrame:
    return sketch.bottom_k(base.sequences(s, d).where("taxid is not null"), ["taxid", "header_id"], "seq", 7, 50, sketch.md5_hash)


def sketches(s: SparkSession, d: str) -> DataFrame:
    return _md5_sketches(s, d)


def crc_sketches(s: SparkSession, d: str) -> DataFrame:
    return sketch.bottom_k(base.sequences(s, d), ["header_id"], "seq")


def similar_genomes(s: SparkSession, d: str) -> DataFrame:
    """Pairs of different sketches of one host; equal sketches are one representative (see genome_classes)."""
    return similarity.similar_pairs(_md5_sketches(s, d), "taxid", "header_id", 0.05, 50).withColumn("jaccard", F.round("jaccard", 6))


def genome_classes(s: SparkSession, d: str) -> DataFrame:
    return similarity.sketch_classes(_md5_sketches(s, d), "taxid", "header_id")


def genome_clusters(s: SparkSession, d: str) -> DataFrame:
    p = similarity.ClusterParams(k=7, sketch_size=50, threshold=0.05, relaxed=(), min_fraction=0.0, min_genomes=1, max_genomes=None)
    return similarity.cluster_genomes(_md5_sketches(s, d), "taxid", "header_id", p).select("taxid", "header_id", "cluster", "threshold")


def genome_components(s: SparkSession, d: str) -> DataFrame:
    """Genomes of a host that similar ones tie together; equal sketches, which are one representative among pairs, are tied to it."""
    sk = written(_md5_sketches(s, d))
    e = similarity.similar_forest(sk, "taxid", "header_id", 0.05, 50).select("taxid", "a", "b")
    same = similarity.sketch_classes(sk, "taxid", "header_id").where("header_id <> rep").select("taxid", F.col("rep").alias("a"), F.col("header_id").alias("b"))
    c = similarity.components(sk.select("taxid", F.col("header_id").alias("node")), e.unionByName(same), "taxid")
    return c.groupBy("taxid", "component").agg(F.count(F.lit(1)).alias("n"))


def dereplicated(s: SparkSession, d: str) -> DataFrame:
    return similarity.dereplicate(_md5_sketches(s, d), "taxid", "header_id", similarity.ClusterParams(k=7, sketch_size=50, copies=0.1))


def samples(s: SparkSession, d: str) -> DataFrame:
    t = class_splits(s, d).select(F.col("child").alias("head"), "split", F.lit(0).alias("class_idx"), "header_id", "n", "start_pct", "end_pct")
    return sampling.extract(t, base.sequences(s, d), sampling.DrawParams(10, MAX_LEN))


def augmented_samples(s: SparkSession, d: str) -> DataFrame:
    return sampling.augment_train(samples(s, d), 0.05)


def sampling_laws(s: SparkSession, d: str) -> DataFrame:
    p = sampling.DrawParams(10, MAX_LEN)
    return _leaves(s, d).withColumn("n", F.lit(4)).select("header_id", sampling.strategy("length", "n", p).alias("law"))


def noisy_reads(s: SparkSession, d: str) -> DataFrame:
    return sampling.noisy_reads(base.sequences(s, d).select(F.col("header_id").alias("read_id"), "seq"), sampling.ErrorModel())


def _class_seqs(s: SparkSession, d: str) -> DataFrame:
    lin = base.paths(s, d).select("taxid", F.get("ids", F.lit(0)).alias("head"), F.get("ids", F.lit(1)).alias("class_idx"))
    return base.sequences(s, d).join(lin, "taxid").select("head", "class_idx", "seq", "header_id")


def composition(s: SparkSession, d: str) -> DataFrame:
    c = audit.composition(_class_seqs(s, d))
    return c.select("head", "class_idx", "n_rows", *[F.round(x, 6).alias(x) for x in c.columns[3:]])


def composition_audit(s: SparkSession, d: str) -> DataFrame:
    c = audit.composition(_class_seqs(s, d)).withColumn("is_virtual", F.col("class_idx").cast("bigint") % 2 == 0)
    return audit.audit(c).select("head", "class_idx", "is_virtual", F.round("gc_gap", 6).alias("gc_gap"), F.round("gc_z", 5).alias("gc_z"), "flagged")


def composition_survey(s: SparkSession, d: str) -> DataFrame:
    return audit.survey(composition_audit(s, d))


def kmer_features(s: SparkSession, d: str) -> DataFrame:
    return audit.kmer_features(base.sequences(s, d).select("header_id", "seq"), "seq", 3).select("header_id", F.transform("features", lambda x: F.round(x, 9)).alias("features"))


def balanced_subsample(s: SparkSession, d: str) -> DataFrame:
    return splitting.balanced_subsample(_class_seqs(s, d), "class_idx", 20, hash_order(42, "header_id")).select("class_idx", "header_id")


def separability(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d).join(base.paths(s, d), "taxid").select((F.get("ids", F.lit(0)).cast("int") / 1000).cast("int").alias("class_idx"), "seq", "header_id")
    h = F.pmod(hash_order(7, "header_id"), F.lit(10))
    r = audit.separability(q.where(h < 7), q.where(h >= 7))
    return s.createDataFrame([(r["k"], r["classifier"], r["n_train_sampled"], r["n_test"], r["test_accuracy"], r["test_f1_macro"], r["chance_accuracy"], r["accuracy_lift"])], "k int, classifier string, n_train_sampled int, n_test int, test_accuracy double, test_f1_macro double, chance_accuracy double, accuracy_lift double")


def class_weights(s: SparkSession, d: str) -> DataFrame:
    return audit.class_weights(_classes(s, d)).select("head", "class_idx", "weight")


def unique_names(s: SparkSession, d: str) -> DataFrame:
    return audit.unique_names(_classes(s, d)).select("head", "class_idx", "label")


def label_maps(s: SparkSession, d: str) -> DataFrame:
    m = audit.label_maps(_classes(s, d))
    return m.select("head", F.size("id2label").alias("n_labels"), F.size("label2id").alias("n_ids"), F.array_join(F.transform("classes", lambda x: x["label"]), "|").alias("labels"))


def run_statistics(s: SparkSession, d: str) -> DataFrame:
    c = _classes(s, d).withColumn("n_per_class", F.min("n_windows").over(Window.partitionBy("head"))).withColumnRenamed("n_windows", "capacity").drop("rank").withColumnRenamed("head_rank", "rank")
    return audit.run_statistics(c)


def accession_snapshot(s: SparkSession, d: str) -> DataFrame:
    return audit.accession_snapshot(table(s, d, "accessions", ["accession"]))


def manifest_merge(s: SparkSession, d: str) -> DataFrame:
    c = _classes(s, d).groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    old = c.where("cast(head as bigint) % 3 <> 0")
    new = c.where("cast(head as bigint) % 3 = 0 or cast(head as bigint) % 2 = 0").withColumn("n", F.col("n") + 1000)
    return audit.merge_manifests(old, new, "head")


def reliability(s: SparkSession, d: str) -> DataFrame:
    """Verdicts on heads whose scores are made of their classes' window counts; some heads have no training, some weren't learned."""
    c = _classes(s, d).groupBy("head").agg(F.array_sort(F.collect_list(F.col("n_windows") % 100 / 100.0)).alias("v"), F.max(F.col("n_windows") % 97 / 97.0).alias("t"), F.count(F.lit(1)).alias("n"))
    trained = F.col("n") % 7 > 0
    learned = F.when(trained & (F.col("n") % 5 == 0), F.lit(False))
    r = c.select("head", audit.reliability(F.when(trained, F.col("v")), F.when(trained & (F.col("n") > 2), F.col("t")), learned, F.when(F.col("n") % 2 == 0, "low")).alias("r"))
    return r.select("head", F.round("r.val_f1_std", 3).alias("std"), F.round("r.val_test_gap", 3).alias("gap"), "r.verdict", "r.source")


def _node_closure(s: SparkSession, d: str) -> DataFrame:
    """All ancestors of every node, by the paths it lies on."""
    p = base.paths(s, d).select(F.posexplode("ids").alias("p", "node_id"), "ids")
    c = p.select("node_id", F.explode(F.transform(F.slice("ids", 1, F.col("p") + 1), lambda x, i: F.struct(x.alias("ancestor"), (F.col("p") - i).alias("distance")))).alias("x"))
    return c.select("node_id", "x.ancestor", "x.distance").groupBy("node_id", "ancestor").agg(F.min("distance").alias("distance"))


def _eligible(s: SparkSession, d: str) -> DataFrame:
    n = _leaf_closure(s, d).groupBy(F.col("ancestor").alias("node_id")).agg(F.count_distinct("leaf").alias("n_leaves"))
    return openset.eligible(hq.hierarchy_nodes(s, d), n)


def holdout_eligible(s: SparkSession, d: str) -> DataFrame:
    return _eligible(s, d).select("node_id", "n_siblings", "n_leaves")


def _held(s: SparkSession, d: str) -> DataFrame:
    return openset.select_holdout(_eligible(s, d), _node_closure(s, d), rank="genus", fraction=0.1, seed=7)


def holdout_selection(s: SparkSession, d: str) -> DataFrame:
    return _held(s, d)


def nested_holdout(s: SparkSession, d: str) -> DataFrame:
    ids = [r["node_id"] for r in hq.hierarchy_nodes(s, d).where("cast(node_id as bigint) % 5 = 0").select("node_id").collect()]  # an explicit list is configuration
    return openset.select_holdout(_eligible(s, d), _node_closure(s, d), explicit=ids)


def retained_ancestors(s: SparkSession, d: str) -> DataFrame:
    return openset.retained_ancestor(_held(s, d), _node_closure(s, d))


def _clade_sketches(s: SparkSession, d: str) -> DataFrame:
    c = _leaf_closure(s, d).groupBy("ancestor").agg(F.min("leaf").alias("header_id"))
    sk = sketch.bottom_k(base.sequences(s, d), ["header_id"], "seq", 11, 50, sketch.md5_hash)
    return c.join(sk, "header_id").select(F.col("ancestor").alias("node_id"), "sketch")


def nearest_relatives(s: SparkSession, d: str, held: DataFrame | None = None, closure: DataFrame | None = None) -> DataFrame:
    held, sk = held or cut(_held(s, d)), cut(_clade_sketches(s, d))
    rho = openset.retained_ancestor(held, closure or _node_closure(s, d))
    q = rho.join(sk, "node_id").select(F.col("rho").alias("group"), F.col("node_id").alias("query"), "sketch")
    kids = hq.hierarchy_nodes(s, d).select(F.col("parent_id").alias("group"), "node_id").join(held, "node_id", "left_anti").join(sk, "node_id").select("group", F.col("node_id").alias("candidate"), "sketch")
    return similarity.nearest(q, kids, 11, 50)


def holdout_manifest(s: SparkSession, d: str) -> DataFrame:
    leaves = base.sequences(s, d).select("header_id", F.col("taxid").alias("node_id"))
    held, closure = cut(_held(s, d)), cut(_node_closure(s, d))
    return openset.holdout_manifest(held, hq.hierarchy_nodes(s, d), closure, leaves, nearest_relatives(s, d, held, closure), 7)


def evaluation_reads(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d)
    return openset.eval_reads(cut(holdout_manifest(s, d)), q.select("header_id", "seq"), base.lineages(s, d), q.select("header_id", "taxid"), read_length=50, per_genome=2)


def reference_export(s: SparkSession, d: str) -> DataFrame:
    q = base.sequences(s, d)
    kept = openset.retained_leaves(q.select("header_id", F.col("taxid").alias("node_id")).where("node_id is not null"), _node_closure(s, d), _held(s, d))
    return openset.reference_lines(kept, q.select("header_id", "seq"))


def _reads(s: SparkSession, d: str) -> DataFrame:
    """A read per accession with a lineage; the commit is expected two steps above the leaf."""
    p = base.accessions(s, d).select("accession", "taxid").join(base.lineages(s, d), "taxid")
    up = F.get("path", F.lit(2))
    return p.select(F.col("accession").alias("read_id"), F.transform("path", lambda x: x["taxid"]).alias("lineage"), up["taxid"].alias("expected_commit_taxid"), up["rank"].alias("expected_commit_rank"), F.when(F.col("taxid").cast("bigint") % 3 > 0, F.concat(F.lit("bin"), F.col("taxid").cast("bigint") % 3)).alias("distance_bin"), "path")


def _predictions(s: SparkSession, d: str) -> DataFrame:
    """The node a hashed number of steps above the leaf; some reads abstain, some go to another clade."""
    h = hash_order(3, "read_id")
    n = F.get("path", F.pmod(h, F.lit(4)).cast("int"))
    r = _reads(s, d).withColumn("n", n).where(F.pmod(F.floor(h / 8), F.lit(7)) > 0)
    other = F.pmod(F.floor(h / 64), F.lit(5)) == 0
    return r.select("read_id", F.when(other, "100501").otherwise(F.col("n.taxid")).alias("predicted_taxid"), F.when(other, "phylum").otherwise(F.col("n.rank")).alias("predicted_rank"))


def outcome_scores(s: SparkSession, d: str) -> DataFrame:
    return openset.score(_reads(s, d), _predictions(s, d))


def hierarchical_prf(s: SparkSession, d: str) -> DataFrame:
    r = openset.hierarchical_prf(_reads(s, d), _predictions(s, d))
    return r.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f_beta")], "beta", "n_reads")


def node_ranks(s: SparkSession, d: str) -> DataFrame:
    return openset.rank_map(base.lineages(s, d))


def _ranks(s: SparkSession, d: str) -> DataFrame:
    return node_ranks(s, d)


def classifier_lines(s: SparkSession, d: str) -> DataFrame:
    """Status lines made of the log: the last line of an accession counts."""
    log = table(s, d, "sync_log").where("accession is not null")
    ok = F.when(F.coalesce("downloaded", F.lit(False)), "C").otherwise("U")
    lines = log.select(F.struct("run_id", "logged_at").alias("at"), F.concat_ws("\t", ok, "accession", F.lit("1000")).alias("value"))
    return predictions.parse_status_output(lines, _ranks(s, d), "at")


def best_hits(s: SparkSession, d: str) -> DataFrame:
    """Scored lines made of the catalogue: the longest row of an organism."""
    a = table(s, d, "accessions", ["accession", "organism", "taxid", "total_sequence_length", "ord"]).where("organism is not null and taxid is not null and taxid not like '%\t%'")
    lines = a.select(F.struct("ord", "accession").alias("at"), F.concat_ws("\t", "organism", "accession", "taxid", F.coalesce(F.col("total_sequence_length").cast("string"), F.lit("none"))).alias("value"))
    return predictions.parse_scored_output(lines, _ranks(s, d), "at").select("read_id", "predicted_taxid", "predicted_rank")


def gbff_fields(s: SparkSession, d: str) -> DataFrame:
    """Flat-file records inside documents, by the record parser."""
    t = table(s, d, "documents", ["text"]).where("text like '%LOCUS  %'")
    value = F.regexp_replace("text", r"LOCUS +(\S+)", "\nVERSION     $1\nLOCUS       $1")  # the texts name records in this line only
    return sequences.gbff_records(t.select(value.alias("value"))).select("accession", "host_taxid", "organism", "length")


def gbff_records(s: SparkSession, d: str) -> DataFrame:
    """Flat-file records written from the plasmid table and read back by the record parser."""
    r = table(s, d, "plasmid_records").where("accession is not null and host_taxid is not null and sequence is not null")
    text = F.concat(F.lit("LOCUS       x "), F.col("length").cast("string"), F.lit(" bp    DNA\nVERSION     "), F.regexp_replace("accession", r"\s", ""), F.lit('\n                     /organism="'), F.coalesce("organism", F.lit("?")), F.lit('"\n                     /db_xref="taxon:'), F.regexp_extract("host_taxid", "([0-9]+)", 1), F.lit('"\nORIGIN\n        1 '), F.lower("sequence"), F.lit("\n"))
    return sequences.gbff_records(r.select(text.alias("value")))


def fasta_records(s: SparkSession, d: str) -> DataFrame:
    """FASTA records written from the plasmid table and read back: the first record of an id wins."""
    r = table(s, d, "plasmid_records").where("accession is not null and sequence is not null")
    return sequences.fasta_records(r.select("accession", F.col("sequence").alias("o"), F.concat(F.regexp_replace("accession", r"\s", ""), F.lit(" "), F.coalesce("organism", F.lit("")), F.lit("\n"), "sequence", F.lit("\n")).alias("value")), ["accession", "o"])


def excluded_molecules(s: SparkSession, d: str) -> DataFrame:
    h = table(s, d, "accessions", ["accession", "headers"]).select("accession", F.explode("headers").alias("h"))
    return h.where(sequences.excluded_molecule("h.name", "segment")).select("accession", F.col("h.id").alias("id")).distinct()


def manifest_entries(s: SparkSession, d: str) -> DataFrame:
    """A release manifest made of the catalogue's accessions."""
    a = table(s, d, "accessions", ["accession"]).distinct()
    lines = a.select(F.concat(F.md5(F.col("accession").cast("binary")), F.lit("  dir/plasmid."), "accession", F.when(F.md5(F.col("accession").cast("binary")) < "8", ".genomic.gbff.gz").otherwise(".genomic.gbff.gz.part")).alias("value"))
    return release.manifest_entries(lines)


def html_listing(s: SparkSession, d: str) -> DataFrame:
    """Links of a page made of each source's documents."""
    t = table(s, d, "documents", ["doc_id", "source"]).where("source is not null")
    page = t.groupBy("source").agg(F.array_join(F.collect_list(F.concat(F.lit('<a href="plasmid.'), F.col("doc_id") % 50, F.lit('.genomic.gbff.gz">x</a>'))), "\n").alias("html"))
    return page.select("source", F.array_join(release.html_listing("html"), ",").alias("files"))


def report_rows(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "plasmid_records").where("accession is not null").select("accession", F.regexp_extract("host_taxid", "([0-9]+)", 1).alias("host_taxid"), "organism", "length").where("host_taxid <> ''").distinct()
    return release.report_rows(release.record_reports(r))


def reports_by_host(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "plasmid_records").where("accession is not null").select("accession", F.regexp_extract("host_taxid", "([0-9]+)", 1).alias("host_taxid"), "organism", "length").where("host_taxid <> ''")
    return release.group_reports(release.record_reports(r)).select("taxid", F.array_join("accessions", ",").alias("accessions"))


_CHILDREN = f"""{ACC}, {NODES}, {CLOSURE}, lv AS (SELECT ancestor, count(*) AS n_leaves FROM acc JOIN closure USING (taxid) GROUP BY 1),
credited AS (SELECT a.length, unnest(list_distinct(list_concat([a.taxid], coalesce(list_transform(l.path, lambda x: x.taxid), [])))) AS label FROM acc a LEFT JOIN lin l USING (taxid) WHERE a.taxid IS NOT NULL AND a.length > 0),
cap AS (SELECT label, CAST(sum(length) AS BIGINT) AS capacity FROM credited GROUP BY 1),
kids AS (SELECT parent_id AS head, node_id AS child, coalesce(n_leaves, 0) AS n_leaves, coalesce(capacity, 0) AS capacity, CAST(node_id AS BIGINT) AS ord
  FROM nodes LEFT JOIN lv ON node_id = lv.ancestor LEFT JOIN cap ON node_id = cap.label WHERE parent_id IS NOT NULL),
rare AS (SELECT *, n_leaves < 3 AND count(*) FILTER (n_leaves >= 3) OVER (PARTITION BY head) >= 2 AS is_rare FROM kids)"""
_PLAN = f"""{_CHILDREN}, st AS (SELECT *, min(CASE WHEN NOT is_rare THEN capacity END) OVER w AS mn, count(CASE WHEN NOT is_rare THEN 1 END) OVER w AS n, row_number() OVER (PARTITION BY head ORDER BY is_rare, capacity, ord) - 1 AS place FROM rare WINDOW w AS (PARTITION BY head)),
ct AS (SELECT *, max(CASE WHEN place = least(n - 1, greatest(0, CAST(floor(CAST(n AS DOUBLE) * CAST({1.0 - BALANCE.cutoff_percentage / 100.0!r} AS DOUBLE)) AS BIGINT))) THEN capacity END) OVER (PARTITION BY head) AS cutoff FROM st),
kp AS (SELECT *, mn >= {BALANCE.min_num_seqs} AS lvl, NOT is_rare AND (mn >= {BALANCE.min_num_seqs} OR capacity >= cutoff) AS kept FROM ct),
plan AS (SELECT head, child, capacity, is_rare, CASE WHEN lvl AND mn > {BALANCE.max_n_per_class} THEN 'level_all_capped' WHEN lvl THEN 'level_all' ELSE 'cutoff_applied' END AS scenario,
  least(min(CASE WHEN kept THEN capacity END) OVER (PARTITION BY head), {BALANCE.max_n_per_class}) AS n_per_class, CASE WHEN NOT lvl THEN cutoff END AS cutoff, CASE WHEN is_rare THEN 'rare' WHEN kept THEN 'retained' ELSE 'low_capacity' END AS status FROM kp)"""
_CLS = f"""cls AS (SELECT head_taxid AS head, class_idx, taxid, coalesce(name, taxid) AS name, coalesce(nullif(lower({_TRIM.format('rank')}), ''), 'unknown') AS rank, coalesce(n_windows, 0) AS n_windows, coalesce(head_rank, 'unknown') AS head_rank
  FROM (SELECT DISTINCT ON (head_taxid, class_idx) * FROM label_map WHERE class_idx >= 0 AND head_taxid IS NOT NULL ORDER BY head_taxid, class_idx, exported_at DESC NULLS LAST))"""
_PROTECTED = "(rank LIKE 'virtual\\_%' ESCAPE '\\' OR rank = 'realm_group')"
_MODAL = f"{_CLS}, modal AS (SELECT head, arg_max(rank, (n, -f)) AS canonical_rank FROM (SELECT head, rank, count(*) AS n, min(class_idx) AS f FROM cls WHERE NOT {_PROTECTED} GROUP BY 1, 2) GROUP BY 1)"
_VID = "'9' || lpad(CAST(CAST('0x' || substr(sha256({}), 1, 15) AS UBIGINT) % 1000000000000000 AS VARCHAR), 15, '0')"
_BUCKETS = f"""{_MODAL}, b AS (SELECT head, class_idx, rank, {_PROTECTED} OR canonical_rank IS NULL OR rank = canonical_rank AS stays FROM cls LEFT JOIN modal USING (head)),
p AS (SELECT *, CASE WHEN stays THEN NULL WHEN count(*) FILTER (NOT stays) OVER (PARTITION BY head, rank) >= 5 THEN 'rank_' || rank ELSE 'misc' END AS purpose FROM b)"""
_LEAVES = f"{SEQ}, leaf AS (SELECT taxid AS child, header_id, length(seq) AS length, greatest(0, length(seq) - 49) AS weight FROM seqs WHERE taxid IS NOT NULL)"
_ALLOC = f"""{_LEAVES}, raw AS (SELECT *, CAST(round_even(500.0::DOUBLE * weight / sum(weight) OVER (PARTITION BY child), 0) AS BIGINT) AS raw FROM leaf WHERE weight > 0),
run AS (SELECT *, sum(raw) OVER (PARTITION BY child ORDER BY header_id) AS s, lead(1) OVER (PARTITION BY child ORDER BY header_id) IS NULL AS last FROM raw),
alloc AS (SELECT child, header_id, length, CAST(CASE WHEN last THEN 500 ELSE least(500, s) END - least(500, s - raw) AS BIGINT) AS n FROM run)"""
_COUNTS = "CASE WHEN {n} <= 0 THEN [0, 0, 0] WHEN {n} = 1 THEN [1, 0, 0] WHEN {n} = 2 THEN [1, 0, 1] WHEN {n} - greatest(1, CAST(floor({n} * 0.70::DOUBLE) AS BIGINT)) - greatest(1, CAST(floor({n} * 0.15::DOUBLE) AS BIGINT)) < 1 THEN [{n} - greatest(1, CAST(floor({n} * 0.15::DOUBLE) AS BIGINT)) - 1, greatest(1, CAST(floor({n} * 0.15::DOUBLE) AS BIGINT)), 1] ELSE [greatest(1, CAST(floor({n} * 0.70::DOUBLE) AS BIGINT)), greatest(1, CAST(floor({n} * 0.15::DOUBLE) AS BIGINT)), {n} - greatest(1, CAST(floor({n} * 0.70::DOUBLE) AS BIGINT)) - greatest(1, CAST(floor({n} * 0.15::DOUBLE) AS BIGINT))] END"
_LEAFCLO = f"{PATHS}, {CLOSURE}, {INFO}, {SEQ}, lc AS (SELECT header_id AS leaf, ancestor, distance FROM seqs JOIN closure USING (taxid)), cnt AS (SELECT ancestor, count(DISTINCT leaf) AS n FROM lc GROUP BY 1)"
_NEAR = f"""{_LEAFCLO}, up AS (SELECT a.ancestor AS head, b.ancestor AS anc, min(b.distance - a.distance) AS up, count(DISTINCT leaf) AS inside FROM lc a JOIN lc b USING (leaf) WHERE b.distance > a.distance AND a.ancestor IN (SELECT taxid FROM info WHERE m.rank IN ('genus', 'family', 'order')) GROUP BY 1, 2),
near AS (SELECT head, arg_min(anc, (up, anc)) AS near_root, arg_min(h.n - inside, (up, anc)) AS n_near, (SELECT count(DISTINCT leaf) FROM lc) - arg_min(h.n + o.n - inside, (up, anc)) AS n_far FROM up JOIN cnt h ON anc = h.ancestor JOIN cnt o ON head = o.ancestor WHERE h.n > inside GROUP BY 1)"""
_DEPTH = """kidc AS (SELECT parent_id, count(*) AS n FROM nodes WHERE parent_id IS NOT NULL GROUP BY 1), ups AS (SELECT node_id, min(ids[1:depth + 1]) AS up FROM pos GROUP BY 1),
depths AS (SELECT f.node_id AS node_id, sum(CASE WHEN coalesce(k.n, 0) = 1 THEN 0 ELSE 1 END) AS dd FROM (SELECT node_id, unnest(up) AS a FROM ups) f LEFT JOIN kidc k ON f.a = k.parent_id GROUP BY 1),
ratio AS (SELECT node_id, round(0.5 + 0.3 * least(1.0, greatest(0.0, (dd - 2) / 5.0)), 6) AS ratio FROM depths)"""
_SK = f"""{SEQ}, kw AS (SELECT DISTINCT taxid, header_id, {HASH.format('w')} AS h FROM (SELECT taxid, header_id, substr(seq, CAST(i AS INT), 7) AS w FROM (SELECT *, unnest(generate_series(1, length(seq) - 6)) AS i FROM seqs WHERE length(seq) >= 7 AND taxid IS NOT NULL))),
sk AS (SELECT s.taxid AS taxid, s.header_id AS header_id, coalesce(list_sort(k.l)[1:50], []) AS sketch FROM seqs s LEFT JOIN (SELECT header_id, list(h) AS l FROM kw GROUP BY 1) k USING (header_id) WHERE s.taxid IS NOT NULL)"""
_PAIRS = f"""{_SK}, rep AS (SELECT taxid, sketch, min(header_id) AS rep FROM sk WHERE len(sketch) > 0 GROUP BY 1, 2),
pr AS (SELECT a.taxid AS taxid, a.rep AS a, b.rep AS b, a.sketch AS sa, b.sketch AS sb, list_sort(list_distinct(list_concat(a.sketch, b.sketch)))[1:50] AS mg FROM rep a JOIN rep b ON a.taxid = b.taxid AND a.rep < b.rep),
pairs AS (SELECT taxid, a, b, len(list_filter(mg, lambda x: list_contains(sa, x) AND list_contains(sb, x))) / len(mg) AS jaccard FROM pr)"""
_CSEQ = f"{PATHS}, {SEQ}, cs AS (SELECT ids[1] AS head, ids[2] AS class_idx, seq, header_id FROM seqs JOIN paths USING (taxid))"
_COMP = f"""{_CSEQ}, comp AS (SELECT head, class_idx, count(*) AS n_rows, avg(length(seq)) AS len_mean, stddev_pop(length(seq)) AS len_std, avg(len(regexp_extract_all(seq, '[GC]')) / length(seq)) AS gc_mean, stddev_pop(len(regexp_extract_all(seq, '[GC]')) / length(seq)) AS gc_std,
  {', '.join(f"sum(len(regexp_extract_all(seq, '{b}'))) / sum(length(seq)) AS share_{b.lower()}" for b in 'ACGT')} FROM cs GROUP BY 1, 2)"""
_AUDIT = f"""{_COMP}, v AS (SELECT *, CAST(class_idx AS BIGINT) % 2 = 0 AS is_virtual FROM comp), r AS (SELECT *, avg(CASE WHEN NOT is_virtual THEN gc_mean END) OVER w AS mu, stddev_pop(CASE WHEN NOT is_virtual THEN gc_mean END) OVER w AS sd, count(CASE WHEN NOT is_virtual THEN 1 END) OVER w AS n FROM v WINDOW w AS (PARTITION BY head)),
aud AS (SELECT head, class_idx, is_virtual, CASE WHEN is_virtual AND n > 0 THEN gc_mean - mu END AS gap, CASE WHEN is_virtual AND n >= 2 AND sd > 0 THEN (gc_mean - mu) / sd END AS z FROM r),
audit AS (SELECT head, class_idx, is_virtual, round(gap, 6) AS gc_gap, round(z, 5) AS gc_z, coalesce(CASE WHEN z IS NOT NULL THEN abs(z) > 2 ELSE abs(gap) > 0.05 END, false) AS flagged FROM aud)"""
_NODECLO = "nc AS (SELECT node_id, anc AS ancestor, min(p - i) AS distance FROM (SELECT node_id, depth AS p, unnest(ids[1:depth + 1]) AS anc, generate_subscripts(ids[1:depth + 1], 1) - 1 AS i FROM pos) GROUP BY 1, 2)"
_ELIG = f"""{NODES}, {CLOSURE}, {SEQ}, {_NODECLO}, nl AS (SELECT ancestor AS node_id, count(DISTINCT header_id) AS n_leaves FROM seqs JOIN closure USING (taxid) GROUP BY 1), sib AS (SELECT parent_id, count(*) AS n_siblings FROM nodes WHERE parent_id IS NOT NULL GROUP BY 1),
elig AS (SELECT node_id, parent_id, rank, n_siblings, n_leaves FROM nodes JOIN sib USING (parent_id) JOIN nl USING (node_id) WHERE n_siblings >= 2)"""
_HELD = f"""{_ELIG}, o AS (SELECT *, {HASH.format("'7|' || node_id")} AS h FROM elig WHERE rank = 'genus'), am AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY h, node_id) AS k FROM o) WHERE k < n_siblings),
held AS (SELECT node_id FROM (SELECT node_id, row_number() OVER (ORDER BY h, node_id) AS rn FROM am) WHERE rn <= (SELECT ceil(count(*) * 0.1) FROM o))"""
_READS = f"""{ACC}, {PATHS}, rd AS (SELECT accession AS read_id, list_transform(path, lambda x: x.taxid) AS lineage, path[3].taxid AS rho, path[3].rank AS rho_rank, CASE WHEN CAST(taxid AS BIGINT) % 3 > 0 THEN 'bin' || CAST(taxid AS BIGINT) % 3 END AS bin, path, {HASH.format("'3|' || accession")} AS h FROM acc JOIN lin USING (taxid)),
pd AS (SELECT read_id, CASE WHEN (h // 64) % 5 = 0 THEN '100501' ELSE path[h % 4 + 1].taxid END AS pt, CASE WHEN (h // 64) % 5 = 0 THEN 'phylum' ELSE path[h % 4 + 1].rank END AS pr FROM rd WHERE (h // 8) % 7 > 0)"""
_CANON = "['superkingdom', 'kingdom', 'phylum', 'class', 'order', 'family', 'genus', 'species']"
_OUT = f"""{_READS}, q AS (SELECT rd.*, pt, pr, list_position(list_reverse(lineage), pt) AS ap, list_position(list_reverse(lineage), rho) AS ar FROM rd LEFT JOIN pd USING (read_id)),
oc AS (SELECT coalesce(nullif(rho_rank, ''), 'unknown') AS rank_key, coalesce(nullif(bin, ''), 'unknown') AS bin_key, CASE WHEN pt IS NULL OR pt = '' THEN 'abstain' WHEN coalesce(pt = rho, false) THEN 'correct' WHEN coalesce(ap, 0) > 0 AND coalesce(ar, 0) > 0 AND ap < ar THEN 'too_shallow' WHEN coalesce(ap, 0) > 0 AND coalesce(ar, 0) > 0 THEN 'over_commit'
  WHEN coalesce(list_position({_CANON}, pr) > list_position({_CANON}, rho_rank), false) THEN 'over_commit' ELSE 'misroute' END AS o FROM q)"""

QUERIES = {
    f.__name__: f
    for f in (
        modal_rank, rank_buckets, virtual_id_collisions, leaf_counts, rare_partition, balanced_plan, absorbing_buckets, keep_imbalance, label_targets, class_indices, proportional_allocation, even_split, stratified_counts, window_slices, block_stratified,
        block_counts, genome_split, class_splits, negative_splits, head_reliability, near_pool_sizes, near_far_pools, near_ratios, reject_budgets, reject_tasks, reject_provenance, reject_nodes, binary_heads, sketches, crc_sketches,
        similar_genomes, genome_classes, genome_clusters, genome_components, dereplicated, samples, augmented_samples, sampling_laws, noisy_reads, composition, composition_audit, composition_survey, kmer_features, balanced_subsample, separability,
        class_weights, unique_names, label_maps, run_statistics, accession_snapshot, manifest_merge, reliability, holdout_eligible, holdout_selection, nested_holdout, retained_ancestors, nearest_relatives, holdout_manifest, evaluation_reads,
        reference_export, outcome_scores, hierarchical_prf, node_ranks, classifier_lines, best_hits, gbff_fields, gbff_records, fasta_records, excluded_molecules, manifest_entries, html_listing, report_rows, reports_by_host,
    )
}
ORACLE = {
    "modal_rank": f"WITH {_MODAL} SELECT * FROM modal",
    "rank_buckets": f"WITH {_BUCKETS} SELECT head, CAST(class_idx AS VARCHAR) AS child, CASE WHEN purpose IS NOT NULL THEN {_VID.format('head || chr(58) || purpose')} END AS bucket_id, CASE WHEN purpose = 'misc' THEN 'virtual_misc' WHEN purpose IS NOT NULL THEN 'virtual_' || rank END AS bucket_rank FROM p",
    "virtual_id_collisions": f"WITH {_BUCKETS}, v AS (SELECT DISTINCT substr({_VID.format('head || chr(58) || purpose')}, 1, 4) AS virtual_id, head, purpose FROM p WHERE purpose IS NOT NULL) SELECT virtual_id, count(*) AS n FROM v GROUP BY 1 HAVING count(*) > 1",
    "leaf_counts": f"WITH {_LEAFCLO}, kids AS (SELECT DISTINCT unnest(ids[2:]) AS child FROM paths) SELECT child, coalesce(n, 0) AS n_leaves FROM kids LEFT JOIN cnt ON child = ancestor",
    "rare_partition": f"WITH {_CHILDREN} SELECT head, child, is_rare FROM rare",
    "balanced_plan": f"WITH {_PLAN} SELECT * FROM plan",
    "absorbing_buckets": f"""WITH {_PLAN}, ab AS (SELECT head, CASE status WHEN 'rare' THEN 'rare_taxa' ELSE status END AS purpose, child FROM plan WHERE status <> 'retained')
      SELECT head, {_VID.format('head || chr(58) || purpose')} AS bucket_id, 'virtual_' || purpose AS bucket_rank, count(*) AS n_absorbed, list_sort(list(child)) AS absorbed FROM ab GROUP BY head, purpose""",
    "keep_imbalance": f"WITH {_PLAN} SELECT head, child, CASE WHEN status = 'retained' THEN least(CASE WHEN capacity > 0 THEN capacity ELSE n_per_class END, {BALANCE.max_n_per_class}) END AS target FROM plan",
    "label_targets": f"WITH {_PLAN} SELECT child AS label, max(CASE status WHEN 'low_capacity' THEN capacity WHEN 'retained' THEN n_per_class END) AS target FROM plan WHERE status <> 'rare' GROUP BY 1",
    "class_indices": f"WITH {_PLAN} SELECT head, child, CAST(row_number() OVER (PARTITION BY head ORDER BY CAST(child AS BIGINT), child) - 1 AS INT) AS class_idx FROM plan WHERE status = 'retained'",
    "proportional_allocation": f"WITH {_ALLOC} SELECT child, header_id, n FROM alloc",
    "even_split": f"WITH {_CLS} SELECT head, class_idx, n_windows // 5 + CASE WHEN class_idx % 5 < n_windows % 5 THEN 1 ELSE 0 END AS share FROM cls",
    "stratified_counts": f"WITH {_CLS}, c AS (SELECT n_windows, {_COUNTS.format(n='n_windows')} AS c FROM (SELECT DISTINCT n_windows FROM cls)) SELECT n_windows, c[1] AS train, c[2] AS val, c[3] AS test FROM c",
    "window_slices": f"""WITH {_ALLOC}, c AS (SELECT *, {_COUNTS.format(n='n')} AS c FROM alloc WHERE n > 0), u AS (SELECT child, header_id, unnest(c) AS n, generate_subscripts(c, 1) AS i FROM c)
      SELECT child, header_id, ['train', 'val', 'test'][i] AS split, n, round((i - 1) / 3, 6) AS start_pct, round(i / 3, 6) AS end_pct FROM u WHERE n > 0""",
    "block_counts": f"WITH {_ALLOC} SELECT header_id, CAST(length // greatest(20, length // 12) AS INT) AS n_blocks FROM alloc WHERE n > 0",
    "genome_split": f"""WITH RECURSIVE {_ALLOC}, u AS (SELECT child, substr(header_id, 1, 8) AS g, sum(n) AS v FROM alloc WHERE n > 0 GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY child ORDER BY v DESC, g) AS rn, sum(v) OVER (PARTITION BY child) AS t, count(*) OVER (PARTITION BY child) AS c FROM u),
      f(child, rn, split, v, a, b, c) AS (SELECT child, CAST(0 AS BIGINT), '', CAST(0 AS DOUBLE), CAST(0.7 * t AS DOUBLE), CAST(0.15 * t AS DOUBLE), CAST((1.0::DOUBLE - 0.7::DOUBLE - 0.15::DOUBLE) * t AS DOUBLE) FROM k WHERE rn = 1 AND k.c >= 3
        UNION ALL SELECT f.child, k.rn, CASE WHEN a >= b AND a >= f.c THEN 'train' WHEN b >= f.c THEN 'val' ELSE 'test' END, CAST(k.v AS DOUBLE), a - CASE WHEN a >= b AND a >= f.c THEN k.v ELSE 0 END, b - CASE WHEN NOT (a >= b AND a >= f.c) AND b >= f.c THEN k.v ELSE 0 END, f.c - CASE WHEN NOT (a >= b AND a >= f.c) AND NOT b >= f.c THEN k.v ELSE 0 END
        FROM f JOIN k ON f.child = k.child AND k.rn = f.rn + 1)
      SELECT 'h' AS head, child, split, count(*) AS genomes, CAST(sum(v) AS BIGINT) AS windows FROM f WHERE rn > 0 GROUP BY 2, 3""",
    "near_pool_sizes": f"WITH {_NEAR} SELECT * FROM near",
    "near_ratios": f"WITH {NODES}, {_DEPTH} SELECT * FROM ratio",
    "reject_budgets": f"""WITH {_NEAR.replace(PATHS + ', ' + CLOSURE + ', ' + INFO, NODES + ', ' + CLOSURE)}, {_DEPTH}, j AS (SELECT head, n_near, n_far, CAST(greatest(0, least(1001, round_even(1001 * ratio::DOUBLE, 0))) AS BIGINT) AS r FROM near JOIN ratio ON head = node_id)
      SELECT head, CASE WHEN n_near = 0 AND n_far = 0 THEN 0 WHEN n_far = 0 THEN 1001 WHEN n_near = 0 THEN 0 ELSE r END AS near, CASE WHEN n_near = 0 AND n_far = 0 THEN 0 WHEN n_far = 0 THEN 0 WHEN n_near = 0 THEN 1001 ELSE 1001 - r END AS far FROM j""",
    "reject_nodes": f"WITH {LIN}, {INFO} SELECT taxid AS head, {_VID.format('taxid || chr(58) || chr(114) || chr(101) || chr(106) || chr(101) || chr(99) || chr(116)')} AS reject_id, 'virtual_reject' AS rank, 'virtual_reject_' || m.name AS name FROM info WHERE m.rank IN ('genus', 'family', 'order')",
    "binary_heads": f"""WITH {_CHILDREN}, kc AS (SELECT parent_id, count(*) AS n FROM nodes WHERE parent_id IS NOT NULL GROUP BY 1), h AS (SELECT node_id AS head, CASE WHEN capacity > 0 THEN least(capacity, 20000000) ELSE 20000000 END AS n_positive FROM nodes LEFT JOIN kc ON node_id = kc.parent_id LEFT JOIN cap ON node_id = cap.label WHERE coalesce(kc.n, 0) <> 1)
      SELECT head, n_positive, n_positive AS n_negative FROM h""",
    "sketches": f"WITH {_SK} SELECT * FROM sk",
    "similar_genomes": f"WITH {_PAIRS} SELECT taxid, a, b, round(jaccard, 6) AS jaccard FROM pairs WHERE jaccard >= 0.05",
    "genome_classes": f"WITH {_SK} SELECT taxid, header_id, CASE WHEN len(sketch) > 0 THEN min(header_id) OVER (PARTITION BY taxid, sketch) ELSE header_id END AS rep FROM sk",
    "genome_components": f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT taxid, a, b FROM pairs WHERE jaccard >= 0.05 UNION SELECT taxid, b, a FROM pairs WHERE jaccard >= 0.05), reps AS (SELECT taxid, header_id, CASE WHEN len(sketch) > 0 THEN min(header_id) OVER (PARTITION BY taxid, sketch) ELSE header_id END AS rep FROM sk),
      r(taxid, n, m) AS (SELECT taxid, rep, rep FROM reps UNION SELECT r.taxid, r.n, e.b FROM r JOIN e ON r.taxid = e.taxid AND r.m = e.a), c AS (SELECT taxid, n, min(m) AS component FROM r GROUP BY 1, 2)
      SELECT reps.taxid AS taxid, component, count(*) AS n FROM reps JOIN c ON reps.taxid = c.taxid AND rep = n GROUP BY 1, 2""",
    "sampling_laws": f"WITH {_LEAVES} SELECT header_id, CASE WHEN length < 10 THEN NULL WHEN length >= 160 THEN 'non_overlapping' WHEN length >= 80 AND length // 20 - 4 <= 0 THEN 'contiguous' WHEN length >= 80 THEN 'flanked' ELSE 'bounded_random' END AS law FROM leaf",
    "composition": f"WITH {_COMP} SELECT head, class_idx, n_rows, {', '.join(f'round({c}, 6) AS {c}' for c in ('len_mean', 'len_std', 'gc_mean', 'gc_std', 'share_a', 'share_c', 'share_g', 'share_t'))} FROM comp",
    "composition_audit": f"WITH {_AUDIT} SELECT * FROM audit",
    "composition_survey": f"WITH {_AUDIT} SELECT head, count(*) AS n_classes, count(*) FILTER (is_virtual) AS n_virtual, count(*) FILTER (flagged) AS n_flagged FROM audit GROUP BY 1",
    "balanced_subsample": f"WITH {_CSEQ} SELECT class_idx, header_id FROM (SELECT *, row_number() OVER (PARTITION BY class_idx ORDER BY {HASH.format("'42|' || header_id")}) AS rn FROM cs) WHERE rn <= 20",
    "class_weights": f"WITH {_CLS} SELECT head, class_idx, CASE WHEN n_windows > 0 THEN round(sum(n_windows) OVER w / (count(*) OVER w * n_windows), 4) END AS weight FROM cls WINDOW w AS (PARTITION BY head)",
    "unique_names": f"WITH {_CLS} SELECT head, class_idx, CASE WHEN row_number() OVER (PARTITION BY head, name ORDER BY class_idx, taxid) > 1 THEN name || ' (' || taxid || ')' || CASE WHEN row_number() OVER (PARTITION BY head, name, taxid ORDER BY class_idx) > 1 THEN ' #' || class_idx ELSE '' END ELSE name END AS label FROM cls",
    "label_maps": f"WITH {_CLS}, u AS (SELECT head, class_idx, CASE WHEN row_number() OVER (PARTITION BY head, name ORDER BY class_idx, taxid) > 1 THEN name || ' (' || taxid || ')' || CASE WHEN row_number() OVER (PARTITION BY head, name, taxid ORDER BY class_idx) > 1 THEN ' #' || class_idx ELSE '' END ELSE name END AS label FROM cls) SELECT head, CAST(count(*) AS INT) AS n_labels, CAST(count(DISTINCT label) AS INT) AS n_ids, string_agg(label, '|' ORDER BY class_idx) AS labels FROM u GROUP BY 1",
    "run_statistics": f"WITH {_CLS}, c AS (SELECT *, min(n_windows) OVER (PARTITION BY head) AS npc FROM cls) SELECT head_rank AS rank, count(DISTINCT head) AS n_heads, count(*) AS n_classes, median(npc) AS median_n_per_class, CAST(floor(median(CASE WHEN n_windows > 0 THEN n_windows END)) AS BIGINT) AS median_capacity FROM c GROUP BY 1",
    "accession_snapshot": "SELECT count(*) AS n_accessions, sha256(string_agg(accession, chr(10) ORDER BY accession)) AS digest FROM (SELECT DISTINCT accession FROM accessions)",
    "manifest_merge": f"WITH {_CLS}, c AS (SELECT head, count(*) AS n FROM cls GROUP BY 1) SELECT head, CASE WHEN CAST(head AS BIGINT) % 2 = 0 OR CAST(head AS BIGINT) % 3 = 0 THEN n + 1000 ELSE n END AS n FROM c",
    "reliability": f"""WITH {_CLS}, c AS (SELECT head, list_sort(list(n_windows % 100 / 100.0)) AS v, max(n_windows % 97 / 97.0) AS t, count(*) AS n FROM cls GROUP BY 1),
      r AS (SELECT head, n, n % 7 > 0 AS trained, CASE WHEN n % 7 > 0 AND len(v) >= 2 THEN round(list_stddev_pop(v), 4) ELSE 0 END AS std, CASE WHEN n % 7 > 0 AND n > 2 THEN round(abs(t - v[-1]), 4) END AS gap FROM c)
      SELECT head, round(std, 3) AS std, round(gap, 3) AS gap, CASE WHEN trained AND n % 5 = 0 THEN 'unreliable' WHEN trained AND (std > 0.08 OR coalesce(gap > 0.10, false)) THEN 'noisy-metrics' WHEN trained THEN 'reliable'
        WHEN n % 2 = 0 THEN 'noisy-metrics' ELSE 'reliable' END AS verdict, CASE WHEN trained THEN 'training' ELSE 'a_priori' END AS source FROM r""",
    "holdout_eligible": f"WITH {_ELIG} SELECT node_id, n_siblings, n_leaves FROM elig",
    "holdout_selection": f"WITH {_HELD} SELECT node_id FROM held",
    "nested_holdout": f"WITH {_ELIG}, w AS (SELECT node_id FROM elig WHERE CAST(node_id AS BIGINT) % 5 = 0) SELECT node_id FROM w WHERE node_id NOT IN (SELECT node_id FROM nc WHERE distance > 0 AND ancestor IN (SELECT node_id FROM w))",
    "retained_ancestors": f"WITH {_HELD} SELECT node_id, arg_min(ancestor, (distance, ancestor)) AS rho FROM nc WHERE distance > 0 AND node_id IN (SELECT node_id FROM held) AND ancestor NOT IN (SELECT node_id FROM held) GROUP BY 1",
    "outcome_scores": f"""WITH {_OUT} SELECT CASE WHEN grouping(rank_key) = 0 THEN 'by_expected_commit_rank' WHEN grouping(bin_key) = 0 THEN 'by_distance_bin' ELSE 'overall' END AS grp, coalesce(rank_key, bin_key, '') AS key, count(*) AS n,
      {', '.join(f"count(*) FILTER (o = '{x}') AS {x}, round(count(*) FILTER (o = '{x}') / count(*), 4) AS {x}_rate" for x in openset.OUTCOMES)} FROM oc GROUP BY GROUPING SETS ((), (rank_key), (bin_key))""",
    "hierarchical_prf": f"""WITH {_READS}, l AS (SELECT unnest(lineage) AS t, generate_subscripts(lineage, 1) AS i, lineage FROM rd), up AS (SELECT t, arg_min(lineage[i:], (len(lineage[i:]), lineage[i:])) AS anc FROM l GROUP BY 1),
      j AS (SELECT list_distinct(lineage) AS tr, CASE WHEN pt IS NULL THEN [] ELSE list_distinct(coalesce(anc, [pt])) END AS pr FROM rd LEFT JOIN pd USING (read_id) LEFT JOIN up ON pt = up.t),
      s AS (SELECT sum(len(list_intersect(tr, pr))) AS i, sum(len(pr)) AS p, sum(len(tr)) AS t, count(*) AS n FROM j)
      SELECT round(i / p, 9) AS precision, round(i / t, 9) AS recall, round(1.25 * (i / p) * (i / t) / (0.25 * (i / p) + i / t), 9) AS f_beta, CAST(0.5 AS DOUBLE) AS beta, n AS n_reads FROM s""",
    "node_ranks": f"WITH {LIN} SELECT x.taxid AS taxid, max(x.rank) AS rank FROM (SELECT unnest(path) AS x FROM lin) WHERE x.taxid IS NOT NULL GROUP BY 1",
    "classifier_lines": """WITH l AS (SELECT accession, arg_max(coalesce(downloaded, false), (run_id, logged_at, coalesce(downloaded, false))) AS ok FROM sync_log WHERE accession IS NOT NULL GROUP BY 1)
      SELECT accession AS read_id, CASE WHEN ok THEN '1000' END AS predicted_taxid, CASE WHEN ok THEN 'superkingdom' END AS predicted_rank FROM l""",
    "gbff_fields": r"""SELECT regexp_extract(text, 'LOCUS +(\S+)', 1) AS accession, regexp_extract(text, '/db_xref="taxon:(\d+)"', 1) AS host_taxid, trim(regexp_extract(text, '\n\s*ORGANISM\s+([^\r\n]+)', 1)) AS organism,
      coalesce(CAST(nullif(regexp_extract(text, 'LOCUS\s+\S+\s+(\d+)\s+bp', 1), '') AS BIGINT), length(regexp_replace(regexp_extract(text, '(?s)\nORIGIN[^\n]*\n(.*)$', 1), '[^\p{L}]', '', 'g'))) AS length
      FROM documents WHERE text LIKE '%LOCUS  %' AND regexp_extract(text, '/db_xref="taxon:(\d+)"', 1) <> ''""",
    "gbff_records": r"""SELECT regexp_replace(accession, '\s', '', 'g') AS accession, regexp_extract(host_taxid, '([0-9]+)', 1) AS host_taxid, CASE WHEN organism = '' THEN '' ELSE coalesce(organism, '?') END AS organism,
      length, upper(regexp_replace(sequence, '[^\p{L}]', '', 'g')) AS sequence FROM plasmid_records WHERE accession IS NOT NULL AND host_taxid IS NOT NULL AND sequence IS NOT NULL AND length IS NOT NULL
      AND regexp_extract(host_taxid, '([0-9]+)', 1) <> '' AND regexp_replace(accession, '\s', '', 'g') <> ''""",
    "fasta_records": r"""SELECT header_id, CASE WHEN name <> '' THEN name ELSE header_id END AS name, seq FROM (SELECT *, row_number() OVER (PARTITION BY header_id ORDER BY accession, sequence) AS rn FROM (
      SELECT regexp_replace(accession, '\s', '', 'g') AS header_id, trim(coalesce(organism, '')) AS name, regexp_replace(sequence, '\s', '', 'g') AS seq, accession, sequence FROM plasmid_records WHERE accession IS NOT NULL AND sequence IS NOT NULL) WHERE header_id <> '') WHERE rn = 1""",
    "best_hits": """WITH RECURSIVE l AS (SELECT organism AS read_id, trim(taxid) AS t, total_sequence_length AS score, ord, accession FROM accessions WHERE organism IS NOT NULL AND taxid IS NOT NULL AND taxid NOT LIKE '%' || chr(9) || '%' AND total_sequence_length IS NOT NULL AND organism <> 'readID'),
      b AS (SELECT read_id, CASE WHEN t NOT IN ('0', '') THEN t END AS t FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY score DESC, ord, accession) AS rn FROM l) WHERE rn = 1),
      """ + LIN + """, r AS (SELECT x.taxid AS taxid, max(x.rank) AS rank FROM (SELECT unnest(path) AS x FROM lin) WHERE x.taxid IS NOT NULL GROUP BY 1)
      SELECT read_id, t AS predicted_taxid, rank AS predicted_rank FROM b LEFT JOIN r ON b.t = r.taxid""",
    "reference_export": f"""WITH {_HELD} SELECT '>' || header_id || '|kraken:taxid|' || taxid || chr(10) || seq AS value FROM seqs WHERE taxid IS NOT NULL AND taxid NOT IN (SELECT node_id FROM nc WHERE ancestor IN (SELECT node_id FROM held))""",
    "block_stratified": f"""WITH {_ALLOC}, t AS (SELECT *, CAST(length // greatest(20, length // 12) AS INT) AS nb, {_COUNTS.format(n='n')} AS c FROM alloc WHERE n > 0),
      h AS (SELECT nb, greatest(1, CAST(round_even(nb * 0.15::DOUBLE, 0) AS INT)) AS v, greatest(1, CAST(round_even(nb * (1.0::DOUBLE - 0.70::DOUBLE - 0.15::DOUBLE), 0) AS INT)) AS e FROM (SELECT DISTINCT nb FROM t) WHERE nb >= 3),
      hb AS (SELECT nb, CAST(round_even(k * nb / (v + e + 1)::DOUBLE, 0) AS INT) AS block, CASE WHEN CASE WHEN k <= 2 * least(v, e) THEN k % 2 = 1 ELSE v > e END THEN 2 ELSE 3 END AS s FROM (SELECT *, unnest(generate_series(1, v + e)) AS k FROM h)),
      bl AS (SELECT b.nb, b.block, coalesce(hb.s, 1) AS s FROM (SELECT nb, unnest(generate_series(0, nb - 1)) AS block FROM h) b LEFT JOIN hb USING (nb, block)),
      pl AS (SELECT *, row_number() OVER (PARTITION BY nb, s ORDER BY block) - 1 AS place, count(*) OVER (PARTITION BY nb, s) AS k FROM bl),
      j AS (SELECT child, header_id, ['train', 'val', 'test'][s] AS split, c[s] // k + CASE WHEN place < c[s] % k THEN 1 ELSE 0 END AS n, block / t.nb AS start_pct, (block + 1) / t.nb AS end_pct FROM t JOIN pl ON t.nb = pl.nb)
      SELECT * FROM j WHERE n > 0""",
    "kmer_features": f"""WITH {SEQ}, k AS (SELECT header_id, unnest(generate_series(0, 63)) AS i, seq FROM seqs), w AS (SELECT header_id, substr(seq, CAST(p AS INT), 3) AS m FROM (SELECT header_id, seq, unnest(generate_series(1, length(seq) - 2)) AS p FROM seqs WHERE length(seq) >= 3)),
      c AS (SELECT header_id, 16 * (strpos('ACGT', m[1]) - 1) + 4 * (strpos('ACGT', m[2]) - 1) + strpos('ACGT', m[3]) - 1 AS i, count(*) AS n FROM w WHERE regexp_full_match(m, '[ACGT]+') GROUP BY 1, 2),
      a AS (SELECT *, sum(n) OVER (PARTITION BY header_id) AS total FROM c)
      SELECT k.header_id AS header_id, list(coalesce(round(n / total, 9), 0) ORDER BY k.i) AS features FROM k LEFT JOIN a ON k.header_id = a.header_id AND k.i = a.i GROUP BY 1""",
    "genome_clusters": f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT taxid, a, b FROM pairs WHERE jaccard >= 0.05 UNION SELECT taxid, b, a FROM pairs WHERE jaccard >= 0.05), reps AS (SELECT taxid, header_id, CASE WHEN len(sketch) > 0 THEN min(header_id) OVER (PARTITION BY taxid, sketch) ELSE header_id END AS rep FROM sk),
      r(taxid, n, m) AS (SELECT taxid, rep, rep FROM reps UNION SELECT r.taxid, r.n, e.b FROM r JOIN e ON r.taxid = e.taxid AND r.m = e.a), c AS (SELECT taxid, n, min(m) AS cluster FROM r GROUP BY 1, 2),
      m AS (SELECT reps.taxid AS taxid, header_id, cluster FROM reps JOIN c ON reps.taxid = c.taxid AND rep = n)
      SELECT taxid, header_id, cluster, CAST(0.05 AS DOUBLE) AS threshold FROM m WHERE taxid IN (SELECT taxid FROM m GROUP BY 1 HAVING count(DISTINCT cluster) >= 2)""",
    "excluded_molecules": "SELECT DISTINCT accession, h.id AS id FROM (SELECT accession, unnest(headers) AS h FROM accessions) WHERE contains(lower(h.name), 'segment')",
    "manifest_entries": "SELECT 'plasmid.' || accession || '.genomic.gbff.gz' AS name, md5(accession) AS md5 FROM (SELECT DISTINCT accession FROM accessions) WHERE md5(accession) < '8'",
    "html_listing": "SELECT source, array_to_string(list_sort(list_distinct(list('plasmid.' || doc_id % 50 || '.genomic.gbff.gz'))), ',') AS files FROM documents WHERE source IS NOT NULL GROUP BY 1",
    "report_rows": "SELECT DISTINCT accession, CAST(CAST(regexp_extract(host_taxid, '[0-9]+') AS BIGINT) AS VARCHAR) AS taxid, organism, true AS is_reference, coalesce(length, 0) AS total_sequence_length, false AS downloaded FROM plasmid_records WHERE accession IS NOT NULL AND regexp_extract(host_taxid, '[0-9]+') <> ''",
    "reports_by_host": "SELECT CAST(CAST(regexp_extract(host_taxid, '[0-9]+') AS BIGINT) AS VARCHAR) AS taxid, array_to_string(list_sort(list_distinct(list(accession))), ',') AS accessions FROM plasmid_records WHERE accession IS NOT NULL AND regexp_extract(host_taxid, '[0-9]+') <> '' GROUP BY 1",
}
