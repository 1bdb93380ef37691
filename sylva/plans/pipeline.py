"""From a catalogue to datasets: hierarchy, capacity, bucketing, balancing, negatives, splits, windows, label maps.

Every stage treats all heads at once. Which children a head absorbs depends on that head's children alone, so the whole cascade is one pass over the node
table, after which heads below an absorbed node fall out by an anti-join; there is no loop over levels and no recursion on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.functions.ids import virtual_id
from sylva.functions.ranks import below
from sylva.functions.sketch import bottom_k
from sylva.operators import allocation, audit, bucketing, hierarchy, negatives, openset, sampling, similarity, splitting, windows
from sylva.session import cut, written
from sylva.tables import read_table


@dataclass(frozen=True)
class GenerateParams:
    """``domain`` None takes the whole catalogue, several domains with commas between make a forest under one root, each with its own entry of ``scopes``.

    ``keep_imbalance`` gives each class its own capacity up to the cap.
    """

    domain: str | None = None
    min_len: int = 100
    max_len: int = 2000
    balance: bucketing.BalanceParams = field(default_factory=bucketing.BalanceParams)
    noise: hierarchy.NoiseRules = field(default_factory=hierarchy.NoiseRules)
    scope: hierarchy.Scope | None = None
    scopes: tuple[hierarchy.Scope, ...] = ()
    all_ranks: bool = False
    approximate_capacity: bool = False
    keep_imbalance: bool = False
    stop_at: str | None = None
    single_level: str | None = None
    reject: negatives.RejectParams | None = None
    cluster_aware: bool = False
    dereplicate: float | None = None
    mutation_rate: float = 0.0
    holdout_clades: tuple[str, ...] = ()
    holdout_rank: str | None = None
    holdout_fraction: float = 0.0
    binary_budget: int = 20_000
    seed: int = 42

    def __post_init__(self) -> None:
        sampling.DrawParams(self.min_len, self.max_len)
        if self.stop_at and self.single_level:
            raise ValueError("stop_at and single_level exclude each other")


@dataclass(frozen=True)
class Tree:
    """``paths(taxid, ids)``, ``nodes``, ``leaves(header_id, node_id, genome_key, length)``, ``closure(leaf, ancestor, distance)``, ``node_closure``."""

    paths: DataFrame
    nodes: DataFrame
    leaves: DataFrame
    closure: DataFrame
    node_closure: DataFrame


def node_closure(paths: DataFrame) -> DataFrame:
    """``node_id, ancestor, distance`` for all nodes of the paths; a node on several paths keeps the nearest distance."""
    p = paths.select(F.posexplode("ids").alias("p", "node_id"), "ids")
    up = F.transform(F.slice("ids", 1, F.col("p") + 1), lambda x, i: F.struct(x.alias("ancestor"), (F.col("p") - i).alias("distance")))
    return p.select("node_id", F.explode(up).alias("x")).groupBy("node_id", F.col("x.ancestor").alias("ancestor")).agg(F.min("x.distance").alias("distance"))


def build_tree(accessions: DataFrame, lineages: DataFrame, sequences: DataFrame, p: GenerateParams) -> Tree:
    """The cleaned hierarchy over sequences that exist: noise left out, anchored at the domain, redirected, held-out subtrees not yet pruned."""
    lin = lineages.where(F.size("path") > 0).groupBy("taxid").agg(F.first("path").alias("path"))
    domains = [x.strip() for x in p.domain.split(",") if x.strip()] if p.domain is not None else [None]
    scopes = {s.domain: s for s in (*p.scopes, *((p.scope,) if p.scope else ()))}
    paths, labels = forest(lin, domains, scopes, p), {k: v for s in scopes.values() for k, v in s.labels.items()}
    headers = accessions.where("taxid is not null").select("accession", "taxid", F.explode("headers").alias("h")).where("h.id is not null")
    found = sequences.select("header_id", F.length("seq").cast("bigint").alias("length")).where("length > 0")
    leaves = headers.select(F.col("h.id").alias("header_id"), F.col("taxid").alias("node_id"), splitting.genome_key("accession", F.col("h.id")).alias("genome_key")).groupBy("node_id", "header_id").agg(F.min("genome_key").alias("genome_key"))
    leaves = cut(leaves.join(found, "header_id").join(paths.select(F.col("taxid").alias("node_id")), "node_id", "left_semi"))
    used = cut(paths.join(leaves.select(F.col("node_id").alias("taxid")).distinct(), "taxid", "left_semi"))
    info = lin.select(F.explode("path").alias("x")).select("x.*").where("taxid is not null")
    names = hierarchy.nodes(used, "ids", info, labels or None)
    clo = leaves.select(F.col("header_id").alias("leaf"), F.col("node_id").alias("taxid")).join(hierarchy.closure(used, "taxid"), "taxid").select("leaf", "ancestor", "distance")
    return Tree(used, cut(names), leaves, cut(clo), cut(node_closure(used)))


def forest(lin: DataFrame, domains: list[str | None], scopes: dict[str, hierarchy.Scope], p: GenerateParams) -> DataFrame:
    """``taxid, ids``: cleaned paths of each domain, anchored there and routed by its own scope; a root above them where there is no single domain.

    A taxid that lies in several of the domains keeps the path of the first one named.
    """
    if not domains:
        raise ValueError("no domain")
    out = None
    for i, domain in enumerate(domains):
        one = lin.where(hierarchy.in_scope("path", domain)).select("taxid", F.lit(i).alias("o"), hierarchy.clean_path("path", "taxid", p.noise).alias("ids"))
        if domain is not None:
            one = one.withColumn("ids", hierarchy.anchor("ids", domain))
            if domain in scopes:
                one = one.withColumn("ids", hierarchy.redirect("ids", scopes[domain], p.all_ranks))
        out = one if out is None else out.unionByName(one)
    if len(domains) > 1:
        out = out.groupBy("taxid").agg(F.min(F.struct("o", "ids")).alias("m")).select("taxid", F.col("m.ids").alias("ids"))
    if len(domains) > 1 or domains[0] is None:
        out = out.withColumn("ids", F.concat(F.array(F.lit("root")), "ids"))
    return out.select("taxid", "ids")


def cross_domain_leaves(accessions: DataFrame, sequences: DataFrame, tree: Tree) -> DataFrame | None:
    """``leaf, genome_key, length`` of downloaded accessions marked cross_domain whose sequences lie outside the tree; None if the catalogue has no such mark."""
    if "cross_domain" not in accessions.columns:
        return None
    marked = accessions.where(F.coalesce("cross_domain", F.lit(False)) & F.coalesce("downloaded", F.lit(False)))
    h = marked.select("accession", F.explode("headers").alias("h")).where("h.id is not null").select(F.col("h.id").alias("leaf"), splitting.genome_key("accession", F.col("h.id")).alias("genome_key"))
    found = sequences.select(F.col("header_id").alias("leaf"), F.length("seq").cast("bigint").alias("length")).where("length > 0")
    out = h.groupBy("leaf").agg(F.min("genome_key").alias("genome_key")).join(found, "leaf")
    return cut(out.join(tree.leaves.select(F.col("header_id").alias("leaf")), "leaf", "left_anti"))


def without(tree: Tree, held: DataFrame) -> Tree:
    """The tree without held-out clades and everything under them."""
    gone = held.select(F.col("node_id").alias("taxid"))
    paths = cut(hierarchy.prune(tree.paths, gone))
    leaves = cut(openset.retained_leaves(tree.leaves, tree.node_closure, held))
    kept = paths.select(F.explode("ids").alias("node_id")).distinct()
    clo = tree.closure.join(leaves.select(F.col("header_id").alias("leaf")), "leaf", "left_semi")
    return Tree(paths, cut(tree.nodes.join(kept, "node_id", "left_semi")), leaves, cut(clo), cut(node_closure(paths)))


def holdout(tree: Tree, sequences: DataFrame, p: GenerateParams, k: int = 21, size: int = 200) -> tuple[DataFrame, DataFrame]:
    """Held-out clades and their manifest."""
    counts = tree.closure.groupBy(F.col("ancestor").alias("node_id")).agg(F.count_distinct("leaf").alias("n_leaves"))
    held = cut(openset.select_holdout(openset.eligible(tree.nodes, counts), tree.node_closure, explicit=list(p.holdout_clades), rank=p.holdout_rank, fraction=p.holdout_fraction, seed=p.seed))
    first = tree.closure.groupBy("ancestor").agg(F.min("leaf").alias("header_id"))
    sk = cut(first.join(bottom_k(sequences.join(first.select("header_id").distinct(), "header_id", "left_semi"), ["header_id"], "seq", k, size), "header_id").select(F.col("ancestor").alias("node_id"), "sketch"))
    rho = openset.retained_ancestor(held, tree.node_closure)
    q = rho.join(sk, "node_id").select(F.col("rho").alias("group"), F.col("node_id").alias("query"), "sketch")
    kids = tree.nodes.select(F.col("parent_id").alias("group"), "node_id").join(held, "node_id", "left_anti").join(sk, "node_id").select("group", F.col("node_id").alias("candidate"), "sketch")
    manifest = openset.holdout_manifest(held, tree.nodes, tree.node_closure, tree.leaves, similarity.nearest(q, kids, k, size), p.seed)
    return held, cut(manifest)


def capacities(tree: Tree, sequences: DataFrame, p: GenerateParams) -> DataFrame:
    """``node_id, capacity`` of all nodes."""
    s = sequences.select(F.col("header_id").alias("leaf"), F.upper("seq").alias("seq")).join(tree.leaves.select(F.col("header_id").alias("leaf")).distinct(), "leaf", "left_semi")
    if p.approximate_capacity:
        c = windows.capacity_approximate(s.join(tree.closure, "leaf"), ["ancestor"], "seq", p.min_len)
    else:
        c = windows.capacity_by_closure(s, "leaf", "seq", p.min_len, tree.closure)
    return cut(c.select(F.col("ancestor").alias("node_id"), "capacity"))


def classes(tree: Tree, caps: DataFrame, p: GenerateParams) -> tuple[DataFrame, DataFrame]:
    """``(classes, members)``: classes ``head, child, rank, name, capacity, scenario, n_per_class, budget, class_idx``; members ``head, child, node_id`` are the tree nodes of a class.

    Passes in the published order: passthroughs, rank buckets, rare taxa, capacities, scenario, low-capacity and rare buckets. A rank bucket's capacity is
    the sum of its children's; its leaves are all leaves under them.
    """
    counts = tree.closure.groupBy(F.col("ancestor").alias("node_id")).agg(F.count_distinct("leaf").alias("n_leaves"))
    kids = tree.nodes.where("parent_id is not null").join(counts, "node_id").join(caps, "node_id", "left")
    kids = kids.select(F.col("parent_id").alias("head"), F.col("node_id").alias("child"), "rank", F.col("sci_name").alias("name"), F.pmod(F.xxhash64("node_id"), F.lit(1 << 40)).alias("ord"), "n_leaves", F.coalesce("capacity", F.lit(0)).alias("capacity"))
    several = kids.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("head")
    kids = kids.join(several, "head", "left_semi")
    names = tree.nodes.select(F.col("node_id").alias("head"), F.col("sci_name").alias("head_name"))
    b = bucketing.rank_buckets(kids, p.balance, p.all_ranks).join(names, "head", "left")
    in_rank = b.withColumn("effective", F.coalesce("bucket_id", "child"))
    merged = cut(
        in_rank.groupBy("head", "effective").agg(
            F.coalesce(F.max("bucket_rank"), F.max("rank")).alias("rank"), F.coalesce(F.max(F.concat("bucket_rank", F.lit("_"), "head_name")), F.max("name")).alias("name"), F.min("ord").alias("ord"), F.sum("n_leaves").alias("n_leaves"), F.sum("capacity").alias("capacity")
        )
    )
    plan = cut(bucketing.balanced_plan(merged.withColumnRenamed("effective", "child"), p.balance).join(merged.select("head", F.col("effective").alias("child"), "rank", "name", "ord"), ["head", "child"]).join(names, "head", "left"))
    purpose = F.when(F.col("status") == "low_capacity", "low_capacity").when(F.col("status") == "rare", "rare_taxa")
    plan = plan.withColumn("final", F.when(purpose.isNull(), F.col("child")).otherwise(virtual_id("head", purpose))).withColumn("purpose", purpose)
    out = plan.groupBy("head", "final").agg(
        F.max("scenario").alias("scenario"), F.max("n_per_class").alias("n_per_class"), F.sum("capacity").alias("capacity"), F.min("ord").alias("ord"), F.max("purpose").alias("purpose"), F.max("rank").alias("rank"), F.max("name").alias("name"), F.max("head_name").alias("head_name")
    )
    own = F.least(F.when(F.col("capacity") > 0, F.col("capacity")).otherwise(F.col("n_per_class")), F.lit(p.balance.max_n_per_class))
    out = out.select(
        "head", F.col("final").alias("child"), F.coalesce(F.concat(F.lit("virtual_"), "purpose"), "rank").alias("rank"), F.coalesce(F.concat(F.lit("virtual_"), "purpose", F.lit("_"), "head_name"), "name").alias("name"),
        "scenario", "n_per_class", "capacity", "ord", (own if p.keep_imbalance else F.col("n_per_class")).cast("bigint").alias("budget"),
    )
    members = in_rank.select("head", "effective", F.col("child").alias("node_id")).join(plan.select("head", F.col("child").alias("effective"), F.col("final").alias("child")), ["head", "effective"]).select("head", "child", "node_id")
    # heads under a node that some head absorbed aren't entered
    absorbed = members.where("child <> node_id").select(F.col("node_id").alias("ancestor")).distinct()
    shut = tree.node_closure.join(absorbed, "ancestor", "left_semi").select(F.col("node_id").alias("head")).distinct()
    out = out.join(shut, "head", "left_anti")
    if p.single_level:
        out = out.where(F.col("head") == p.single_level)
    if p.stop_at:
        deep = tree.nodes.where(below("rank", p.stop_at)).select(F.col("node_id").alias("head"))
        out = out.join(deep, "head", "left_anti")
    out = cut(audit.class_indices(out))
    return out, cut(members.join(out.select("head", "child"), ["head", "child"], "left_semi"))


def class_tasks(tree: Tree, cls: DataFrame, members: DataFrame, p: GenerateParams) -> DataFrame:
    """Each class's budget over its leaves: ``head, child, class_idx, header_id, genome_key, n, length``."""
    under = tree.closure.select(F.col("ancestor").alias("node_id"), F.col("leaf").alias("header_id"))
    leaves = members.join(under, "node_id").select("head", "child", "header_id").distinct()
    info = tree.leaves.groupBy("header_id").agg(F.min("genome_key").alias("genome_key"), F.max("length").alias("length"))
    rows = leaves.join(info, "header_id").withColumn("weight", F.greatest(F.lit(0), F.col("length") - (p.min_len - 1)).cast("bigint")).join(cls.select("head", "child", "class_idx", "budget"), ["head", "child"])
    return allocation.allocate(rows, ["head", "child"], "weight", "budget", "header_id").where("n > 0").select("head", "child", "class_idx", "header_id", "genome_key", "n", "length")


def reject_class(tree: Tree, cls: DataFrame, p: GenerateParams, cross: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The reject class of every head and its tasks; near and far pools by decidable depth. Leaves of other domains (``cross``) go to shallow heads."""
    r = p.reject
    heads = cls.groupBy("head").agg(F.max("class_idx").alias("last"), F.max("n_per_class").alias("n_per_class")).join(tree.nodes.select(F.col("node_id").alias("head"), (F.col("depth") + 1).alias("depth")), "head")
    pools = cut(negatives.near_far_pools(heads, tree.closure, r, cross))
    sizes = pools.groupBy("head").agg(F.count_if(F.col("pool") == "near").alias("n_near"), F.count_if(F.col("pool") == "far").alias("n_far"))
    depth = hierarchy.decidable_depth(tree.paths, tree.nodes).select(F.col("node_id").alias("head"), "decidable_depth")
    n = F.rint(F.col("n_per_class") * r.fraction).cast("bigint")
    b = heads.join(sizes, "head").join(depth, "head").select("head", "last", negatives.reject_budget(n, F.col("n_near"), F.col("n_far"), negatives.near_ratio("decidable_depth", r)).alias("b"))
    budgets = b.select("head", F.explode(F.array(F.struct(F.lit("near").alias("pool"), F.col("b.near").alias("budget")), F.struct(F.lit("far").alias("pool"), F.col("b.far").alias("budget")))).alias("x")).select("head", "x.pool", "x.budget")
    info = tree.leaves.groupBy(F.col("header_id").alias("leaf")).agg(F.min("genome_key").alias("genome_key"), F.max("length").alias("length"))
    if cross is not None:
        info = info.unionByName(cross)
    weighted = pools.join(info, "leaf").withColumn("weight", F.greatest(F.lit(0), F.col("length") - (p.min_len - 1)).cast("bigint"))
    made = negatives.reject_tasks(weighted, budgets).join(info, "leaf")
    ids = b.select("head", virtual_id("head", F.lit("reject")).alias("child"), (F.col("last") + 1).cast("int").alias("class_idx"))
    tasks = made.join(ids, "head").groupBy("head", "child", "class_idx", F.col("leaf").alias("header_id")).agg(F.max("genome_key").alias("genome_key"), F.sum("n").alias("n"), F.max("length").alias("length"))
    names = ids.join(negatives.reject_nodes(tree.nodes.select(F.col("node_id").alias("head"), F.col("sci_name").alias("name"))).select("head", "rank", "name"), "head")
    return names.join(made.select("head").distinct(), "head", "left_semi"), tasks


def binary_tasks(tree: Tree, caps: DataFrame, p: GenerateParams) -> DataFrame:
    """Tasks of a binary head for every node that isn't a passthrough: its own leaves as class 1, as many negatives as class 0; heads without either are left out."""
    alive = hierarchy.child_counts(tree.nodes).where("not is_passthrough").select("node_id")
    if p.stop_at:
        alive = alive.join(tree.nodes.where(below("rank", p.stop_at)).select("node_id"), "node_id", "left_anti")
    heads = negatives.binary_heads(alive.join(caps, "node_id").select(F.col("node_id").alias("head"), "capacity"), p.binary_budget)
    info = tree.leaves.groupBy("header_id").agg(F.min("genome_key").alias("genome_key"), F.max("length").alias("length")).withColumn("weight", F.greatest(F.lit(0), F.col("length") - (p.min_len - 1)).cast("bigint"))
    own = tree.closure.select(F.col("ancestor").alias("head"), F.col("leaf").alias("header_id")).distinct().join(heads, "head").join(info, "header_id")
    pos = allocation.allocate(own, ["head"], "weight", "n_positive", "header_id").select("head", F.lit("positive").alias("child"), F.lit(1).alias("class_idx"), "header_id", "genome_key", "n", "length")
    r = p.reject or negatives.RejectParams(seed=p.seed)
    pools = cut(negatives.near_far_pools(heads, tree.closure, r))
    sizes = pools.groupBy("head").agg(F.count_if(F.col("pool") == "near").alias("a"), F.count_if(F.col("pool") == "far").alias("f"))
    b = heads.join(sizes, "head").select("head", negatives.reject_budget(F.col("n_negative"), F.col("a"), F.col("f"), F.lit(r.near_start)).alias("b"))
    budgets = b.select("head", F.lit("near").alias("pool"), F.col("b.near").alias("budget")).unionByName(b.select("head", F.lit("far").alias("pool"), F.col("b.far").alias("budget")))
    weighted = pools.join(info.withColumnRenamed("header_id", "leaf"), "leaf")
    neg = negatives.reject_tasks(weighted, budgets).join(info.withColumnRenamed("header_id", "leaf"), "leaf").groupBy("head", F.col("leaf").alias("header_id")).agg(F.max("genome_key").alias("genome_key"), F.sum("n").alias("n"), F.max("length").alias("length"))
    neg = neg.select("head", F.lit("negative").alias("child"), F.lit(0).alias("class_idx"), "header_id", "genome_key", "n", "length")
    both = cut(pos.where("n > 0").unionByName(neg.where("n > 0")))
    full = both.groupBy("head").agg(F.count_distinct("class_idx").alias("c")).where("c = 2").select("head")
    return both.join(full, "head", "left_semi")


def dereplicated(tasks: DataFrame, sequences: DataFrame, threshold: float) -> DataFrame:
    """Tasks of genomes that aren't near-copies of a kept one of their class."""
    g = tasks.select("head", "child", "genome_key", "header_id").join(sequences.select("header_id", "seq"), "header_id")
    sk = cut(bottom_k(g.withColumn("cls", F.concat_ws("|", "head", "child")), ["cls", "genome_key"], "seq"))
    kept = similarity.dereplicate(sk, "cls", "genome_key", similarity.ClusterParams(copies=threshold)).where("kept_as = genome_key").select("cls", "genome_key")
    return tasks.withColumn("cls", F.concat_ws("|", "head", "child")).join(kept, ["cls", "genome_key"], "left_semi").drop("cls")


def split_all(tasks: DataFrame, sequences: DataFrame, p: GenerateParams, negative: DataFrame | None = None, rules: splitting.SplitRules = splitting.SplitRules()) -> DataFrame:
    """Splits of all tasks; with ``cluster_aware`` classes are split inside clusters of similar genomes where that fills every split."""
    if p.dereplicate is not None:
        tasks = cut(dereplicated(tasks, sequences, p.dereplicate))
    if p.cluster_aware:
        first = tasks.groupBy("head", "child", "genome_key").agg(F.min("header_id").alias("header_id"))
        sk = cut(bottom_k(first.join(sequences.select("header_id", "seq"), "header_id").withColumn("cls", F.concat_ws("|", "head", "child")), ["cls", "genome_key"], "seq"))
        found = similarity.cluster_genomes(sk, "cls", "genome_key").select(F.split("cls", r"\|")[0].alias("head"), F.split("cls", r"\|")[1].alias("child"), "genome_key", "cluster")
        clustered = cut(splitting.cluster_split(tasks, found, rules).drop("cluster"))
        rest = tasks.join(clustered.select("head", "child").distinct(), ["head", "child"], "left_anti")
        columns = [*tasks.columns, "split", "start_pct", "end_pct"]
        out = clustered.select(*columns).unionByName(splitting.split_classes(rest, p.max_len, rules=rules).select(*columns))
    else:
        out = splitting.split_classes(tasks, p.max_len, rules=rules)
    if negative is not None:
        out = out.unionByName(splitting.split_classes(negative, p.max_len, block_large=True, rules=rules))
    return out


@dataclass(frozen=True)
class Generated:
    tree: Tree
    classes: DataFrame
    tasks: DataFrame
    samples: DataFrame
    label_maps: DataFrame | None
    reliability: DataFrame
    manifest: DataFrame | None


def generate(accessions: DataFrame, lineages: DataFrame, sequences: DataFrame, p: GenerateParams = GenerateParams(), *, binary: bool = False) -> Generated:
    """Datasets of all heads, as lazy tables over written stages."""
    tree = build_tree(accessions, lineages, sequences, p)
    manifest = None
    if p.holdout_clades or p.holdout_rank:
        held, manifest = holdout(tree, sequences, p)
        tree = without(tree, held)
    caps = capacities(tree, sequences, p)
    if binary:
        tasks = binary_tasks(tree, caps, p)
        pos, neg = tasks.where("class_idx = 1"), tasks.where("class_idx = 0")
        split = written(split_all(pos, sequences, p, neg, splitting.SplitRules(min_genomes=4)))
        cls, maps = tasks.groupBy("head", "child", "class_idx").agg(F.sum("n").alias("n_windows")), None
    else:
        cls, members = classes(tree, caps, p)
        tasks = class_tasks(tree, cls, members, p)
        negative = None
        if p.reject is not None:
            extra, negative = reject_class(tree, cls, p, cross_domain_leaves(accessions, sequences, tree) if p.reject.cross_domain_max_depth > 0 else None)
            cls = cls.unionByName(extra, allowMissingColumns=True)
        split = written(split_all(tasks, sequences, p, negative))
        n = split.groupBy("head", "class_idx").agg(F.sum("n").alias("n_windows"))
        maps = audit.label_maps(cls.withColumn("taxid", F.col("child")).join(n, ["head", "class_idx"]))
    samples = sampling.extract(split, sequences, sampling.DrawParams(p.min_len, p.max_len, p.seed))
    if p.mutation_rate > 0:
        samples = sampling.augment_train(samples, p.mutation_rate, p.seed)
    return Generated(tree, cls, split, samples, maps, audit.head_reliability(split), manifest)


def catalogue_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The current ``accession, lineage, sequence`` tables of a catalogue."""
    return tuple(read_table(spark, f"{folder}/{t}") for t in ("accession", "lineage", "sequence"))
