"""Rules of the reference's operators on small hand-made tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sylva.functions.sketch import bottom_k
from sylva.operators import allocation, audit, bucketing, hierarchy, negatives, openset, sampling, selection, similarity, splitting, windows

PATH = "taxid string, path array<struct<taxid: string, rank: string, name: string>>"


def lineage(spark, *paths):
    return spark.createDataFrame([(p[0][0], p) for p in paths], PATH)


def test_noise_rules(spark):
    rules = hierarchy.NoiseRules.of({"patterns": [{"regex": "^unclassified\\b"}, {"regex": "("}, {}], "rank_blacklist": {"ranks": ["Strain"]}})
    assert rules.patterns == ("^unclassified\\b",) and hierarchy.NoiseRules.of({}) == hierarchy.NoiseRules()
    df = spark.createDataFrame([("Unclassified x", None), ("a", "STRAIN"), ("", None), (None, "genus")], "name string, rank string")
    got = df.select(hierarchy.is_noise("name", "rank", rules).alias("n"), hierarchy.explain_noise("name", "rank", rules).alias("w")).collect()
    assert [tuple(r) for r in got] == [(True, "^unclassified\\b"), (True, "rank:strain"), (False, None), (False, None)]
    assert tuple(hierarchy.noise_counts(df, "name", "rank", rules).first()) == (4, 1, 1)


def test_clean_anchor_redirect(spark):
    lin = lineage(spark, [("s", "species", "unclassified s"), ("g", "genus", "G"), ("d", "superkingdom", "D")], [("q", "strain", "Q"), ("x", "genus", "unclassified")], [("d", "superkingdom", "D")])
    rules = hierarchy.NoiseRules(("^unclassified",), ("strain",))
    got = {r.taxid: r.ids for r in lin.select("taxid", hierarchy.clean_path("path", "taxid", rules).alias("ids")).collect()}
    assert got == {"s": ["d", "g"], "q": [], "d": ["d"]}
    df = spark.createDataFrame([(["d", "g", "s"],), (["r", "d", "s"],), (["x"],), ([],)], "ids array<string>")
    assert [r[0] for r in df.select(hierarchy.anchor("ids", "d")).collect()] == [["d", "g", "s"], ["d", "s"], ["d", "x"], ["d"]]
    scope = hierarchy.Scope("d", {"g": "G", "h": "h"}, "none")
    rows = [(["d", "g", "s"],), (["d", "h", "s"],), (["d", "x", "g", "s"],), (["d"],), (["e", "g"],), (["d", "y", "z"],)]
    d2 = spark.createDataFrame(rows, "ids array<string>")
    assert [r[0] for r in d2.select(hierarchy.redirect("ids", scope)).collect()] == [["d", "G", "g", "s"], ["d", "h", "s"], ["d", "none", "s"], ["d"], ["e", "g"], ["d", "none", "z"]]
    assert d2.select(hierarchy.redirect("ids", scope, True)).collect()[2][0] == ["d", "x", "G", "g", "s"]
    assert d2.select(hierarchy.redirect("ids", hierarchy.Scope("d"))).collect()[0][0] == ["d", "g", "s"]


def test_resolve_root(spark):
    info = spark.createDataFrame([("7", "Name"), ("8", "Twice"), ("9", "twice")], "taxid string, name string")
    assert [hierarchy.resolve_root(x, info) for x in ("all", "Viruses", "77", "name")] == [None, "10239", "77", "7"]
    for bad in ("twice", "nobody"):
        with pytest.raises(ValueError):
            hierarchy.resolve_root(bad, info)


def test_tree_depths_and_prune(spark):
    p = spark.createDataFrame([("c", ["r", "a", "b", "c"]), ("d", ["r", "a", "b", "d"]), ("e", ["r", "f", "e"])], "taxid string, ids array<string>")
    n = hierarchy.nodes(p)
    depth = {r.node_id: r.decidable_depth for r in hierarchy.decidable_depth(p, n).collect()}
    assert depth == {"r": 1, "a": 1, "b": 2, "c": 3, "d": 3, "f": 1, "e": 2}
    assert {r.taxid for r in hierarchy.prune(p, spark.createDataFrame([("b",)], "taxid string")).collect()} == {"e"}
    assert hierarchy.closure(p, "taxid").count() == 11
    assert hierarchy.nodes(p.limit(0)).count() == 0


def test_capacity_against_sets(spark):
    rng = random.Random(5)
    rows = [(rng.choice("xy"), "".join(rng.choice("ACGTN") for _ in range(rng.randint(0, 60)))) for _ in range(40)] + [("x", None)]
    df = spark.createDataFrame(rows, "g string, s string")
    want = {g: len({s[i : i + 4] for h, s in rows if h == g and s for i in range(len(s) - 3)}) for g in "xy"}
    assert {r.g: r.capacity for r in windows.node_capacity(df, ["g"], "s", 4).collect()} == want
    assert {r.g: r.capacity for r in windows.node_capacity(df, ["g"], "s", 4, max_useful=3).collect()} == {g: min(15, n) for g, n in want.items()}
    approx = {r.g: r.capacity for r in windows.node_capacity(df, ["g"], "s", 4, mode="approximate").collect()}
    assert all(abs(approx[g] - n) <= 0.05 * n + 1 for g, n in want.items())
    with pytest.raises(ValueError):
        windows.node_capacity(df, ["g"], "s", 4, mode="other")
    with pytest.raises(ValueError):
        windows.capacity(df, ["g"], "s", 0)


def test_allocation_sums_to_the_budget(spark):
    rng = random.Random(6)
    rows = [(f"c{c}", f"l{i:02d}", rng.choice([0, 1, 5, 100, 1000]), b) for c in range(20) for b in [rng.choice([0, 1, 7, 100])] for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "c string, l string, w bigint, b bigint")
    got = allocation.allocate(df, ["c"], "w", "b", "l").groupBy("c").agg(F.sum("n").alias("n"), F.first("b").alias("b"), F.min("n").alias("least")).collect()
    assert got and all(r.n == r.b and r.least >= 0 for r in got)
    # the sequential rule
    for c in {r[0] for r in rows}:
        leaves = sorted((l, w, b) for cc, l, w, b in rows if cc == c and w > 0)
        run, want = 0, {}
        for i, (l, w, b) in enumerate(leaves):
            n = b - run if i == len(leaves) - 1 else min(round(b * w / sum(x[1] for x in leaves)), b - run)
            want[l], run = n, run + n
        assert {r.l: r.n for r in allocation.allocate(df.where(F.col("c") == c), ["c"], "w", "b", "l").collect()} == want


def kids(spark, *rows):
    return spark.createDataFrame([("h", f"c{i}", r, i, n, cap) for i, (r, n, cap) in enumerate(rows)], "head string, child string, rank string, ord bigint, n_leaves bigint, capacity bigint")


def test_rank_buckets(spark):
    df = kids(spark, *[("genus", 1, 1)] * 6, *[("clade", 1, 1)] * 5, ("order", 1, 1), (None, 1, 1), ("virtual_misc", 1, 1))
    got = {r.child: r.bucket_rank for r in bucketing.rank_buckets(df).collect()}
    assert [got[f"c{i}"] for i in range(14)] == [None] * 6 + ["virtual_clade"] * 5 + ["virtual_misc"] * 2 + [None]
    assert bucketing.modal_rank(kids(spark, ("b", 1, 1), ("a", 1, 1))).first().canonical_rank == "b"
    assert all(r.bucket_id is None for r in bucketing.rank_buckets(df, all_ranks=True).collect())


def test_balanced_plan(spark):
    p = bucketing.BalanceParams(min_num_seqs=100, cutoff_percentage=60.0, max_n_per_class=500)
    plan = lambda *rows: {r.child: r for r in bucketing.balanced_plan(kids(spark, *rows), p).collect()}
    g = plan(("g", 5, 120), ("g", 5, 300))
    assert (g["c0"].scenario, g["c0"].n_per_class) == ("level_all", 120)
    g = plan(("g", 5, 900), ("g", 5, 600))
    assert (g["c0"].scenario, g["c0"].n_per_class) == ("level_all_capped", 500)
    g = plan(("g", 5, 10), ("g", 5, 50), ("g", 5, 400), ("g", 1, 0))
    assert [g[f"c{i}"].status for i in range(4)] == ["low_capacity", "retained", "retained", "rare"] and g["c1"].n_per_class == 50
    g = plan(("g", 1, 10), ("g", 1, None), ("g", 9, 400))  # one eligible child: no diversion
    assert not any(r.is_rare for r in g.values())
    assert {r.bucket_rank for r in bucketing.absorbing_buckets(bucketing.balanced_plan(kids(spark, ("g", 5, 10), ("g", 5, 50), ("g", 5, 400), ("g", 1, 0)), p)).collect()} == {"virtual_low_capacity", "virtual_rare_taxa"}


def test_stratified_counts_and_blocks(spark):
    df = spark.createDataFrame([(n,) for n in range(-1, 40)], "n bigint")
    got = {r.n: tuple(r.c) for r in df.select("n", splitting.stratified_counts("n").alias("c")).collect()}
    assert [got[n] for n in (0, 1, 2, 3, 4)] == [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (2, 1, 1)]
    assert all(sum(c) == max(0, n) and (n < 3 or min(c) >= 1) for n, c in got.items())
    assert splitting.label_blocks(2) is None
    for n in range(3, 65):
        labels = splitting.label_blocks(n)
        assert len(labels) == n and set(labels) == {"train", "val", "test"} and labels.count("train") >= labels.count("val")


def tasks(spark, genomes, length=10**6):
    rows = [("h", c, 0, f"{g}-{i}", g, n, length) for c, g, ns in genomes for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "head string, child string, class_idx int, header_id string, genome_key string, n bigint, length bigint")


def test_genomes_never_straddle_and_no_split_is_empty(spark):
    t = tasks(spark, [("a", f"g{i}", [n, n]) for i, n in enumerate([50, 1, 1, 1, 1])] + [("b", "x", [9]), ("b", "y", [9])])
    out = splitting.split_classes(t, 1000)
    a = out.where("child = 'a'").groupBy("genome_key").agg(F.count_distinct("split").alias("s")).collect()
    assert all(r.s == 1 for r in a)
    assert {r.split for r in out.where("child = 'a'").collect()} == {"train", "val", "test"}
    assert out.agg(F.sum("n")).first()[0] == t.agg(F.sum("n")).first()[0]
    b = out.where("child = 'b'").collect()
    assert {r.split for r in b} == {"train", "val", "test"} and all(0 <= r.start_pct < r.end_pct <= 1 for r in b)


def test_dominant_negative_genome_is_cut_to_blocks(spark):
    t = tasks(spark, [("a", "big", [870])] + [("a", f"s{i}", [10]) for i in range(13)])
    v = {r.split: r.n for r in splitting.split_classes(t, 1000, block_large=True).groupBy("split").agg(F.sum("n").alias("n")).collect()}
    assert sum(v.values()) == 1000 and v["train"] < 760 and v["val"] > 100 and v["test"] > 100
    short = splitting.split_classes(tasks(spark, [("a", "g", [7])], length=1500), 1000).collect()
    assert {(r.split, round(r.start_pct, 2)) for r in short} == {("train", 0.0), ("val", 0.33), ("test", 0.67)}


def test_near_and_far(spark):
    clo = spark.createDataFrame([(leaf, a, i) for leaf, path in {"l1": "a b r", "l2": "a b r", "l3": "c b r", "l4": "d r"}.items() for i, a in enumerate(path.split())], "leaf string, ancestor string, distance int")
    heads = spark.createDataFrame([("a", "A"), ("b", "B"), ("r", "R")], "head string, name string")
    got = {(r["head"], r["leaf"]): r.pool for r in negatives.near_far_pools(heads, clo).collect()}
    assert got == {("a", "l3"): "near", ("a", "l4"): "far", ("b", "l4"): "near"}
    capped = negatives.near_far_pools(heads, clo, negatives.RejectParams(max_per_pool=1)).groupBy("head", "pool").count().collect()
    assert all(r["count"] == 1 for r in capped)
    sizes = {r["head"]: (r.n_near, r.n_far) for r in negatives.near_pool_sizes(heads, clo).collect()}
    assert sizes == {"a": (1, 1), "b": (1, 0)}
    # a head with two parents holds a leaf that the nearer one lacks
    dag = clo.unionByName(spark.createDataFrame([("l5", "a", 0), ("l5", "d", 1), ("l5", "r", 2)], "leaf string, ancestor string, distance int"))
    sizes = {r["head"]: (r.near_root, r.n_near, r.n_far) for r in negatives.near_pool_sizes(heads, dag).collect()}
    pools = {(r["head"], r.pool): r["count"] for r in negatives.near_far_pools(heads, dag).groupBy("head", "pool").count().collect()}
    assert all(pools.get((h, "near"), 0) == n and pools.get((h, "far"), 0) == f for h, (_, n, f) in sizes.items()) and "r" not in sizes
    # other domains: shallow heads only, capped with the far pool; the root's only negatives
    deep = spark.createDataFrame([("a", 3), ("b", 2), ("r", 1)], "head string, depth int")
    cross = spark.createDataFrame([(f"x{i}",) for i in range(9)], "leaf string")
    p = negatives.RejectParams(max_per_pool=5, cross_domain_max_depth=2)
    far = {}
    for r in negatives.near_far_pools(deep, clo, p, cross).where("pool = 'far'").collect():
        far.setdefault(r["head"], set()).add(r["leaf"])
    assert far["a"] == {"l4"} and len(far["b"]) == 5 and len(far["r"]) == 5 and all(x.startswith("x") for x in far["b"] | far["r"])
    b = spark.createDataFrame([(10, 3, 3, 0.5), (10, 0, 3, 0.5), (10, 3, 0, 0.5), (0, 3, 3, 0.5), (5, 0, 0, 0.5), (5, 1, 1, 0.5)], "n bigint, a bigint, f bigint, r double")
    assert [tuple(r[0]) for r in b.select(negatives.reject_budget(F.col("n"), F.col("a"), F.col("f"), F.col("r"))).collect()] == [(5, 5), (0, 10), (10, 0), (0, 0), (0, 0), (2, 3)]


def test_similarity(spark):
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(400))
    other = "".join(rng.choice("ACGT") for _ in range(400))
    rows = [("g", "a", base), ("g", "b", base), ("g", "c", base[:390] + "ACGTTTACGA"), ("g", "d", other), ("g", "e", other[60:]), ("g", "f", "AC")]
    sk = bottom_k(spark.createDataFrame(rows, "grp string, id string, s string"), ["grp", "id"], "s", 11, 100)
    pairs = {(r.a, r.b) for r in similarity.similar_pairs(sk, "grp", "id", 0.5, 100).collect()}
    assert pairs == {("a", "c"), ("d", "e")}
    assert {r.id: r.rep for r in similarity.sketch_classes(sk, "grp", "id").collect()}["b"] == "a"
    clusters = {r.id: r.cluster for r in similarity.cluster_genomes(sk, "grp", "id", similarity.ClusterParams(k=11, sketch_size=100)).collect()}
    assert clusters == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f"}
    kept = {r.id: r.kept_as for r in similarity.dereplicate(sk, "grp", "id", similarity.ClusterParams(k=11, sketch_size=100, copies=0.6)).collect()}
    assert kept == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f"}
    e = spark.createDataFrame([("g", str(i), str(i + 1)) for i in range(20)], "grp string, a string, b string")
    n = spark.createDataFrame([("g", str(i)) for i in range(22)], "grp string, node string")
    comp = {r.node: r.component for r in similarity.components(n, e, "grp").collect()}
    assert comp["21"] == "21" and {comp[str(i)] for i in range(21)} == {"0"}


def test_sampling_laws_and_determinism(spark):
    p = sampling.DrawParams(5, 10)
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(200))
    rows = [("h", "train", 0, "long", 8), ("h", "train", 0, "mid", 8), ("h", "train", 0, "poly", 8), ("h", "val", 0, "short", 6), ("h", "val", 0, "one", 50), ("h", "val", 0, "tiny", 3), ("h", "val", 0, "none", 3), ("h", "val", 0, "null", 3), ("h", "val", 0, "long", 0)]
    t = spark.createDataFrame(rows, "head string, split string, class_idx int, header_id string, n bigint").withColumns({"start_pct": F.lit(0.0), "end_pct": F.lit(1.0), "i": F.lit(7)})
    s = spark.createDataFrame([("long", seq), ("mid", seq[:100]), ("poly", "A" * 200), ("short", seq[:30].lower()), ("one", "C" * 30), ("tiny", "ACG"), ("null", None)], "header_id string, seq string").withColumn("n", F.lit(1))
    a = sorted(map(tuple, sampling.extract(t, s, p).collect()))
    assert a == sorted(map(tuple, sampling.extract(t.repartition(3), s, p).collect()))
    by = {k: [r for r in a if r[3] == k] for k in ("long", "mid", "poly", "short", "one", "tiny", "null")}
    # tiled laws give exactly n, equal windows too; the random one gives different ones, and what an exhausted sequence holds
    assert [len(by[k]) for k in ("long", "mid", "poly", "short", "tiny", "null")] == [8, 8, 8, 6, 0, 0]
    assert len({r[5] for r in by["short"]}) == 6 and {r[5] for r in by["one"]} == {b * i for b in "CG" for i in range(5, 11)} and len(by["one"]) == 12
    assert all(sorted(r[4] for r in rows) == list(range(len(rows))) for rows in by.values())
    rc = str.maketrans("ACGT", "TGCA")
    for k, source in (("long", seq), ("mid", seq[:100]), ("short", seq[:30])):
        assert all(5 <= len(r[5]) <= 10 and (r[5] in source or r[5][::-1].translate(rc) in source) for r in by[k])
    with pytest.raises(ValueError):
        sampling.DrawParams(5, 4)
    more = sampling.augment_train(sampling.extract(t, s, p), 0.5)
    assert more.where("split = 'train'").count() == 48 and more.where("split = 'val'").count() == 18
    assert sampling.extract(t.limit(0), s, p).count() == 0


def test_large_budgets_are_cut_in_blocks(spark):
    n = 2 * sampling.BLOCK + 3
    p = sampling.DrawParams(2, 2)
    t = spark.createDataFrame([("h", "train", 0, "x", n, 0.0, 1.0), ("h", "train", 1, "x", n, 0.0, 0.3)], "head string, split string, class_idx int, header_id string, n bigint, start_pct double, end_pct double")
    s = spark.createDataFrame([("x", "ACGT" * n)], "header_id string, seq string")
    got = sampling.extract(t, s, p).groupBy("class_idx").agg(F.count_distinct("i").alias("n"), F.max("i").alias("m")).collect()
    assert {r.class_idx: (r.n, r.m) for r in got} == {0: (n, n - 1), 1: (4, 3)}  # a part with four different windows


def test_substitutions_and_errors(spark):
    rng = random.Random(3)
    seq = "".join(rng.choice("ACGT") for _ in range(2000))
    for rate in (0.001, 0.05, 1.0):
        out = sampling.substituted(seq, rate, 9)
        assert sum(a != b for a, b in zip(seq, out, strict=True)) == round(2000 * rate) and set(out) <= set("ACGT")
    assert sampling.substituted("NNNé", 1.0, 1) == "NNNé" and sampling.substituted("", 0.5, 1) == "" and sampling.substituted("acgt", 1.0, 1).islower()
    df = spark.createDataFrame([("a", seq), ("n", None)], "id string, seq string")
    got = {r.id: r.s for r in df.select("id", sampling.substitute("seq", 0.01, 4, F.col("id")).alias("s")).collect()}
    assert got["n"] is None and sum(a != b for a, b in zip(seq, got["a"], strict=True)) == 20
    reads = spark.createDataFrame([("r", seq), ("n", None)], "read_id string, seq string")
    assert {r.read_id: r.seq for r in sampling.noisy_reads(reads, sampling.ErrorModel(0, 0, 0)).collect()} == {"r": seq, "n": ""}
    # measured rates: deletions and insertions in runs are boosted alike, substitutions aren't
    single, runs = "ACGT" * 50_000, "A" * 200_000
    share = lambda text, **kw: len(sampling.with_errors(text, sampling.ErrorModel(**{"substitution": 0.0, "insertion": 0.0, "deletion": 0.0} | kw), 5)) / len(text) - 1
    for kind, sign in (("insertion", 1), ("deletion", -1)):
        assert abs(share(single, **{kind: 0.02}) - sign * 0.02) < 0.002 and abs(share(runs, **{kind: 0.02}) - sign * 0.04) < 0.003
    changed = sampling.with_errors(single, sampling.ErrorModel(0.01, 0.0, 0.0), 5)
    assert abs(sum(a != b for a, b in zip(single, changed, strict=True)) / len(single) - 0.01) < 0.001


def test_outcomes_and_scores(spark):
    lin = ["S1", "G1", "F1", "SK"]
    cases = [(None, None, "abstain"), ("F1", "family", "correct"), ("SK", "superkingdom", "too_shallow"), ("G1", "genus", "over_commit"), ("S1", "species", "over_commit"), ("GX", "genus", "over_commit"), ("FX", "family", "misroute"), ("OX", "order", "misroute")]
    rows = [(f"r{i}", lin, "F1", "family", "bin" if i % 2 else None, p, r) for i, (p, r, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "read_id string, lineage array<string>, expected_commit_taxid string, expected_commit_rank string, distance_bin string, p string, r string")
    got = [r[0] for r in df.orderBy("read_id").select(openset.outcome("lineage", "expected_commit_taxid", "expected_commit_rank", "p", "r")).collect()]
    assert got == [c[2] for c in cases]
    perfect = df.select("read_id", F.col("expected_commit_taxid").alias("predicted_taxid"), F.col("expected_commit_rank").alias("predicted_rank"))
    assert all(r.correct_rate == 1.0 for r in openset.score(df, perfect).collect())
    deep = df.select("read_id", F.lit("S1").alias("predicted_taxid"), F.lit("species").alias("predicted_rank"))
    assert all(r.over_commit_rate == 1.0 for r in openset.score(df, deep).collect())
    m = openset.hierarchical_prf(df, deep).first()
    assert (m.precision, m.recall, m.n_reads) == (1.0, 1.0, 8)
    with pytest.raises(Exception, match="no lineage"):
        openset.hierarchical_prf(df.withColumn("lineage", F.lit(None).cast("array<string>")), deep).collect()


def test_holdout(spark):
    nodes = spark.createDataFrame([("r", None, 0, "root"), ("a", "r", 1, "family"), ("b", "r", 1, "family"), ("a1", "a", 2, "genus"), ("a2", "a", 2, "genus"), ("a3", "a", 2, "genus"), ("b1", "b", 2, "genus")], "node_id string, parent_id string, depth int, rank string")
    leaves = spark.createDataFrame([("a1", 1), ("a2", 1), ("a3", 1), ("b1", 1), ("a", 3), ("b", 1), ("r", 4)], "node_id string, n_leaves bigint")
    clo = spark.createDataFrame([(x, a, i) for x, p in {"a1": "a1 a r", "a2": "a2 a r", "a3": "a3 a r", "b1": "b1 b r", "a": "a r", "b": "b r", "r": "r"}.items() for i, a in enumerate(p.split())], "node_id string, ancestor string, distance int")
    ok = openset.eligible(nodes, leaves)
    assert {r.node_id for r in ok.collect()} == {"a", "b", "a1", "a2", "a3"}
    assert {r.node_id for r in openset.select_holdout(ok, clo, rank="genus", fraction=1.0).collect()} < {"a1", "a2", "a3"}
    assert {r.node_id for r in openset.select_holdout(ok, clo, explicit=["a", "a1", "b1"]).collect()} == {"a"}
    assert openset.select_holdout(ok, clo).count() == 0
    held = spark.createDataFrame([("a1",), ("a",)], "node_id string")
    assert {r.node_id: r.rho for r in openset.retained_ancestor(held, clo).collect()} == {"a1": "r", "a": "r"}


def test_audit(spark):
    c = spark.createDataFrame([("h", 0, 0.4, False), ("h", 1, 0.5, False), ("h", 2, 0.8, True), ("k", 0, 0.4, False), ("k", 1, 0.42, True), ("z", 0, 0.4, True)], "head string, class_idx int, gc_mean double, is_virtual boolean")
    assert {(r["head"], r.class_idx) for r in audit.audit(c).where("flagged").collect()} == {("h", 2)}
    n = spark.createDataFrame([("h", 0, "1", "x"), ("h", 1, "2", "x"), ("h", 2, "2", "x"), ("h", 3, "4", None)], "head string, class_idx int, taxid string, name string")
    assert [r.label for r in audit.unique_names(n).orderBy("class_idx").collect()] == ["x", "x (2)", "x (2) #2", None]
    f = audit.kmer_features(spark.createDataFrame([("AACN",), ("",), (None,)], "s string"), "s", 2).collect()
    assert f[0].features[0] == 0.5 and f[0].features[1] == 0.5 and sum(f[1].features) == 0 and sum(f[2].features) == 0
    r = spark.createDataFrame([([0.5, 0.9], 0.9, True, None), ([0.9, 0.9], 0.5, None, None), ([0.9, 0.9], 0.9, False, None), (None, None, None, "low"), (None, None, None, None)], "v array<double>, t double, l boolean, f string")
    assert [x[0].verdict for x in r.select(audit.reliability("v", "t", "l", "f")).collect()] == ["noisy-metrics", "noisy-metrics", "unreliable", "noisy-metrics", "reliable"]


def test_separability_finds_what_is_separable(spark):
    rng = random.Random(2)
    mk = lambda n: spark.createDataFrame([("".join(rng.choice("AACGT" if c else "ACGTT") for _ in range(150)), c) for c in (0, 1) for _ in range(n)], "seq string, class_idx int")
    out = audit.separability(mk(60), mk(30), k=2)
    assert out["test_accuracy"] > 0.85 and out["chance_accuracy"] == 0.5
    assert audit.separability(mk(5).where("class_idx = 0"), mk(5))["test_accuracy"] is None


def test_selection(spark):
    a = spark.createDataFrame([("a", "t", True, 10, False, False, 0), ("b", "t", False, 99, None, None, None), ("c", "t", False, 50, False, False, 3), ("d", "t", False, 40, True, False, 0), ("e", None, False, 5, False, True, 0)], "accession string, taxid string, is_reference boolean, length bigint, downloaded boolean, download_deferred boolean, download_attempts int")
    assert {r.accession for r in selection.pending(a).collect()} == {"a", "b"}
    got = selection.select_until(a.withColumn("need", F.lit(11)), "taxid", "need").where("taxid = 't'").collect()
    assert {r.accession for r in got} == {"a", "b"}
    lin = lineage(spark, [("t", "species", "T"), ("g", "genus", "G")])
    assert {r.label: r.capacity for r in selection.size_proxy(a, lin).collect()} == {"t": 199, "g": 199}
    d = {r.accession: r.download_deferred for r in selection.defer(a, spark.createDataFrame([("a",)], "accession string")).collect()}
    assert d == {"a": False, "b": True, "c": True, "d": False, "e": True}


def test_map_groups_with_nulls_ties_and_none(spark):
    from sylva.operators.by_group import map_groups

    rows = [(k, i % 5, f"n{i}") for i in range(100) for k in (None, "a", f"k{i % 30}")]
    df = spark.createDataFrame(rows, "k string, v int, name string").withColumn("extra", F.lit(1))
    out = map_groups(df.repartition(7), ["k"], [F.desc("v"), "name"], ["v", "name"], lambda v, n: [sum(v)] * len(n), "total", "bigint")
    want = {}
    for k, v, _ in rows:
        want[k] = want.get(k, 0) + v
    got = out.collect()
    assert len(got) == len(rows) and all(r.total == want[r.k] for r in got)
    assert map_groups(df.limit(0), ["k"], ["v"], ["v"], lambda v: v, "x", "bigint").count() == 0
