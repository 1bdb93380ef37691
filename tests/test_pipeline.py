"""End to end on a synthetic catalogue: contracts of the datasets, the open-set loop, the command line."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sylva import cli
from sylva.operators import hierarchy, negatives, openset
from sylva.operators.bucketing import BalanceParams
from sylva.plans import pipeline


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    rng = random.Random(11)
    acc, lin, seq = [], [], []
    for f in range(3):
        for g in range(2):
            for s in range(3):
                t = f"{f}{g}{s}1"
                lin.append((t, [(t, "species", f"s{t}"), (f"{f}{g}", "genus", f"g{f}{g}"), (f"{f}", "family", f"f{f}"), ("9", "superkingdom", "D")]))
                for a in range(2):
                    h = f"H{t}{a}"
                    acc.append((f"A{t}{a}", t, [(h, "n")], True))
                    seq.append((h, "".join(rng.choice("ACGT") for _ in range(900))))
    folder = tmp_path_factory.mktemp("cat")
    spark.createDataFrame(acc, "accession string, taxid string, headers array<struct<id: string, name: string>>, downloaded boolean").write.parquet(f"{folder}/accession")
    spark.createDataFrame(lin, "taxid string, path array<struct<taxid: string, rank: string, name: string>>").write.parquet(f"{folder}/lineage")
    spark.createDataFrame(seq, "header_id string, seq string").write.parquet(f"{folder}/sequence")
    return str(folder)


PARAMS = dict(domain="9", min_len=20, max_len=40, balance=BalanceParams(min_leaves=1, min_num_seqs=10, max_n_per_class=30), reject=negatives.RejectParams(), seed=3)


def test_generate(spark, catalogue):
    tables = pipeline.catalogue_tables(spark, catalogue)
    out = pipeline.generate(*tables, pipeline.GenerateParams(**PARAMS))
    cls = {(r["head"], r["child"]): r for r in out.classes.collect()}
    assert {h for h, _ in cls} == {"9", "0", "1", "2", *[f"{f}{g}" for f in range(3) for g in range(2)]}
    assert all(r.n_per_class == 30 for r in cls.values() if r["rank"] != "virtual_reject")
    per = out.tasks.groupBy("head", "child").agg(F.sum("n").alias("n")).collect()
    assert all(r.n == 30 for r in per)
    straddle = out.tasks.where("start_pct = 0 and end_pct = 1").groupBy("head", "child", "genome_key").agg(F.count_distinct("split").alias("s")).where("s > 1").count()
    assert straddle == 0
    s = out.samples.cache()
    seqs = {r.header_id: r.seq for r in tables[2].collect()}
    rc = str.maketrans("ACGT", "TGCA")
    for r in s.limit(300).collect():
        assert 20 <= len(r.seq) <= 40 and (r.seq in seqs[r.header_id] or r.seq[::-1].translate(rc) in seqs[r.header_id])
    assert {r.split for r in s.select("split").distinct().collect()} == {"train", "val", "test"}
    maps = {r["head"]: r for r in out.label_maps.collect()}
    assert all(len(m.id2label) == len(m.label2id) == len(m.classes) for m in maps.values())
    reject = s.join(out.classes.where("rank = 'virtual_reject'").select("head", "class_idx"), ["head", "class_idx"])
    inside = reject.join(out.tree.closure.select(F.col("ancestor").alias("head"), F.col("leaf").alias("header_id")), ["head", "header_id"], "left_semi").count()
    assert reject.count() > 0 and inside == 0
    again = pipeline.generate(*tables, pipeline.GenerateParams(**PARAMS)).samples
    assert again.exceptAll(s).count() == 0 and again.count() == s.count()


def test_stop_at_single_level_and_binary(spark, catalogue):
    tables = pipeline.catalogue_tables(spark, catalogue)
    base = {k: v for k, v in PARAMS.items() if k != "reject"}
    heads = lambda **kw: {r["head"] for r in pipeline.generate(*tables, pipeline.GenerateParams(**base, **kw)).classes.select("head").distinct().collect()}
    assert heads(stop_at="family") == {"9", "0", "1", "2"}
    assert heads(single_level="01") == {"01"}
    with pytest.raises(ValueError):
        pipeline.GenerateParams(stop_at="genus", single_level="1")
    b = pipeline.generate(*tables, pipeline.GenerateParams(**base, binary_budget=20), binary=True)
    n = {(r["head"], r.class_idx): r.n for r in b.tasks.groupBy("head", "class_idx").agg(F.sum("n").alias("n")).collect()}
    assert n and all(n[h, 0] == n[h, 1] == 20 for h, _ in n) and "9" not in {h for h, _ in n}


def test_open_set_loop_and_command_line(spark, catalogue, tmp_path):
    out = f"{tmp_path}/ds"
    cli.main(["generate", catalogue, out, "--domain", "9", "--min-len", "20", "--max-len", "40", "--min-leaves", "1", "--min-num-seqs", "10", "--max-n-per-class", "30", "--holdout-rank", "genus", "--holdout-fraction", "0.3", "--cluster-aware", "--dereplicate", "0.9", "--mutation-rate", "0.01"])
    m = spark.read.json(f"{out}/manifest")
    held = {r.taxid for r in m.collect()}
    assert 0 < len(held) <= 2
    assert all(r.expected_commit_taxid == r.taxid[0] for r in m.collect())
    used = {r.header_id[1:3] for r in spark.read.parquet(f"{catalogue}/sequence").join(spark.read.parquet(f"{out}/samples").select("head").distinct(), F.lit(True)).select("header_id").distinct().collect()}
    assert used
    heads = {str(r["head"]) for r in spark.read.parquet(f"{out}/samples").select("head").distinct().collect()}
    assert not heads & held
    cli.main(["benchmark", "build-eval", catalogue, f"{out}/manifest", f"{tmp_path}/eval", "--read-length", "50", "--per-genome", "2"])
    reads = spark.read.parquet(f"{tmp_path}/eval")
    assert reads.count() == 2 * sum(r.n_genomes for r in m.collect())
    reads.select("read_id", F.col("expected_commit_taxid").alias("predicted_taxid"), F.col("expected_commit_rank").alias("predicted_rank")).write.parquet(f"{tmp_path}/pred")
    cli.main(["benchmark", "score", f"{tmp_path}/eval", f"{tmp_path}/pred", f"{tmp_path}/score"])
    assert {r.correct_rate for r in spark.read.option("header", True).csv(f"{tmp_path}/score").collect()} == {"1.0"}
    cli.main(["benchmark", "export-refs", catalogue, f"{out}/manifest", f"{tmp_path}/refs"])
    kept = spark.read.option("wholetext", True).text(f"{tmp_path}/refs").collect()
    assert sum(r.value.count(">") for r in kept) == 36 - sum(r.n_genomes for r in m.collect())
    cli.main(["composition", out, f"{tmp_path}/comp"])
    assert spark.read.json(f"{tmp_path}/comp").count() > 0
    (tmp_path / "k.txt").write_text("C\tr1\t01\nU\tr2\t0\n")
    cli.main(["benchmark", "parse-baseline", "kraken2", catalogue, f"{tmp_path}/k.txt", f"{tmp_path}/parsed"])
    assert {(r.read_id, r.predicted_rank) for r in spark.read.parquet(f"{tmp_path}/parsed").collect()} == {("r1", "genus"), ("r2", None)}
    (tmp_path / "t.json").write_text('{"head": "9", "val_f1s": [0.5, 0.9], "test_f1": 0.9, "learned": true}\n')
    cli.main(["benchmark", "reliability", out, f"{tmp_path}/t.json", f"{tmp_path}/rel"])
    assert {r["head"]: r.verdict for r in spark.read.json(f"{tmp_path}/rel").collect()}["9"] == "noisy-metrics"
    _ = openset


def test_forest_and_other_domains(spark, catalogue):
    acc, lin, seq = pipeline.catalogue_tables(spark, catalogue)
    rng = random.Random(5)
    other = [("X1", "777", [("HX1", "n")], True, True), ("X2", "778", [("HX2", "n")], False, True)]  # the second isn't downloaded
    acc = acc.withColumn("cross_domain", F.lit(False)).unionByName(spark.createDataFrame(other, "accession string, taxid string, headers array<struct<id: string, name: string>>, downloaded boolean, cross_domain boolean"))
    seq = seq.unionByName(spark.createDataFrame([(h, "".join(rng.choice("ACGT") for _ in range(900))) for h in ("HX1", "HX2")], "header_id string, seq string"))
    p = {**PARAMS, "domain": "0, 1", "reject": negatives.RejectParams(cross_domain_max_depth=1), "scopes": (hierarchy.Scope("0", {"00": "V0"}, None, {"V0": "routed"}),)}
    out = pipeline.generate(acc, lin, seq, pipeline.GenerateParams(**p))
    nodes = {r.node_id: r.parent_id for r in out.tree.nodes.collect()}
    assert nodes["0"] == nodes["1"] == "root" and "2" not in nodes and "9" not in nodes and nodes["00"] == "V0"
    heads = {r["head"] for r in out.classes.select("head").distinct().collect()}
    assert {"root", "0", "1"} <= heads
    reject = out.tasks.join(out.classes.where("rank = 'virtual_reject'").select("head", "class_idx"), ["head", "class_idx"])
    by = {}
    for r in reject.select("head", "header_id").distinct().collect():
        by.setdefault(r["head"], set()).add(r.header_id)
    assert by["root"] == {"HX1"} and all("HX1" not in v for h, v in by.items() if h != "root")
