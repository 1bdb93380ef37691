"""Command line: discover, generate, separability, composition, benchmark {build-eval, score, export-refs, parse-baseline, reliability}.

A catalogue is a folder of Parquet tables ``accession``, ``lineage``, ``sequence``. The session comes from the environment (spark-submit) or is local.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva import tables
from sylva.operators import audit, bucketing, hierarchy, negatives, openset
from sylva.plans import pipeline
from sylva.sources import predictions, registry, release, sequences


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("sylva")
    sub = p.add_subparsers(dest="verb", required=True)
    d = sub.add_parser("discover", help="add the accessions of report files or of a flat-file release to a catalogue")
    d.add_argument("catalogue")
    d.add_argument("--reports", help="folder of summary reports, a JSON object a line")
    d.add_argument("--release", help="folder of flat files (.gbff, .gbff.gz)")
    g = sub.add_parser("generate", help="datasets of all heads")
    g.add_argument("catalogue")
    g.add_argument("output")
    for name, kind, default in (("min-len", int, 100), ("max-len", int, 2000), ("max-n-per-class", int, 20000), ("min-num-seqs", int, 1000), ("cutoff", float, 98.0), ("min-leaves", int, 3), ("min-subclades", int, 5), ("mutation-rate", float, 0.0), ("holdout-fraction", float, 0.0), ("binary-budget", int, 20000), ("seed", int, 42)):
        g.add_argument(f"--{name}", type=kind, default=default)
    g.add_argument("--domain", help="taxids, shortcuts or names, with commas between; all for the whole catalogue")
    g.add_argument("--reject-cross-domain-depth", type=int, default=0, help="heads up to this depth also reject accessions marked cross_domain")
    g.add_argument("--noise")
    g.add_argument("--mapping")
    g.add_argument("--stop-at")
    g.add_argument("--single-level")
    g.add_argument("--holdout-clades", default="")
    g.add_argument("--holdout-rank")
    g.add_argument("--dereplicate", type=float)
    g.add_argument("--rare-taxa", choices=("fallback", "keep"), default="fallback")
    g.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    for name in ("all-ranks", "approximate-capacity", "keep-imbalance", "cluster-aware", "binary-only"):
        g.add_argument(f"--{name}", action="store_true")
    g.add_argument("--reject-fraction", type=float, help="adds a reject class of this share of n_per_class")
    g.add_argument("--reject-depth-span", type=int, default=5)
    for verb in ("separability", "composition"):
        s = sub.add_parser(verb, help=f"{verb} of the heads of a dataset")
        s.add_argument("dataset")
        s.add_argument("report")
        s.add_argument("--split", default="train")
        s.add_argument("-k", type=int, default=3)
    b = sub.add_parser("benchmark").add_subparsers(dest="task", required=True)
    x = b.add_parser("build-eval")
    x.add_argument("catalogue")
    x.add_argument("manifest")
    x.add_argument("output")
    x.add_argument("--read-length", type=int, default=150)
    x.add_argument("--per-genome", type=int, default=10)
    x.add_argument("--track", choices=("short", "long"), default="short")
    x = b.add_parser("score")
    x.add_argument("reads")
    x.add_argument("predictions")
    x.add_argument("report")
    x = b.add_parser("export-refs")
    x.add_argument("catalogue")
    x.add_argument("manifest")
    x.add_argument("output")
    x = b.add_parser("parse-baseline")
    x.add_argument("kind", choices=("kraken2", "kaiju", "centrifuge"))
    x.add_argument("catalogue")
    x.add_argument("lines")
    x.add_argument("output")
    x = b.add_parser("reliability")
    x.add_argument("dataset")
    x.add_argument("training", help="JSON lines: head, val_f1s, test_f1, learned")
    x.add_argument("report")
    return p


def _generate(spark: SparkSession, a: argparse.Namespace) -> None:
    acc, lin, seq = pipeline.catalogue_tables(spark, a.catalogue)
    mapping = registry.read_json_config(a.mapping, optional=True) if a.mapping else {}
    names = lin.select(F.explode("path").alias("x")).select("x.taxid", "x.name")
    roots = [hierarchy.resolve_root(x, names) for x in a.domain.split(",") if x.strip()] if a.domain else [None]
    if None in roots and len(roots) > 1:
        raise SystemExit("all excludes other domains")
    p = pipeline.GenerateParams(
        domain=None if roots == [None] else ",".join(roots), min_len=a.min_len, max_len=a.max_len, noise=registry.noise_rules(a.noise), scopes=tuple(registry.scope_of(mapping, x) for x in roots if x and mapping), all_ranks=a.all_ranks, approximate_capacity=a.approximate_capacity,
        balance=bucketing.BalanceParams(a.min_subclades, a.min_leaves, a.rare_taxa, a.min_num_seqs, a.cutoff, a.max_n_per_class), keep_imbalance=a.keep_imbalance, stop_at=a.stop_at, single_level=a.single_level, cluster_aware=a.cluster_aware, dereplicate=a.dereplicate,
        reject=negatives.RejectParams(a.seed, fraction=a.reject_fraction, depth_span=a.reject_depth_span, cross_domain_max_depth=a.reject_cross_domain_depth) if a.reject_fraction else None, mutation_rate=a.mutation_rate, holdout_clades=tuple(x for x in a.holdout_clades.split(",") if x),
        holdout_rank=a.holdout_rank, holdout_fraction=a.holdout_fraction, binary_budget=a.binary_budget, seed=a.seed,
    )
    out = pipeline.generate(acc, lin, seq, p, binary=a.binary_only)
    predictions.write_samples(out.samples, f"{a.output}/samples", a.format)
    for name, t in (("classes", out.classes), ("reliability", out.reliability), ("manifest", out.manifest), ("run_metadata", audit.run_metadata(spark, vars(a)))):
        if t is not None:
            t.write.mode("overwrite").json(f"{a.output}/{name}")
    if out.label_maps is not None:
        tables.write_table(out.label_maps, f"{a.output}/label_maps")
    if not a.binary_only:
        audit.run_statistics(out.classes.join(out.tree.nodes.select(F.col("node_id").alias("head"), F.col("rank").alias("head_rank")), "head", "left").drop("rank").withColumnRenamed("head_rank", "rank")).write.mode("overwrite").json(f"{a.output}/run_statistics")
        audit.accession_snapshot(acc).write.mode("overwrite").json(f"{a.output}/snapshot")


def _discover(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sequences are stored before the accessions that are marked downloaded because of them; known accessions are never overwritten."""
    found, path, stored = None, f"{a.catalogue}/accession", f"{a.catalogue}/sequence"
    if a.release:
        records = sequences.read_gbff(spark, a.release)
        found = release.report_rows(release.record_reports(records)).withColumn("downloaded", F.lit(True)).withColumn("headers", F.array(F.struct(F.col("accession").alias("id"), F.col("organism").alias("name"))))
        fresh = sequences.sequence_table(records.groupBy(F.col("accession").alias("header_id")).agg(F.max("sequence").alias("seq")))
        if tables.table_exists(spark, stored):  # other releases' sequences stay
            fresh = audit.merge_manifests(tables.read_table(spark, stored), fresh, "header_id")
        tables.write_table(fresh, stored)
    if a.reports:
        rows = release.report_rows(release.read_reports(spark, a.reports))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    if found is None:
        raise SystemExit("give --reports or --release")
    found = found.dropDuplicates(["accession"])
    if tables.table_exists(spark, path):
        found = registry.merge_new(tables.read_table(spark, path), found, "accession")
    tables.write_table(found, path)


def _enrich(spark: SparkSession, dataset: str, report: DataFrame, name: str) -> None:
    """The report becomes a column of the dataset's label maps, replaced in one step; datasets of binary heads have none."""
    path = f"{dataset}/label_maps"
    if tables.table_exists(spark, path):
        maps = tables.read_table(spark, path).withColumn("head", F.col("head").cast("string"))
        tables.write_table(audit.enrich(maps, report.withColumn("head", F.col("head").cast("string")), name), path)


def _benchmark(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.task == "build-eval":
        acc, lin, seq = pipeline.catalogue_tables(spark, a.catalogue)
        headers = acc.select("taxid", F.explode("headers").alias("h")).select(F.col("h.id").alias("header_id"), "taxid")
        reads = openset.eval_reads(spark.read.json(a.manifest), seq, lin, headers, read_length=a.read_length, per_genome=a.per_genome, track=a.track)
        if a.track == "long":
            from sylva.operators.sampling import ErrorModel, noisy_reads

            reads = reads.drop("seq").join(noisy_reads(reads, ErrorModel()), "read_id")
        reads.write.mode("overwrite").parquet(a.output)
    elif a.task == "score":
        reads = spark.read.parquet(a.reads).withColumn("lineage", openset.lineage_ids("true_lineage"))
        predictions.write_report(openset.score(reads, predictions.read_predictions(spark, a.predictions)), a.report)
    elif a.task == "export-refs":
        acc, lin, seq = pipeline.catalogue_tables(spark, a.catalogue)
        leaves = acc.select(F.col("taxid").alias("node_id"), F.explode("headers").alias("h")).select("node_id", F.col("h.id").alias("header_id"))
        closure = lin.select(F.col("taxid").alias("node_id"), F.explode("path").alias("x")).select("node_id", F.col("x.taxid").alias("ancestor"))
        kept = openset.retained_leaves(leaves, closure, spark.read.json(a.manifest).select(F.col("taxid").alias("node_id")))
        openset.reference_lines(kept, seq).write.mode("overwrite").text(a.output)
        openset.reference_map(kept, seq).write.mode("overwrite").text(f"{a.output}.map")
    elif a.task == "parse-baseline":
        ranks = openset.rank_map(tables.read_table(spark, f"{a.catalogue}/lineage"))
        lines = spark.read.text(a.lines).select("value", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("at"))
        parse = predictions.parse_scored_output if a.kind == "centrifuge" else predictions.parse_status_output
        parse(lines, ranks, "at").write.mode("overwrite").parquet(a.output)
    else:
        prior = spark.read.json(f"{a.dataset}/reliability").select("head", "a_priori_flag")
        t = spark.read.schema("head string, val_f1s array<double>, test_f1 double, learned boolean").json(a.training)
        predictions.write_report(prior.join(t, "head", "left").select("head", audit.reliability("val_f1s", "test_f1", "learned", "a_priori_flag").alias("r")).select("head", "r.*"), a.report, "json")


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("sylva").getOrCreate()
    if a.verb == "generate":
        _generate(spark, a)
    elif a.verb == "discover":
        _discover(spark, a)
    elif a.verb == "composition":
        s = spark.read.parquet(f"{a.dataset}/samples").where(F.col("split") == a.split)
        ranks = spark.read.json(f"{a.dataset}/classes").select(F.col("head").cast("string").alias("head"), "class_idx", F.col("rank").startswith("virtual_").alias("is_virtual"))
        c = audit.audit(audit.composition(s.withColumn("head", F.col("head").cast("string"))).join(ranks, ["head", "class_idx"]))
        predictions.write_report(c, a.report, "json")
        _enrich(spark, a.dataset, audit.composition_summary(c), "composition_audit")
    elif a.verb == "separability":
        s = spark.read.parquet(f"{a.dataset}/samples").withColumn("head", F.col("head").cast("string"))
        rows = []
        for h in [r["head"] for r in s.select("head").distinct().collect()]:  # a model per head; heads are few
            one = s.where(F.col("head") == h)
            train, test = one.where("split = 'train'"), one.where("split = 'test'")
            if train.limit(1).count() and test.limit(1).count():
                rows.append(json.dumps({"head": h} | audit.separability(train, test, a.k)))
        lines = spark.createDataFrame([(r,) for r in rows], "value string")
        lines.coalesce(1).write.mode("overwrite").text(a.report)
        report = lines.select(F.from_json("value", "head string, k int, classifier string, n_train_sampled bigint, n_test bigint, test_accuracy double, test_f1_macro double, chance_accuracy double, accuracy_lift double").alias("r")).select("r.*")
        _enrich(spark, a.dataset, report, "kmer_separability")
    else:
        _benchmark(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
