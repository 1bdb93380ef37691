"""Audits of datasets: composition, separability, reliability, label maps, run statistics."""

from __future__ import annotations

import json
import platform
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva import __version__
from sylva.functions.ids import hash_order
from sylva.functions.sequence import gc_fraction

Z_FLAG, GAP_FLAG = 2.0, 0.05


def composition(samples: DataFrame, groups: tuple[str, ...] = ("head", "class_idx")) -> DataFrame:
    """Per class: rows, mean and population deviation of length and GC, share of each base of all letters. Null sequences count as empty."""
    s = F.upper(F.coalesce("seq", F.lit("")))
    n = samples.select(*groups, s.alias("s"))
    gc, length = gc_fraction("s"), F.length("s")
    shares = [(F.sum(F.regexp_count("s", F.lit(b))) / F.when(F.sum(length) > 0, F.sum(length))).alias(f"share_{b.lower()}") for b in "ACGT"]
    return n.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(length).alias("len_mean"), F.stddev_pop(length).alias("len_std"), F.coalesce(F.avg(gc), F.lit(0.0)).alias("gc_mean"), F.coalesce(F.stddev_pop(gc), F.lit(0.0)).alias("gc_std"), *shares
    )


def audit(classes: DataFrame) -> DataFrame:
    """Adds ``gc_gap, gc_z, flagged`` to virtual classes: z against the canonical classes of the head if there are two with spread, else the gap."""
    canonical = F.when(~F.col("is_virtual"), F.col("gc_mean"))
    w = Window.partitionBy("head")
    c = classes.withColumn("__m", F.avg(canonical).over(w)).withColumn("__s", F.stddev_pop(canonical).over(w)).withColumn("__n", F.count(canonical).over(w))
    gap = F.when(F.col("is_virtual") & (F.col("__n") > 0), F.col("gc_mean") - F.col("__m"))
    z = F.when((F.col("__n") >= 2) & (F.col("__s") > 0), gap / F.col("__s"))
    flag = F.coalesce(F.when(z.isNotNull(), F.abs(z) > Z_FLAG).otherwise(F.abs(gap) > GAP_FLAG), F.lit(False))
    return c.withColumns({"gc_gap": gap, "gc_z": z, "flagged": flag}).drop("__m", "__s", "__n")


def survey(audited: DataFrame) -> DataFrame:
    """``head, n_classes, n_virtual, n_flagged``."""
    return audited.groupBy("head").agg(F.count(F.lit(1)).alias("n_classes"), F.count_if("is_virtual").alias("n_virtual"), F.count_if("flagged").alias("n_flagged"))


def kmer_features(samples: DataFrame, seq: str, k: int) -> DataFrame:
    """Adds ``features``: shares of all 4^k k-mers in alphabetic order (k at most 6), zeros for sequences without any."""
    if not 1 <= k <= 6:
        raise ValueError("k must be from 1 to 6")

    @F.pandas_udf("array<double>")
    def shares(seqs: pd.Series) -> pd.Series:
        digit = np.full(256, -1, np.int64)
        digit[[65, 67, 71, 84]] = range(4)  # A, C, G, T
        out = []
        for s in seqs:
            d = digit[np.frombuffer((s or "").upper().encode("ascii", "replace"), np.uint8)]
            n = len(d) - k + 1
            if n < 1:
                out.append(np.zeros(4**k))
                continue
            code, pure = np.zeros(n, np.int64), np.ones(n, bool)
            for i in range(k):
                code = code * 4 + d[i : i + n]
                pure &= d[i : i + n] >= 0
            counts = np.bincount(code[pure], minlength=4**k)
            out.append(counts / max(1, int(pure.sum())))
        return pd.Series(out)

    return samples.withColumn("features", shares(F.col(seq)))


def separability(train: DataFrame, test: DataFrame, k: int = 3, per_class: int = 2000, seed: int = 42) -> dict:
    """k-mer logistic regression of one head: accuracy, macro F1, chance, lift; None where training has fewer than two classes.

    The model is fitted on at most ``per_class`` rows of each class, taken in hash order: a documented bound of the fit. All test rows are scored.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    w = Window.partitionBy("class_idx").orderBy(hash_order(seed, "seq"), "seq")
    fit = train.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= per_class)
    prep = lambda d: kmer_features(d, "seq", k).select(array_to_vector(F.col("features").cast("array<double>")).alias("features"), F.col("class_idx").cast("double").alias("label"))
    fit, n_test = prep(fit).cache(), test.count()
    n_train, n_classes = fit.count(), fit.select("label").distinct().count()
    out = {"k": k, "classifier": "logistic_regression", "n_train_sampled": n_train, "n_test": n_test, "test_accuracy": None, "test_f1_macro": None, "chance_accuracy": None, "accuracy_lift": None}
    if n_classes < 2 or not n_test:
        fit.unpersist()
        return out
    scored = LogisticRegression(maxIter=100, regParam=1e-4).fit(fit).transform(prep(test)).select("label", "prediction")
    fit.unpersist()
    hits = scored.groupBy("label", "prediction").count().collect()  # at most classes squared
    total = sum(r["count"] for r in hits)
    labels = {r["label"] for r in hits} | {r["prediction"] for r in hits}
    f1 = []
    for c in labels:
        tp = sum(r["count"] for r in hits if r["label"] == c and r["prediction"] == c)
        wrong = sum(r["count"] for r in hits if (r["label"] == c) != (r["prediction"] == c))
        f1.append(2 * tp / (2 * tp + wrong) if tp else 0.0)
    accuracy = sum(r["count"] for r in hits if r["label"] == r["prediction"]) / total
    return out | {"test_accuracy": round(accuracy, 4), "test_f1_macro": round(sum(f1) / len(f1), 4), "chance_accuracy": round(1 / n_classes, 4), "accuracy_lift": round(accuracy - 1 / n_classes, 4)}


def head_reliability(assigned: DataFrame, min_genomes: int = 4) -> DataFrame:
    """``head, n_train, n_val, n_test, a_priori_flag``: distinct genomes by split; low below ``min_genomes`` in val or test."""
    n = lambda s: F.count_distinct(F.when(F.col("split") == s, F.col("genome_key")))
    g = assigned.groupBy("head").agg(n("train").alias("n_train"), n("val").alias("n_val"), n("test").alias("n_test"))
    return g.withColumn("a_priori_flag", F.when(F.least("n_val", "n_test") < min_genomes, "low").otherwise("ok"))


def reliability(val_f1s: Column | str, test_f1: Column | str, learned: Column | str, a_priori_flag: Column | str, *, unstable: float = 0.08, gap: float = 0.10) -> Column:
    """``STRUCT<val_f1_std, val_test_gap, verdict, source>``: from the training's scores if there are any, else from the flag."""
    v, t, ok, flag = (F.col(x) if isinstance(x, str) else x for x in (val_f1s, test_f1, learned, a_priori_flag))
    n = F.coalesce(F.size(v), F.lit(0))
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
    spread = F.when(n >= 2, F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n), 4)).otherwise(0.0)
    d = F.when(n > 0, F.round(F.abs(t - F.element_at(v, -1)), 4))
    trained = (n > 0) | t.isNotNull() | ok.isNotNull()
    noisy = (spread > unstable) | F.coalesce(d > gap, F.lit(False))
    verdict = F.when(trained & F.coalesce(~ok, F.lit(False)), "unreliable").when(trained & noisy, "noisy-metrics").when(trained, "reliable").when(flag == "low", "noisy-metrics").otherwise("reliable")
    return F.struct(spread.alias("val_f1_std"), d.alias("val_test_gap"), verdict.alias("verdict"), F.when(trained, "training").otherwise("a_priori").alias("source"))


def class_weights(classes: DataFrame, n: str = "n_windows") -> DataFrame:
    """Adds ``weight``: total / (classes x n), 4 decimals; null for empty classes."""
    w = Window.partitionBy("head")
    return classes.withColumn("weight", F.when(F.col(n) > 0, F.round(F.sum(n).over(w) / (F.count(F.lit(1)).over(w) * F.col(n)), 4)))


def unique_names(classes: DataFrame) -> DataFrame:
    """Adds ``label``: the class's name, the second and later classes of a name with their taxid behind it, and those that repeat even that with their index."""
    w = Window.partitionBy("head", "name").orderBy("class_idx", "taxid")
    again = Window.partitionBy("head", "name", "taxid").orderBy("class_idx")
    longer = F.concat("name", F.lit(" ("), "taxid", F.lit(")"), F.when(F.row_number().over(again) > 1, F.concat(F.lit(" #"), F.col("class_idx").cast("string"))).otherwise(""))
    return classes.withColumn("label", F.when(F.row_number().over(w) > 1, longer).otherwise(F.col("name")))


def label_maps(classes: DataFrame) -> DataFrame:
    """One row per head: ``id2label``, ``label2id`` and ``classes`` in the order of class_idx."""
    c = F.array_sort(F.collect_list(F.struct("class_idx", "taxid", "label", "rank", "n_windows")))
    m = unique_names(classes).groupBy("head").agg(c.alias("classes"))
    return m.select("head", "classes", F.map_from_entries(F.transform("classes", lambda x: F.struct(x["class_idx"].cast("string"), x["label"]))).alias("id2label"), F.map_from_entries(F.transform("classes", lambda x: F.struct(x["label"], x["class_idx"]))).alias("label2id"))


def class_indices(children: DataFrame) -> DataFrame:
    """Adds ``class_idx``: place among the head's retained children by ``ord``, from 0; gaps stay where a child later turns out to have no tasks."""
    return children.withColumn("class_idx", F.row_number().over(Window.partitionBy("head").orderBy("ord", "child")) - 1)


def run_statistics(heads: DataFrame) -> DataFrame:
    """Per rank: ``n_heads, n_classes``, median n_per_class, median of the positive capacities cut to a whole number."""
    return heads.groupBy("rank").agg(
        F.count_distinct("head").alias("n_heads"), F.count(F.lit(1)).alias("n_classes"), F.median("n_per_class").alias("median_n_per_class"), F.floor(F.median(F.when(F.col("capacity") > 0, F.col("capacity")))).cast("bigint").alias("median_capacity")
    )


def accession_snapshot(accessions: DataFrame) -> DataFrame:
    """``n_accessions, digest``: sha256 of the sorted distinct accessions, a line each.

    The digest is defined over one text, so its last step is one task; for catalogues beyond that, ``incremental.fingerprints`` has no such step.
    """
    ids = accessions.where("accession is not null").select("accession").distinct()
    a = ids.agg(F.array_sort(F.collect_list("accession")).alias("a"))
    return a.select(F.size("a").cast("bigint").alias("n_accessions"), F.sha2(F.array_join("a", "\n").cast("binary"), 256).alias("digest"))


def enrich(label_maps: DataFrame, report: DataFrame, name: str) -> DataFrame:
    """Label maps with a head's row of ``report`` as the column ``name``, replacing an older one; heads without a report keep what they have."""
    new = report.select("head", F.struct(*[c for c in report.columns if c != "head"]).alias("__new"))
    j = label_maps.join(new, "head", "left")
    old = F.col(name).cast(new.schema["__new"].dataType) if name in label_maps.columns else F.lit(None).cast(new.schema["__new"].dataType)
    return j.withColumn(name, F.coalesce("__new", old)).drop("__new")


def composition_summary(audited: DataFrame) -> DataFrame:
    """Per head: ``n_classes, n_virtual, n_flagged, flagged`` (class indices), and the mean and deviation of GC over its canonical classes."""
    gc = F.when(~F.col("is_virtual"), F.col("gc_mean"))
    return audited.groupBy("head").agg(
        F.count(F.lit(1)).alias("n_classes"), F.count_if("is_virtual").alias("n_virtual"), F.count_if("flagged").alias("n_flagged"), F.array_sort(F.collect_list(F.when(F.col("flagged"), F.col("class_idx")))).alias("flagged"),
        F.avg(gc).alias("canonical_gc_mean"), F.stddev_pop(gc).alias("canonical_gc_std"),
    )


def run_metadata(spark: SparkSession, parameters: Mapping[str, object]) -> DataFrame:
    """One row: versions of what the run used and its parameters as JSON."""
    versions = {"python": platform.python_version(), "spark": spark.version, "pandas": pd.__version__, "numpy": np.__version__, "package": __version__}
    return spark.createDataFrame([(versions, json.dumps(parameters, default=str, sort_keys=True))], "versions map<string, string>, parameters string")


def merge_manifests(existing: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """All keys of both; a produced row replaces the existing one as a whole."""
    kept = existing.join(produced.select(key), key, "left_anti")
    return kept.unionByName(produced, allowMissingColumns=True)
