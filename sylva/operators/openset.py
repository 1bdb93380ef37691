"""Open-set evaluation: held-out clades, reads from them, scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.ids import hash_order
from sylva.functions.ranks import rank_depth
from sylva.operators.spread_rank import global_place

OUTCOMES = ("correct", "over_commit", "too_shallow", "misroute", "abstain")


def eligible(node_table: DataFrame, leaf_counts: DataFrame) -> DataFrame:
    """Nodes with at least one leaf whose parent has at least two children; ``leaf_counts(node_id, n_leaves)``."""
    siblings = node_table.where("parent_id is not null").groupBy("parent_id").agg(F.count(F.lit(1)).alias("n_siblings"))
    return node_table.join(siblings, "parent_id").where("n_siblings >= 2").join(leaf_counts.where("n_leaves > 0"), "node_id")


def select_holdout(eligible_nodes: DataFrame, closure: DataFrame, *, explicit: list[str] | None = None, rank: str | None = None, fraction: float = 0.0, seed: int = 0) -> DataFrame:
    """``node_id`` of held-out clades: the explicit ones that are eligible, or the first ceil(fraction x n) of a rank in hash order.

    By rank a parent keeps at least one child, so nothing empties it. A clade under another chosen one is dropped. ``closure(node_id, ancestor, distance)``.
    """
    if explicit:
        chosen = eligible_nodes.where(F.col("node_id").isin([str(x) for x in explicit])).select("node_id")
    elif rank:
        of = eligible_nodes.where(F.col("rank") == rank)
        order = hash_order(seed, "node_id")
        take = of.agg(F.ceil(F.count(F.lit(1)) * F.lit(fraction)).alias("take")).scalar()
        among = of.withColumn("__k", F.row_number().over(Window.partitionBy("parent_id").orderBy(order, "node_id"))).where("__k < n_siblings")
        chosen = global_place(among.withColumn("__h", order), "__h", "node_id").where(F.col("place") < take).select("node_id")
    else:
        chosen = eligible_nodes.limit(0).select("node_id")
    inner = closure.where("distance > 0").join(chosen, "node_id", "left_semi").join(chosen.select(F.col("node_id").alias("ancestor")), "ancestor", "left_semi").select("node_id").distinct()
    return chosen.join(inner, "node_id", "left_anti")


def retained_ancestor(held: DataFrame, closure: DataFrame) -> DataFrame:
    """``node_id, rho``: the nearest ancestor that isn't held out; nodes without one have no row."""
    up = closure.where("distance > 0").join(held, "node_id", "left_semi").join(held.select(F.col("node_id").alias("ancestor")), "ancestor", "left_anti")
    return up.groupBy("node_id").agg(F.min(F.struct("distance", "ancestor")).alias("m")).select("node_id", F.col("m.ancestor").alias("rho"))


def holdout_manifest(held: DataFrame, node_table: DataFrame, closure: DataFrame, leaves: DataFrame, relatives: DataFrame, seed: int = 0) -> DataFrame:
    """One row per held-out clade: members, expected commit, nearest retained sibling and its distance.

    ``leaves(header_id, node_id)``; ``relatives(query, nearest, jaccard, ani, bin)`` as from ``similarity.nearest``.
    """
    under = closure.join(held.select(F.col("node_id").alias("ancestor")), "ancestor", "left_semi").select(F.col("ancestor").alias("taxid"), "node_id")
    members = under.join(leaves, "node_id").groupBy("taxid").agg(F.count_distinct("header_id").alias("n_genomes"), F.array_sort(F.collect_set("header_id")).alias("member_headers"))
    names = node_table.select(F.col("node_id").alias("taxid"), "rank", F.col("sci_name").alias("name"))
    rho = retained_ancestor(held, closure).join(node_table.select(F.col("node_id").alias("rho"), F.col("rank").alias("rho_rank")), "rho", "left")
    out = held.select(F.col("node_id").alias("taxid")).join(names, "taxid", "left").join(members, "taxid", "left").join(rho.select(F.col("node_id").alias("taxid"), "rho", "rho_rank"), "taxid", "left")
    rel = relatives.select(F.col("query").alias("taxid"), F.col("nearest").alias("nearest_retained_sibling_taxid"), F.col("jaccard").alias("distance_jaccard"), F.col("ani").alias("distance_ani_proxy"), F.col("bin").alias("distance_bin"))
    return out.join(rel, "taxid", "left").withColumnsRenamed({"rho": "expected_commit_taxid", "rho_rank": "expected_commit_rank"}).withColumn("seed", F.lit(seed))


def retained_leaves(leaves: DataFrame, closure: DataFrame, held: DataFrame) -> DataFrame:
    """Leaves none of whose ancestors is held out."""
    out = closure.join(held.select(F.col("node_id").alias("ancestor")), "ancestor", "left_semi").select("node_id").distinct()
    return leaves.join(out, "node_id", "left_anti")


def reference_lines(leaves: DataFrame, sequences: DataFrame) -> DataFrame:
    """FASTA records ``>header|kraken:taxid|taxid`` of retained leaves, one text value each; leaves without a sequence are left out."""
    j = leaves.join(sequences, "header_id").where("seq <> ''")
    return j.select(F.concat(F.lit(">"), "header_id", F.lit("|kraken:taxid|"), "node_id", F.lit("\n"), "seq").alias("value"))


def reference_map(leaves: DataFrame, sequences: DataFrame) -> DataFrame:
    """The map beside the exported records: a line ``header<tab>taxid`` for each of them."""
    j = leaves.join(sequences.where("seq <> ''").select("header_id"), "header_id", "left_semi")
    return j.select(F.concat_ws("\t", "header_id", "node_id").alias("value"))


def outcome(lineage: Column | str, rho: Column | str, rho_rank: Column | str, pred: Column | str, pred_rank: Column | str) -> Column:
    """How a prediction relates to the expected commit: ``lineage`` is an array of taxids from leaf to root. Null or empty predictions abstain."""
    lineage, rho, rho_rank, pred, pred_rank = (F.col(x) if isinstance(x, str) else x for x in (lineage, rho, rho_rank, pred, pred_rank))
    up = F.reverse(lineage)
    at_p, at_r = F.array_position(up, pred), F.array_position(up, rho)
    deeper = F.coalesce(rank_depth(pred_rank) > rank_depth(rho_rank), F.lit(False))
    return (
        F.when(pred.isNull() | (pred == ""), "abstain")
        .when(F.coalesce(pred == rho, F.lit(False)), "correct")
        .when((at_p > 0) & (at_r > 0) & (at_p < at_r), "too_shallow")
        .when((at_p > 0) & (at_r > 0), "over_commit")
        .when(deeper, "over_commit")
        .otherwise("misroute")
    )


def score(reads: DataFrame, predictions: DataFrame) -> DataFrame:
    """``grp, key, n`` and for each outcome its count and rate: overall, by rank of the expected commit, by distance bin, in one pass.

    ``reads(read_id, lineage, expected_commit_taxid, expected_commit_rank, distance_bin)``; reads without a prediction abstain; a repeated
    prediction of a read must be resolved before (``sources.predictions``).
    """
    p = predictions.select("read_id", F.col("predicted_taxid").alias("__p"), F.col("predicted_rank").alias("__r"))
    j = reads.join(p, "read_id", "left").select(
        F.coalesce(F.when(F.col("expected_commit_rank") != "", F.col("expected_commit_rank")), F.lit("unknown")).alias("rank_key"),
        F.coalesce(F.when(F.col("distance_bin") != "", F.col("distance_bin")), F.lit("unknown")).alias("bin_key"),
        outcome("lineage", "expected_commit_taxid", "expected_commit_rank", "__p", "__r").alias("o"),
    )
    j.createOrReplaceTempView("__scored")
    counts = ", ".join(f"count_if(o = '{x}') AS {x}, round(count_if(o = '{x}') / count(*), 4) AS {x}_rate" for x in OUTCOMES)
    return j.sparkSession.sql(f"""
        SELECT CASE WHEN grouping(rank_key) = 0 THEN 'by_expected_commit_rank' WHEN grouping(bin_key) = 0 THEN 'by_distance_bin' ELSE 'overall' END AS grp,
               coalesce(rank_key, bin_key, '') AS key, count(*) AS n, {counts}
        FROM __scored GROUP BY GROUPING SETS ((), (rank_key), (bin_key))""")


def hierarchical_prf(reads: DataFrame, predictions: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: micro precision, recall and F over sets of ancestors, ``beta``, ``n_reads``. Raises for a read without a lineage.

    A predicted taxon's ancestors are read from the lineages of all reads: the shortest path up wins where they differ.
    """
    r = reads.select("read_id", F.when(F.coalesce(F.size("lineage"), F.lit(0)) > 0, F.col("lineage")).otherwise(F.raise_error(F.concat(F.lit("no lineage for read "), "read_id"))).alias("lineage"))
    up = r.select(F.posexplode("lineage").alias("i", "taxid"), "lineage").select("taxid", F.expr("slice(lineage, i + 1, size(lineage))").alias("anc")).groupBy("taxid").agg(F.min(F.struct(F.size("anc").alias("n"), "anc")).alias("m")).select("taxid", F.col("m.anc").alias("anc"))
    p = predictions.where("predicted_taxid <> ''").select("read_id", F.col("predicted_taxid").alias("taxid"))
    j = r.join(p, "read_id", "left").join(up, "taxid", "left")
    pred = F.when(F.col("taxid").isNull(), F.array().cast("array<string>")).otherwise(F.coalesce("anc", F.array("taxid")))
    truth = F.array_distinct("lineage")
    s = j.agg(F.sum(F.size(F.array_intersect(pred, truth))).alias("i"), F.sum(F.size(F.array_distinct(pred))).alias("p"), F.sum(F.size(truth)).alias("t"), F.count(F.lit(1)).alias("n"))
    precision, recall = F.when(F.col("p") > 0, F.col("i") / F.col("p")).otherwise(0.0), F.when(F.col("t") > 0, F.col("i") / F.col("t")).otherwise(0.0)
    b2 = beta * beta
    f = F.when(precision + recall > 0, (1 + b2) * precision * recall / (b2 * precision + recall)).otherwise(0.0)
    return s.select(precision.alias("precision"), recall.alias("recall"), f.alias("f_beta"), F.lit(beta).alias("beta"), F.col("n").alias("n_reads"))


def eval_reads(manifest: DataFrame, sequences: DataFrame, lineages: DataFrame, headers: DataFrame, *, read_length: int, per_genome: int, track: str = "short", seed: int = 42) -> DataFrame:
    """Reads of fixed length at hashed places of held-out genomes, with all columns an evaluation needs; the lineage is kept as JSON too.

    ``headers(header_id, taxid)``; members without a sequence at least that long, or without a lineage, give no reads.
    """
    m = manifest.select(F.col("taxid").alias("held_out_taxid"), "expected_commit_taxid", "expected_commit_rank", "distance_bin", F.explode("member_headers").alias("header_id"))
    j = m.join(headers, "header_id").join(sequences, "header_id").where(F.length("seq") >= read_length).join(lineages.where(F.size("path") > 0), "taxid")
    j = j.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(per_genome - 1))))
    start = F.pmod(F.xxhash64(F.lit(seed), "header_id", "i"), F.length("seq") - F.lit(read_length - 1)) + 1
    return j.select(
        F.concat_ws("_", F.lit(track), "header_id", F.col("i").cast("string")).alias("read_id"), F.substr("seq", start.cast("int"), F.lit(read_length)).alias("seq"), F.lit(read_length).alias("read_length"), F.lit(track).alias("track"),
        F.col("header_id").alias("source_header"), F.col("taxid").alias("true_leaf_taxid"), F.to_json(F.transform("path", lambda x: F.array(x["taxid"], x["rank"]))).alias("true_lineage"),
        "held_out_taxid", "expected_commit_taxid", "expected_commit_rank", "distance_bin",
    )


def lineage_ids(true_lineage: Column | str) -> Column:
    """Taxids, leaf to root, of a lineage kept as JSON."""
    return F.transform(F.from_json(true_lineage, "array<array<string>>"), lambda x: x[0])


def rank_map(lineages: DataFrame) -> DataFrame:
    """``taxid, rank`` of every node of the lineages; the greatest rank name wins where they differ."""
    return lineages.select(F.explode("path").alias("x")).where("x.taxid is not null").groupBy(F.col("x.taxid").alias("taxid")).agg(F.max("x.rank").alias("rank"))
