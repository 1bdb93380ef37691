"""Bucketing and balancing of the children of decision points, for all heads at once.

``children`` tables have ``head, child, rank, ord`` and what each step names; ``ord`` is the order in which ties resolve.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.ids import virtual_id
from sylva.functions.ranks import is_protected


@dataclass(frozen=True)
class BalanceParams:
    """Published defaults."""

    min_subclades: int = 5
    min_leaves: int = 3
    rare_strategy: str = "fallback"
    min_num_seqs: int = 1000
    cutoff_percentage: float = 98.0
    max_n_per_class: int = 20_000


def leaf_counts(children: DataFrame, closure: DataFrame) -> DataFrame:
    """``head, child, n_leaves``: distinct sequences under each child, by ``closure(leaf, ancestor)``; a child without any has 0."""
    n = closure.groupBy(F.col("ancestor").alias("child")).agg(F.count_distinct("leaf").alias("n_leaves"))
    return children.select("head", "child").join(n, "child", "left").select("head", "child", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"))


def modal_rank(children: DataFrame) -> DataFrame:
    """``head, canonical_rank``: the most frequent rank of unprotected children; the rank seen first wins ties. Heads with protected children only have no row."""
    counts = children.where(~is_protected("rank")).groupBy("head", F.coalesce("rank", F.lit("")).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    return counts.groupBy("head").agg(F.max(F.struct("n", (-F.col("first")).alias("o"), "r")).alias("b")).select("head", F.col("b.r").alias("canonical_rank"))


def rank_buckets(children: DataFrame, params: BalanceParams = BalanceParams(), all_ranks: bool = False) -> DataFrame:
    """Adds ``bucket_id, bucket_rank``: null where the child stays. Other ranks than the modal one get a bucket of their own
    if at least ``min_subclades`` children have it, else go to the head's misc bucket.
    """
    if all_ranks:
        return children.withColumns({"bucket_id": F.lit(None).cast("string"), "bucket_rank": F.lit(None).cast("string")})
    rank = F.coalesce("rank", F.lit(""))
    j = children.join(modal_rank(children), "head", "left")
    stays = is_protected("rank") | F.col("canonical_rank").isNull() | (rank == F.col("canonical_rank"))
    n = F.sum(F.when(stays, 0).otherwise(1)).over(Window.partitionBy("head", rank))
    purpose = F.when(stays, F.lit(None).cast("string")).when(n >= params.min_subclades, F.concat(F.lit("rank_"), rank)).otherwise("misc")
    out = j.withColumn("__p", purpose)
    name = F.when(F.col("__p") == "misc", "virtual_misc").otherwise(F.concat(F.lit("virtual_"), rank))
    return out.withColumn("bucket_id", F.when(F.col("__p").isNotNull(), virtual_id("head", "__p"))).withColumn("bucket_rank", F.when(F.col("__p").isNotNull(), name)).drop("__p", "canonical_rank")


def rare_partition(children: DataFrame, params: BalanceParams = BalanceParams()) -> DataFrame:
    """Adds ``is_rare``: fewer than ``min_leaves`` leaves, unless that would leave fewer than two eligible children in the head."""
    if params.rare_strategy != "fallback":
        return children.withColumn("is_rare", F.lit(False))
    ok = F.coalesce("n_leaves", F.lit(0)) >= params.min_leaves
    eligible = F.sum(ok.cast("int")).over(Window.partitionBy("head"))
    return children.withColumn("is_rare", ~ok & (eligible >= 2))


def cut_index(n: Column, percentage: float) -> Column:
    """Place of the cut value in the sorted capacities, in double arithmetic like the published rule (which truncates)."""
    return F.least(n - 1, F.greatest(F.lit(0), F.floor(n.cast("double") * F.lit(1.0 - percentage / 100.0)).cast("int")))


def balanced_plan(children: DataFrame, params: BalanceParams = BalanceParams()) -> DataFrame:
    """``head, child, capacity, is_rare, scenario, n_per_class, cutoff, status`` with status retained, low_capacity or rare.

    Null capacities count 0. All capacities at least ``min_num_seqs``: level at the least of them, or at ``max_n_per_class`` if that is less. Otherwise
    children below the percentile cut are absorbed and the rest is levelled at its least, capped. Rare children take no part.
    A head of rare children only can't occur (see ``rare_partition``); a head without children has no row.
    """
    base = rare_partition(children, params).withColumn("capacity", F.coalesce("capacity", F.lit(0)).cast("bigint"))
    cap = F.when(~F.col("is_rare"), F.col("capacity"))
    head = Window.partitionBy("head")
    stats = base.withColumn("__min", F.min(cap).over(head)).withColumn("__n", F.count(cap).over(head).cast("int"))
    # the cut value is the capacity at one place of the sorted list: no list is built, the row at that place is found by its number
    place = F.row_number().over(Window.partitionBy("head").orderBy("is_rare", "capacity", "ord"))
    at = stats.withColumn("__place", place)
    at = at.withColumn("cutoff", F.max(F.when(F.col("__place") - 1 == cut_index(F.col("__n"), params.cutoff_percentage), F.col("capacity"))).over(head))
    level = F.col("__min") >= params.min_num_seqs
    kept = ~F.col("is_rare") & (level | (F.col("capacity") >= F.col("cutoff")))
    least = F.min(F.when(kept, F.col("capacity"))).over(head)
    scenario = F.when(level & (F.col("__min") > params.max_n_per_class), "level_all_capped").when(level, "level_all").otherwise("cutoff_applied")
    status = F.when(F.col("is_rare"), "rare").when(kept, "retained").otherwise("low_capacity")
    return at.select(
        "head", "child", "capacity", "is_rare", scenario.alias("scenario"), F.least(least, F.lit(params.max_n_per_class)).alias("n_per_class"), F.when(~level, F.col("cutoff")).alias("cutoff"), status.alias("status")
    )


#: Purposes of the buckets that absorb children of a status.
ABSORBING = {"low_capacity": "low_capacity", "rare": "rare_taxa"}


def absorbing_buckets(plan: DataFrame) -> DataFrame:
    """``head, bucket_id, bucket_rank, n_absorbed, absorbed``: one bucket per head for its low-capacity children, one for its rare ones."""
    purpose = F.create_map(*[F.lit(x) for kv in ABSORBING.items() for x in kv])[F.col("status")]
    rows = plan.where(F.col("status").isin(*ABSORBING)).groupBy("head", purpose.alias("purpose")).agg(F.count(F.lit(1)).alias("n_absorbed"), F.array_sort(F.collect_list("child")).alias("absorbed"))
    return rows.select("head", virtual_id("head", "purpose").alias("bucket_id"), F.concat(F.lit("virtual_"), F.col("purpose")).alias("bucket_rank"), "n_absorbed", "absorbed")


def check_virtual_ids(rows: DataFrame) -> DataFrame:
    """``virtual_id, n`` of ids claimed by different ``(parent, purpose)``: empty unless ids collide. Repeating a claim is fine."""
    return rows.select("virtual_id", "parent", "purpose").distinct().groupBy("virtual_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def keep_imbalance(plan: DataFrame, params: BalanceParams = BalanceParams()) -> DataFrame:
    """Adds ``target``: a retained child's own capacity (n_per_class if it is 0), at most ``max_n_per_class``."""
    return plan.withColumn("target", F.when(F.col("status") == "retained", F.least(F.when(F.col("capacity") > 0, F.col("capacity")).otherwise(F.col("n_per_class")), F.lit(params.max_n_per_class))))


def label_targets(plan: DataFrame, params: BalanceParams = BalanceParams()) -> DataFrame:
    """``label, target``: the greatest n_per_class asked of a label at any head; low-capacity children are asked for their own capacity."""
    want = F.when(F.col("status") == "low_capacity", F.col("capacity")).when(F.col("status") == "retained", F.col("n_per_class"))
    return plan.select(F.col("child").alias("label"), want.alias("t")).where("t is not null").groupBy("label").agg(F.max("t").alias("target"))
