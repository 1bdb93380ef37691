"""Splits that keep related records together.

Records tie their taxids; a distributed union-find joins ties into groups. Every task builds a forest of its own ties, and forests are merged
``fan_in`` at a time, round by round; a round has as many tasks as it takes to give each at most about ``task_ties`` ties, the first one too. Each
round passes on at most one tie per node a task has seen. As long as the ties need more than one task they are
contracted between the rounds, each node to the least node of its neighbourhood, so that forests that lie in different tasks meet. Rounds end
with the one that has a single task, or when every tree is a star. Groups are then assigned largest first to the split furthest below its
target; that order depends only on the sizes, so it runs over the histogram of group sizes (at most sqrt(2 x records) different ones).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.text import accession_key, taxid_number
from sylva.operators.hot_join import HOT_PARTS, hot_join, hot_keys
from sylva.operators.latest import latest
from sylva.operators.spread_rank import spread_running
from sylva.session import written


@dataclass(frozen=True)
class SplitParams:
    """``task_ties`` bounds the forest a task holds, about 200 bytes a tie; pairs of a group are made by tasks of ``pair_rows`` of its nodes each."""

    leaves: int = 64
    fan_in: int = 8
    task_ties: int = 2_000_000
    salts: int = 64
    pair_rows: int = 512


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties of one task to a forest: each node but the roots comes out once, tied to its tree's least node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                lo, hi = (ra, rb) if ra < rb else (rb, ra)
                parent[hi] = lo
                parent.setdefault(lo, lo)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 65536):
        some = nodes[i : i + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([parent[x] for x in some], pa.int64())], names=["a", "b"])


def _contract(edges: DataFrame) -> DataFrame:
    """One round of contraction: a large star, then a small star. What is connected stays connected, and labels only fall."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    down = written(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
    return written(small.distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one node only, which itself is tied to none: then the trees are the groups."""
    return edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def components(ties: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """``(node, root)`` for every node of ``ties(a, b)``; the root is the least node of the group and has a row itself.

    Ties with a null end and of a node with itself tie nothing. An empty table gives no rows.
    """
    forest = ties.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b"))
    forest, schema = written(forest), "a bigint, b bigint"
    need = lambda: -(-forest.count() // params.task_ties)
    parts, spread = max(params.leaves, need()), ("a", "b")  # ties go by both ends first, so a node with a third of all ties is many tasks' work
    while True:
        forest = written(forest.repartition(parts, *spread).mapInArrow(local_forest, schema))
        if parts == 1:
            break
        least = need()
        if least > 1:
            forest = _contract(forest)
            if _all_stars(forest):
                break
        parts, spread = max(1, need(), math.ceil(parts / params.fan_in)), ("a",)
    forest = forest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return forest.unionByName(forest.select(F.col("root").alias("node"), "root").distinct())


def records(accessions: DataFrame, plasmids: DataFrame) -> DataFrame:
    """``accession, origin, key, taxid``: current rows of accessions and all rows of plasmid_records; null taxids and keys stay."""
    current = latest(accessions.where("accession is not null"), ["accession"], ["last_update"], ["taxid"])
    a = current.select("accession", F.lit("accessions").alias("origin"), accession_key("accession").alias("key"), taxid_number("taxid").alias("taxid"))
    b = plasmids.select("accession", F.lit("plasmid_records").alias("origin"), accession_key("accession").alias("key"), taxid_number("host_taxid").alias("taxid"))
    return a.unionByName(b)


def taxid_ties(rows: DataFrame) -> DataFrame:
    """Each further taxid of a record tied to the record's least one: a record with n taxids gives n - 1 ties, not n squared."""
    pairs = rows.where("key is not null and taxid is not null").groupBy("key", "taxid").agg(F.lit(1).alias("x"))
    least = pairs.groupBy("key").agg(F.min("taxid").alias("a"), F.max("taxid").alias("z")).where("a < z")
    return pairs.join(least, "key").where("taxid > a").select("a", F.col("taxid").alias("b")).distinct()


def greedy_quota(sizes: Sequence[tuple[int, int]], shares: Sequence[float]) -> list[list[int]]:
    """For each (size, groups), largest size first: how many of its groups go to each split.

    Each group goes to the split furthest below its target, ties to the first. A run of equal groups is cut
    at the water level at which the greedy would stop, so a million groups cost as little as one.
    """
    total = sum(s * n for s, n in sizes)
    gap = [x * total for x in shares]
    out = []
    for size, n in sizes:
        lo, hi = min(gap) - size * (n + 1), max(gap)
        count = lambda level: [max(0, math.floor((g - level) / size)) for g in gap]
        for _ in range(80):
            mid = (lo + hi) / 2
            if sum(count(mid)) > n:
                lo = mid
            else:
                hi = mid
        take = count(hi)
        gap = [g - t * size for g, t in zip(gap, take, strict=True)]
        for _ in range(n - sum(take)):
            k = int(np.argmax(gap))
            take[k] += 1
            gap[k] -= size
        out.append(take)
    return out


def assign(rows: DataFrame, groups: DataFrame, targets: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """``accession, origin, taxid, group, split_name`` for every record.

    The group of a record is ``t<root taxid>``, else ``k<key>``; records with neither share nothing, and a group each is made of their
    own hashed place. Records that share a key follow the key's taxid, so a record without taxid goes with
    its spelling twin that has one. ``targets`` is a small fixed table; shares are scaled to sum to 1, and null or negative ones count 0.
    """
    spark = rows.sparkSession
    named_targets = targets.where("split_name is not null").limit(1001).collect()
    if len(named_targets) > 1000:
        raise ValueError("at most 1,000 splits")
    goal = sorted((r["split_name"], max(0.0, float(r["target_share"] or 0))) for r in named_targets)
    goal = sorted(goal, key=lambda x: -x[1])
    if not goal or sum(s for _, s in goal) <= 0:
        raise ValueError("split_targets holds no positive share")
    shares = [s / sum(x for _, x in goal) for _, s in goal]
    by_key = rows.where("key is not null and taxid is not null").groupBy("key").agg(F.min("taxid").alias("key_taxid"))
    roots = groups.select(F.col("node").alias("any_taxid"), "root")
    known = rows.join(by_key, "key", "left").withColumn("any_taxid", F.coalesce("taxid", "key_taxid"))
    # a row with neither taxid nor key is alone; rows equal in all columns get different numbers
    known = written(known.withColumn("alone", F.when(F.col("any_taxid").isNull() & F.col("key").isNull(), F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string")))))
    known = hot_join(known, roots, "any_taxid", hot_keys(known, "any_taxid")).withColumn("taxid_group", F.coalesce("root", "any_taxid"))
    named = written(known.select("accession", "origin", "taxid", F.coalesce(F.concat(F.lit("t"), F.col("taxid_group").cast("string")), F.concat(F.lit("k"), F.col("key")), "alone").alias("group")))
    sizes = written(named.groupBy("group").agg(F.count(F.lit(1)).alias("size")))
    hist = [(r["size"], r["n"]) for r in sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()]  # at most sqrt(2 x records) rows
    table = []
    for (size, _), take in zip(hist, greedy_quota(hist, shares), strict=True):
        at = 0
        for (name, _), n in zip(goal, take, strict=True):
            if n:
                table.append((size, at, at + n, name))
                at += n
    quota = spark.createDataFrame(table, "size bigint, lo bigint, hi bigint, split_name string").groupBy("size").agg(F.collect_list(F.struct("lo", "hi", "split_name")).alias("q"))
    placed = spread_running(sizes, ["size"], ["group"], salts=params.salts, out="place").join(quota, "size")
    split = F.element_at(F.filter("q", lambda x: (F.col("place") >= x["lo"]) & (F.col("place") < x["hi"])), 1)["split_name"]
    total = sum(size * n for size, n in hist)
    hot = sizes.where(F.col("size") * HOT_PARTS >= total).select("group")  # at most HOT_PARTS groups
    return hot_join(named, placed.select("group", split.alias("split_name")), "group", hot, "inner").select("accession", "origin", "taxid", "group", "split_name")


def tied_pairs(groups: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """All pairs of a group's taxids, as the problem states its result; ``groups`` as from ``components``.

    A group of n nodes is cut into n / ``pair_rows`` parts, and each part meets the whole group: no task makes more than ``pair_rows`` x n of its pairs.
    """
    parts = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / params.pair_rows).cast("int").alias("parts"))
    cut = groups.join(parts, "root")
    a = cut.select("root", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.col("node").alias("taxid_a"))
    b = cut.select("root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("node").alias("taxid_b"))
    return a.join(b, ["root", "part"]).where("taxid_a < taxid_b").select("taxid_a", "taxid_b")
