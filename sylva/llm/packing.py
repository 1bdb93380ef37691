"""Filling fixed-capacity containers, by optimal length buckets over the global histogram.

1. Lengths are counted in a histogram of at most ``bins`` bins a container type (a bound, whatever the data), with each bin's greatest length.
2. Dynamic programming chooses ``buckets`` boundaries among the bins that minimise the padding (boundary minus length, over all items).
3. Batches fill the capacity, as a token budget, with items counted at their bucket's boundary: the largest bucket with items
   left opens a batch and fills it as far as whole items go; what is left of the budget goes to the following buckets. Batches of one bucket alone
   would leave the rest of each budget empty, which the problem forbids (``fill_rests=False`` makes those). Equal batches are made many at a
   time, so this works on the bucket counts alone.
4. Items get places inside their bucket by spread ranks and so fall into the batches. Nothing about single items reaches the driver.

Lengths above the capacity are cut into full containers and a rest; only those items are cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.operators.latest import latest
from sylva.operators.spread_rank import spread_running
from sylva.session import written


@dataclass(frozen=True)
class PackingParams:
    """``bins`` bounds the histogram sent to the driver, ``buckets`` the boundaries chosen from it; a bucket is cut into parts of about ``part_rows``."""

    bins: int = 1024
    buckets: int = 256
    salts: int = 64
    part_rows: int = 1_000_000
    fill_rests: bool = True


def optimal_buckets(top: np.ndarray, n: np.ndarray, total: np.ndarray, buckets: int) -> np.ndarray:
    """Indices of the bins that end a bucket, minimising sum(boundary - length); ``top`` rises, ``n`` and ``total`` are counts and sums of lengths."""
    m = len(top)
    if m <= buckets:
        return np.arange(m)
    count, length = np.concatenate([[0], np.cumsum(n)]).astype(float), np.concatenate([[0], np.cumsum(total)]).astype(float)
    # cost[i, j]: bins i..j-1 in one bucket = top[j-1] * (count[j] - count[i]) - (length[j] - length[i])
    cost = np.full((m + 1, m + 1), np.inf)
    cost[:, 1:] = top[None, :] * (count[None, 1:] - count[:, None]) - (length[None, 1:] - length[:, None])
    cost[np.tril_indices(m + 1)] = np.inf
    best = cost[0].copy()
    best[0] = 0.0
    choice = np.zeros((buckets, m + 1), dtype=np.int32)
    for k in range(1, buckets):
        step = best[:, None] + cost
        choice[k] = np.argmin(step, axis=0)
        best = np.concatenate([[0.0], step[choice[k, 1:], np.arange(1, m + 1)]])
    ends, j = [], m
    for k in range(buckets - 1, -1, -1):
        ends.append(j - 1)
        j = int(choice[k, j])
        if j == 0:
            break
    return np.array(sorted(ends))


def batches(bounds: np.ndarray, counts: np.ndarray, capacity: int, fill_rests: bool = True) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments ``(bucket, from_place, to_place, first_batch, per_batch)`` and the number of batches."""
    left = counts.astype(np.int64).copy()
    placed = np.zeros(len(bounds), dtype=np.int64)
    segments, batch = [], 0
    for b in range(len(bounds) - 1, -1, -1):
        while left[b] > 0:
            room, pattern = capacity, []
            for c in range(b, -1 if fill_rests else b - 1, -1):
                if left[c] > 0 and bounds[c] <= room:
                    k = int(min(left[c], room // max(int(bounds[c]), 1)))
                    pattern.append((c, k))
                    room -= k * int(bounds[c])
            times = int(min(left[c] // k for c, k in pattern))
            for c, k in pattern:
                segments.append((c, int(placed[c]), int(placed[c] + times * k), batch, k))
                placed[c] += times * k
                left[c] -= times * k
            batch += times
    return segments, batch


def pieces(items: DataFrame, containers: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """``container, max_bases, accession, piece, n_pieces, piece_start, piece_length``: whole items, or the cuts of too long ones.

    ``containers`` is a small fixed table (checked: at most 1,000 rows) that becomes part of the plan. Items without a positive length
    come out with piece_length 0. Containers without a positive capacity are left out.
    """
    kinds = containers.where("max_bases > 0 and container is not null").groupBy("container").agg(F.max("max_bases").alias("max_bases")).limit(1001).collect()
    if len(kinds) > 1000:
        raise ValueError("at most 1,000 container types")
    each = F.array(*[F.struct(F.lit(k["container"]).alias("container"), F.lit(k["max_bases"]).cast("bigint").alias("max_bases")) for k in sorted(kinds)])
    if not kinds:
        each = F.array().cast("array<struct<container: string, max_bases: bigint>>")
    length = F.greatest(F.coalesce(F.col("length"), F.lit(0)), F.lit(0))
    both = items.select("accession", length.alias("length"), F.explode(each).alias("k")).select("accession", "length", "k.*")
    n = F.expr("cast(greatest((length - 1) div max_bases + 1, 1) as int)")
    cut = both.withColumn("n_pieces", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    start = F.col("piece").cast("bigint") * F.col("max_bases")
    return cut.select("container", "max_bases", "accession", "piece", "n_pieces", start.alias("piece_start"), F.least(F.col("max_bases"), F.col("length") - start).alias("piece_length"))


def _bin(params: PackingParams) -> Column:
    """A bin of the length relative to the capacity: two thirds of the bins evenly over (0, 1], the others evenly over the logarithm below."""
    share = F.col("piece_length") / F.col("max_bases")
    linear = params.bins * 2 // 3
    log = params.bins - linear
    low = F.greatest(F.lit(0), F.floor((F.log2(share) + 32) / 32 * log))
    return F.when(share > 1 / 64, log + F.ceil(share * linear)).otherwise(low).cast("int")


def pack(items: DataFrame, containers: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """``container, accession, piece, n_pieces, piece_start, piece_length, box`` with ``box`` counted from 0 in each container type.

    Every piece is in exactly one box and no box holds more than max_bases. Items of null or not positive length have piece_length 0
    and box null. ``items`` has one row per accession; repeated accessions are packed as often as they occur.
    Full containers cut from long items get the first box numbers of their own. An empty table gives no rows.
    """
    spark = items.sparkSession
    cut = pieces(written(items.select("accession", "length")), containers, params)  # read three times
    part = cut.where("piece_length > 0").withColumn("bin", _bin(params))
    hist = part.groupBy("container", "max_bases", "bin").agg(F.max("piece_length").alias("top"), F.count(F.lit(1)).alias("n"), F.sum(F.col("piece_length").cast("decimal(38,0)")).alias("total"))
    rows = hist.collect()  # at most bins + 2 rows a container type
    buckets, segments, most = [], [], 0
    for kind in sorted({r["container"] for r in rows}):
        mine = sorted((r for r in rows if r["container"] == kind), key=lambda r: r["bin"])
        top, n = np.array([r["top"] for r in mine], dtype=np.int64), np.array([r["n"] for r in mine], dtype=np.int64)
        ends = optimal_buckets(top.astype(float), n, np.array([float(r["total"]) for r in mine]), params.buckets)
        of = np.searchsorted(ends, np.arange(len(mine)))
        counts = np.bincount(of, weights=n, minlength=len(ends)).astype(np.int64)
        most = max(most, int(counts.max()))
        made, _ = batches(top[ends], counts, int(mine[0]["max_bases"]), params.fill_rests)
        by: dict[int, list] = {}
        for c, lo, hi, first, per in made:
            by.setdefault(c, []).append((lo, hi, first, per))
        buckets += [(kind, mine[i]["bin"], int(of[i])) for i in range(len(mine))]
        segments += [(kind, c, s) for c, s in by.items()]
    bin_to_bucket = spark.createDataFrame(buckets, "container string, bin int, bucket int")
    places = spark.createDataFrame(segments, "container string, bucket int, segs array<struct<lo bigint, hi bigint, first bigint, per bigint>>")
    known = part.join(F.broadcast(bin_to_bucket), ["container", "bin"])
    placed = spread_running(known, ["container", "bucket"], ["accession", "piece"], salts=max(params.salts, -(-most // params.part_rows)), out="place")
    seg = F.element_at(F.filter("segs", lambda s: (F.col("place") >= s["lo"]) & (F.col("place") < s["hi"])), 1)
    boxed = placed.join(F.broadcast(places), ["container", "bucket"]).withColumn("s", seg).withColumn("box", F.expr("s.first + (place - s.lo) div s.per"))
    out = ["container", "accession", "piece", "n_pieces", "piece_start", "piece_length", "box"]
    return boxed.select(*out).unionByName(cut.where("piece_length <= 0").withColumn("box", F.lit(None).cast("bigint")).select(*out))


def split_items(packed: DataFrame) -> DataFrame:
    """``container, accession`` of the items that lie in more than one box."""
    boxes = packed.where("box is not null").groupBy("container", "accession").agg(F.min("box").alias("lo"), F.max("box").alias("hi"))
    return boxes.where("lo < hi").select("container", "accession")


def fill(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per container type: ``n_pieces, bases, boxes, overfull, lower_bound`` (no packing has fewer boxes); nothing is rounded.

    A box is one row after the first aggregate, so no task holds a type's boxes.
    """
    cap = containers.where("max_bases > 0").groupBy("container").agg(F.max("max_bases").alias("max_bases"))
    each = packed.where("box is not null").groupBy("container", "box").agg(F.count(F.lit(1)).alias("n"), F.sum("piece_length").alias("bases"))
    j = each.join(F.broadcast(cap.limit(1001)), "container")
    out = j.groupBy("container", "max_bases").agg(F.sum("n").alias("n_pieces"), F.sum("bases").alias("bases"), F.count(F.lit(1)).alias("boxes"), F.count_if(F.col("bases") > F.col("max_bases")).alias("overfull"))
    return out.select("container", "n_pieces", "bases", "boxes", "overfull", F.expr("(bases + max_bases - 1) div max_bases").alias("lower_bound"))


def current_lengths(accessions: DataFrame) -> DataFrame:
    rows = latest(accessions.where("accession is not null"), ["accession"], ["last_update"], ["total_sequence_length"])
    return rows.select("accession", F.col("total_sequence_length").alias("length"))
