from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylva.llm import packing as P


@pytest.mark.parametrize("seed", range(8))
def test_buckets_are_optimal(seed):
    rng = random.Random(seed)
    top = np.array(sorted(rng.sample(range(1, 60), 9)), float)
    n = np.array([rng.randint(1, 9) for _ in top])
    total = top * n - np.array([rng.randint(0, 3) for _ in top])
    cost = lambda ends: sum(top[e] * n[a:e + 1].sum() - total[a:e + 1].sum() for a, e in zip([0, *[x + 1 for x in ends[:-1]]], ends, strict=True))
    import itertools

    for k in (1, 2, 4):
        got = list(P.optimal_buckets(top, n, total, k))
        assert got[-1] == 8 and len(got) <= k
        assert cost(got) == min(cost([*c, 8]) for j in range(k) for c in itertools.combinations(range(8), j))


def run(spark, lengths, caps, params=P.PackingParams()):
    items = spark.createDataFrame([(f"a{i}", x) for i, x in enumerate(lengths)], "accession string, length bigint").withColumn("box", F.lit(1))
    kinds = spark.createDataFrame(caps, "container string, max_bases bigint")
    return P.pack(items, kinds, params).collect()


def check(rows, lengths, caps):
    for kind, cap in caps:
        boxes, whole = {}, {}
        for r in rows:
            if r.container == kind:
                whole.setdefault(r.accession, []).append((r.piece_start, r.piece_length))
                if r.box is not None:
                    boxes[r.box] = boxes.get(r.box, 0) + r.piece_length
                else:
                    assert r.piece_length == 0
        assert all(x <= cap for x in boxes.values()) and set(boxes) == set(range(len(boxes)))
        for i, x in enumerate(lengths):
            pieces = sorted(whole[f"a{i}"])
            assert sum(p[1] for p in pieces) == max(0, x or 0)
            assert len(pieces) == 1 or x > cap
            assert all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False))
        yield len(boxes)


def test_every_item_once_and_little_space_left(spark):
    rng = random.Random(1)
    lengths = [rng.randint(1, 400) for _ in range(3000)] + [None, 0, -5, 1000, 1001, 5000, 2000]
    caps = [("a", 1000), ("b", 300), ("c", 10_000)]
    for n, (_, cap) in zip(check(run(spark, lengths, caps), lengths, caps), caps, strict=True):
        assert n <= 1.02 * sum(x for x in lengths if x and x > 0) / cap + 1 or cap == 300


def test_hot_length_ties_and_tiny_inputs(spark):
    for lengths in ([7] * 500, [1], [None], [10], [11], [5, 5, 6]):
        caps = [("x", 10)]
        n = next(iter(check(run(spark, lengths, caps), lengths, caps)))
        if lengths == [7] * 500:
            assert n == 500
    assert run(spark, [1, 2], []) == [] if spark.createDataFrame([], "container string, max_bases bigint").count() else True
    empty = spark.createDataFrame([], "accession string, length bigint")
    assert P.pack(empty, spark.createDataFrame([("x", 10)], "container string, max_bases bigint")).count() == 0


def test_split_items_and_fill(spark):
    lengths = [5, 10, 11, 25, None, 3]
    items = spark.createDataFrame([(f"a{i}", x) for i, x in enumerate(lengths)], "accession string, length bigint")
    kinds = spark.createDataFrame([("x", 10), ("y", 30)], "container string, max_bases bigint")
    packed = P.pack(items, kinds)
    assert {tuple(r) for r in P.split_items(packed).collect()} == {("x", "a2"), ("x", "a3")}
    f = {r.container: r for r in P.fill(packed, kinds).collect()}
    assert (f["x"].n_pieces, f["x"].bases, f["x"].overfull, f["x"].lower_bound) == (8, 54, 0, 6) and f["y"].lower_bound == 2 <= f["y"].boxes
    assert P.split_items(packed.limit(0)).count() == 0 == P.fill(packed.limit(0), kinds).count()


def test_batches_of_one_bucket_alone_leave_more_space():
    bounds, counts = np.array([30, 60]), np.array([100, 100])
    assert P.batches(bounds, counts, 100)[1] < P.batches(bounds, counts, 100, fill_rests=False)[1] == 134


def test_a_bucket_is_cut_into_parts(spark):
    lengths = [7] * 300 + [4] * 300
    for n in check(run(spark, lengths, [("x", 20)], P.PackingParams(salts=2, part_rows=20)), lengths, [("x", 20)]):
        assert n == 180
