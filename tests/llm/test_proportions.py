from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylva.llm import proportions as P


@pytest.mark.parametrize("seed", range(30))
def test_swap_repair_is_optimal(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 5))
    have, floor = rng.integers(0, 9, k), rng.integers(0, 4, k)
    size = int(rng.integers(0, 20))
    goal = rng.integers(0, 9, k)
    x = P.swap_repair(have, goal, floor, size, seed)
    total = min(size, int(have.sum()))
    assert x.sum() == total and (x >= 0).all() and (x <= have).all()
    low = np.minimum(floor, have)
    if low.sum() <= total:
        assert (x >= low).all()
        best = min(abs(np.array(y) - goal).sum() for y in itertools.product(*[range(int(a), int(b) + 1) for a, b in zip(low, have, strict=True)]) if sum(y) == total)
        assert abs(x - goal).sum() == best


LM = "head_taxid string, class_idx int, rank string, n_windows bigint, exported_at timestamp_ntz, extra int"


def tables(spark):
    import datetime as dt

    t = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("h", 0, "Genus ", 100, t(1), 1), ("h", 0, "genus", 50, t(2), 1), ("h", 0, "genus", 50, t(2), 1), ("h", 1, None, 30, t(1), 1), ("h", 2, "species", None, t(1), 1), ("h", -1, "genus", 999, t(1), 1), ("h", 3, "order", 40, t(1), 1),
        ("k", 0, "x", 7, t(1), 1), ("k", 1, "x", 5, t(1), 1), (None, 0, "x", 5, t(1), 1), ("u", 0, "x", 5, t(1), 1),
    ]
    lm = spark.createDataFrame(rows, LM)
    req = spark.createDataFrame([("h", 100), ("k", 10), ("gone", 5)], "head_taxid string, sample_size bigint")
    tg = spark.createDataFrame([("h", "rank", "genus", 0.6, 10), ("h", "rank", "unknown", 0.2, 5), ("h", "rank", "species", 0.2, 0), ("k", "class_idx", "0", 0.5, 0), ("k", "class_idx", "1", 0.5, 6), ("gone", "rank", "x", 1.0, 0)], "head_taxid string, axis_name string, category string, target_share double, min_windows bigint")
    return lm, req, tg


def test_plan_and_sample(spark):
    lm, req, tg = tables(spark)
    plan = P.plan(lm, req, tg)
    got = {(r.head_taxid, r.category): r for r in plan.collect()}
    assert {k for k, r in got.items() if r.short} == {("h", "genus"), ("h", "species"), ("k", "1"), ("gone", "x")}
    assert sum(r.n_drawn for (h, _), r in got.items() if h == "h") == 100
    assert got["h", "genus"].n_drawn == 50 and got["h", "species"].n_drawn == 0
    s = P.materialise(lm, tg, plan).collect()
    drawn = {}
    for r in s:
        assert len(set(r.windows)) == len(r.windows) and list(r.windows) == sorted(r.windows)
        drawn[r.head_taxid, r.category] = drawn.get((r.head_taxid, r.category), 0) + len(r.windows)
        assert all(0 <= w < {("h", 0): 50, ("h", 1): 30, ("h", 3): 40, ("k", 0): 7, ("k", 1): 5}[r.head_taxid, r.class_idx] for w in r.windows)
    for (h, c), r in got.items():
        assert drawn.get((h, None if c == P.OTHER else c), 0) == r.n_drawn
    again = P.materialise(lm.repartition(3), tg, P.plan(lm.repartition(3), req, tg)).collect()
    assert sorted(map(str, again)) == sorted(map(str, s))


def test_sample_is_spread_over_all_windows(spark):
    import datetime as dt

    lm = spark.createDataFrame([("h", i, "r", 1000, dt.datetime(2024, 1, 1), 0) for i in range(30)], LM)
    tg = spark.createDataFrame([("h", "rank", "r", 1.0, 0)], "head_taxid string, axis_name string, category string, target_share double, min_windows bigint")
    req = spark.createDataFrame([("h", 3000)], "head_taxid string, sample_size bigint")
    n = P.materialise(lm, tg, P.plan(lm, req, tg)).select(F.size("windows").alias("n")).collect()
    assert len(n) == 30 and sum(r.n for r in n) == 3000 and all(95 <= r.n <= 105 for r in n)


def test_empty_tables(spark):
    lm, req, tg = tables(spark)
    assert P.plan(lm, req, tg.limit(0)).count() == 0
    p = P.plan(lm.limit(0), req, tg)
    assert p.count() == 6 and p.agg(F.sum("n_drawn")).first()[0] == 0
    assert P.materialise(lm.limit(0), tg, p).count() == 0
    assert {r.n_drawn for r in P.plan(lm, req.limit(0), tg).collect()} == {0}


def test_the_start_follows_the_shares_at_any_size():
    have = np.array([6, 3, 1]) * 10**15
    for size in (10, 10**6, 10**13):
        x = P.swap_repair(have, have // 10**15 * 0, np.zeros(3, int), size, 1)
        assert x.sum() == size
        if size > 10:
            assert abs(x / size - [0.6, 0.3, 0.1]).max() < 0.01
    assert P.swap_repair(np.array([5, 0, 2]), np.array([1, 1, 1]), np.zeros(3, int), 10**12, 1).tolist() == [5, 0, 2]


def test_large_classes_are_drawn_in_parts(spark, monkeypatch):
    import datetime as dt

    monkeypatch.setattr(P, "STEP", 64)  # the driver's plan; tasks keep their own
    lm = spark.createDataFrame([("h", 0, "r", 10_007, dt.datetime(2024, 1, 1), 0), ("h", 1, "r", 500, dt.datetime(2024, 1, 1), 0), ("h", 2, "r", 10**15, dt.datetime(2024, 1, 1), 0)], LM)
    for axis, shares in (("class_idx", [("0", 0.9), ("1", 0.05), ("2", 0.05)]), ("rank", [("r", 1.0)])):
        tg = spark.createDataFrame([("h", axis, c, s, 0) for c, s in shares], "head_taxid string, axis_name string, category string, target_share double, min_windows bigint")
        plan = P.plan(lm, spark.createDataFrame([("h", 8000)], "head_taxid string, sample_size bigint"), tg)
        drawn: dict[int, list[int]] = {}
        for r in P.materialise(lm, tg, plan).collect():
            drawn.setdefault(r.class_idx, []).extend(r.windows)
        assert sum(map(len, drawn.values())) == 8000 and all(len(set(w)) == len(w) for w in drawn.values())
        assert all(0 <= min(w) and max(w) < {0: 10_007, 1: 500, 2: 10**15}[c] for c, w in drawn.items())
