"""Problems 2 and 3: against brute force, with nulls, ties, repeats, empty tables and extra columns."""

from __future__ import annotations

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from sylva.operators import incremental
from sylva.operators.hot_join import hot_join, hot_keys
from sylva.operators.incremental import IncrementalParams, changed_rows, fingerprints, run_incremental
from sylva.operators.latest import latest
from sylva.operators.spread_rank import global_place, spread_running
from sylva.operators.tree_aggregate import TreeParams, tree_aggregate, tree_median


def test_latest_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 2, None), (None, 1, "n"), ("b", None, "y")], "k string, o int, v string")
    assert {(r.k, r.v) for r in latest(df, ["k"], ["o"], ["v"]).collect()} == {("a", None), (None, "n"), ("b", "y")}
    assert latest(df.limit(0), ["k"], ["o"], ["v"]).count() == 0


def test_changed_rows(spark):
    now = spark.createDataFrame([("a", True, "p"), ("b", False, None), ("c", True, "q"), (None, True, None)], "k string, d boolean, p string").withColumn("bucket_x", F.lit(1))
    before = spark.createDataFrame([("a", True, "p", 9), ("b", False, "r", 9), ("z", True, None, 9), (None, True, None, 9)], "k string, d boolean, p string, h1 int")
    for n in (1, 7, 4096):
        assert {r.k for r in changed_rows(now, before, ["k"], ["d", "p"], n).collect()} == {"b", "c"}
    assert changed_rows(now, before.limit(0), ["k"], ["d", "p"]).count() == 4
    assert changed_rows(now.limit(0), before, ["k"], ["d", "p"]).count() == 0


def test_fingerprint_ignores_order_and_tells_null_from_empty(spark):
    a = spark.createDataFrame([(0, "x", None), (0, "y", "")], "bucket int, k string, v string")
    b = spark.createDataFrame([(0, "y", ""), (0, "x", None)], "bucket int, k string, v string")
    c = spark.createDataFrame([(0, "x", ""), (0, "y", None)], "bucket int, k string, v string")
    f = lambda d: fingerprints(d, ["k", "v"]).collect()
    assert f(a) == f(b) != f(c)


@pytest.fixture
def runs(spark, tmp_path):
    """A store, a run over (key, value, day) rows that doubles values and drops negative ones, and what was seen and put out."""
    store, seen = f"file://{tmp_path}/store", []

    def run(rows, fail=None, **kw):
        def process(df):
            seen.append({r.k for r in df.collect()})
            if fail == "before":
                raise RuntimeError("lost")
            return df.where("v is null or v >= 0").select("k", (F.col("v") * 2).alias("v2"), "bucket")

        def lost():
            raise RuntimeError("lost")

        df = spark.createDataFrame(rows, "k string, v int, day string").withColumn("n", F.lit(1))
        kw = {"params": IncrementalParams(16)} | kw
        return run_incremental(df, ["k"], ["v", "day"], store, process, on_written=lost if fail == "after" else None, **kw)

    def out():
        return {(r.k, r.v2) for r in incremental.output(spark, store, "k string, v2 int").collect()}

    run.store, run.seen, run.out = store, seen, out
    return run


def test_incremental_runs_handle_exactly_what_changed(runs):
    want = lambda rows: {(k, None if v is None else v * 2) for k, v, _ in rows if v is None or v >= 0}
    rows = [(f"k{i}", i, "d") for i in range(200)] + [(None, None, None)]
    assert runs([]).count() == 0 and runs.out() == set()
    assert runs(rows).count() == 16 and runs.out() == want(rows) and len(runs.seen[-1]) == 201
    assert runs(rows).count() == 0 and len(runs.seen) == 1  # nothing changed, nothing processed
    rows[3] = ("k3", 999, "d")
    rows.append(("new", 5, "d"))
    for fail in ("before", "after"):
        with pytest.raises(RuntimeError, match="lost"):
            runs(rows, fail)
    assert 1 <= runs(rows).count() <= 2 and runs.out() == want(rows) and len(runs.seen[-1]) < 60
    assert runs(rows).count() == 0
    few = rows[:1]
    runs(few)
    assert runs.out() == want(few)
    gone = [("k0", -1, "d")]  # processing keeps nothing of the partition
    runs(gone)
    assert runs.out() == set() and runs(gone).count() == 0
    with pytest.raises(ValueError):
        runs(rows, params=IncrementalParams(8))


def test_a_source_that_goes_back_after_a_lost_run_is_handled_again(runs):
    a, b = [(f"k{i}", i, "d") for i in range(50)], [(f"k{i}", i + 1000, "d") for i in range(50)]
    runs(a)
    with pytest.raises(RuntimeError, match="lost"):
        runs(b, "after")  # its output is in place, its fingerprints aren't
    assert runs.out() == {(k, v * 2) for k, v, _ in b}
    assert runs(a).count() == 16 and runs.out() == {(k, v * 2) for k, v, _ in a}


def test_a_tenth_of_the_days_changes_a_tenth_of_the_partitions(runs):
    rows = [(f"k{i}", i, f"2024-01-{i % 30:02d} x/y") for i in range(3000)]
    kw = {"by": ["day"], "params": IncrementalParams(4)}
    assert runs(rows, **kw).count() == 120
    rows = [(k, v + (d[8:10] in ("03", "07", "29")), d) for k, v, d in rows]
    assert runs(rows, **kw).count() == 12 and len(runs.seen[-1]) == 300
    rows += [("late", 1, "2025-01-01"), ("none", 2, None)]  # new days bring partitions of their own
    assert runs(rows, **kw).count() == 2 and runs.out() == {(k, v * 2) for k, v, _ in rows}


def test_a_moving_source_is_met_again(spark, runs, monkeypatch):
    a, b = [(f"k{i}", i, "d") for i in range(50)], [(f"k{i}", i + 1, "d") for i in range(50)]
    runs(a)
    path = f"{runs.store}-source"
    spark.createDataFrame(b, "k string, v int, day string").write.parquet(path)

    def process(df):  # while this run works, the source goes on
        spark.createDataFrame([(k, v + 7, d) for k, v, d in b], "k string, v int, day string").write.mode("overwrite").parquet(path)
        return df.select("k", (F.col("v") * 2).alias("v2"), "bucket")

    read = lambda: spark.read.parquet(path)
    run_incremental(read(), ["k"], ["v", "day"], runs.store, process, IncrementalParams(16))
    assert runs.out() == {(k, v * 2) for k, v, _ in b}  # the snapshot's values
    assert run_incremental(read(), ["k"], ["v", "day"], runs.store, lambda df: df.select("k", (F.col("v") * 2).alias("v2"), "bucket"), IncrementalParams(16)).count() == 16
    assert runs.out() == {(k, (v + 7) * 2) for k, v, _ in b}


def test_tree_aggregate_and_median_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])), rng.choice([None, rng.randint(-50, 10**10), 5, 0]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v bigint, id int").withColumn("__chunk_x", F.lit(0))
    for p in (TreeParams(), TreeParams(900, 2), TreeParams(50, 4), TreeParams(chunks=5, fan_in=2)):
        got = {r.k: (r.n, r.s, r.lo) for r in tree_aggregate(df, ["k"], ["id"], {"n": ("sum", F.lit(1).cast("bigint")), "s": ("sum", F.col("v")), "lo": ("min", F.col("v"))}, p).collect()}
        for k in ("hot", "a", "b", None):
            v = [x[1] for x in rows if x[0] == k and x[1] is not None]
            assert got[k] == (sum(1 for x in rows if x[0] == k), sum(v), min(v))
    for p in (TreeParams(mantissa_bits=1), TreeParams(500, 3)):
        got = {r.k: r.median for r in tree_median(df, ["k"], "v", ["id"], p).collect()}
        for k in ("hot", "a", "b", None):
            assert got[k] == median([x[1] for x in rows if x[0] == k and x[1] is not None])
    assert tree_median(df.limit(0), ["k"], "v", ["id"]).count() == 0
    assert tree_aggregate(df.limit(0), ["k"], ["id"], {"n": ("sum", F.lit(1))}).count() == 0


def test_spread_running_gives_places_and_sums(spark):
    rows = [("hot" if i % 3 else None, i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, id int, w int")
    got = spread_running(df, ["g"], ["id"], salts=8, out="place").collect()
    for g in ("hot", None):
        assert sorted(r.place for r in got if r.g == g) == list(range(sum(1 for x in rows if x[0] == g)))
    acc = sorted((r.start, r.w) for r in spread_running(df, ["g"], ["id"], "w", salts=4).where("g = 'hot' and w > 0").collect())
    at = 0
    for start, w in acc:
        assert start == at
        at += w
    places = sorted(r.place for r in global_place(df.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 48))), "h", "id").collect())
    assert places == list(range(500))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_join(spark, how):
    rows = [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(200)] + [(None, i) for i in range(5)]
    df, one = spark.createDataFrame(rows, "k string, i int"), spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(100)], ("other", "x"), (None, "n")], "k string, v string")
    hot = hot_keys(df, "k", 100)
    assert [r.k for r in hot.collect()] == ["hot"]
    want = sorted(map(tuple, df.join(one, "k", how).collect()), key=str)
    assert sorted(map(tuple, hot_join(df, one, "k", hot, how).collect()), key=str) == want
    assert hot_join(df.limit(0), one, "k", hot, how).count() == 0
