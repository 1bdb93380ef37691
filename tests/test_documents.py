from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sylva.operators import similarity
from sylva.plans import check_queries as Q


@pytest.mark.parametrize("entries", [200, 10**6])
def test_catalogue_in_parts_is_whole(spark, sf, monkeypatch, entries):
    import duckdb

    monkeypatch.setattr(Q, "ENTRIES", entries)
    con = duckdb.connect()
    for t in ("lineages", "accessions"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("catalogue_lineages", "catalogue_document", "catalogue_taxa"):
        df = getattr(Q, name)(spark, sf)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({Q.ORACLE[name]})").fetchall()
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_nearest_against_all_candidates(spark):
    import random

    rng = random.Random(2)
    of = lambda n: sorted(rng.sample(range(400), n))
    qs = [(g, f"q{g}{i}", of(rng.choice((0, 3, 12)))) for g in "abc" for i in range(30)] + [("a", "ca0", of(12)), ("d", "cd0", of(12)), ("e", "qe", of(12))]
    cs = [(g, f"c{g}{i}", of(rng.choice((0, 3, 12)))) for g in "abc" for i in range(40)] + [("d", "cd0", of(12)), ("d", "cd1", [1000])]
    schema = "group string, {} string, sketch array<bigint>"
    got = {r["query"]: r for r in similarity.nearest(spark.createDataFrame(qs, schema.format("query")), spark.createDataFrame(cs, schema.format("candidate")), 11, 12).collect()}

    def sim(a, b):
        least = sorted(set(a) | set(b))[:12]
        return len([x for x in least if x in a and x in b]) / len(least)

    want = {}
    for g, q, a in qs:
        near = [(-sim(a, b), c) for h, c, b in cs if h == g and c != q and b and a]
        if near:
            want[q] = (min(near)[1], round(-min(near)[0], 4))
    assert {q: (r.nearest, r.jaccard) for q, r in got.items()} == want and got["cd0"].nearest == "cd1" and {r.jaccard for r in got.values()} > {0.0}


def test_nearest_never_joins_all_candidates_of_a_group(spark):
    df = spark.range(300).select(F.lit("g").alias("group"), F.col("id").cast("string").alias("x"), F.array(F.col("id")).alias("sketch"))
    near = similarity.nearest(df.withColumnRenamed("x", "query"), df.select("group", F.concat(F.lit("c"), "x").alias("candidate"), "sketch"), 11, 12)
    assert near.where("jaccard = 1 and nearest = concat('c', query)").count() == 300
    assert "Generate explode(sa" in near._jdf.queryExecution().executedPlan().toString()
