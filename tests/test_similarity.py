from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sylva.operators import similarity
from sylva.plans import dataset_queries as Q

SIZE = 12


def _jaccard(a, b):
    least = sorted(set(a) | set(b))[:SIZE]
    return len([x for x in least if x in a and x in b]) / len(least) if a and b else 0.0


@pytest.fixture(scope="module")
def sketched(spark):
    """Groups of one to 150 sketches, long and short ones, some of them empty."""
    rng = random.Random(5)
    rows = []
    for g, n, values in (("a", 150, 90), ("b", 70, 400), ("c", 40, 60), ("d", 3, 20), ("e", 1, 20)):
        rows += [(g, f"{g}{i}", sorted(rng.sample(range(values), rng.choice((0, 4, SIZE, SIZE))))) for i in range(n)]
    by_group: dict[str, dict[str, list[int]]] = {}
    for g, k, x in rows:
        by_group.setdefault(g, {})[k] = x
    return spark.createDataFrame(rows, "grp string, id string, sketch array<bigint>").repartition(5), by_group


def _pairs(by_group, threshold):
    """Pairs of different sketches, each represented by its least key."""
    out = {}
    for g, of in by_group.items():
        least: dict[tuple, str] = {}
        for k in sorted(of):
            if of[k]:
                least.setdefault(tuple(of[k]), k)
        keys = sorted(least.values())
        out |= {(g, a, b): j for i, a in enumerate(keys) for b in keys[i + 1 :] if (j := _jaccard(of[a], of[b])) >= threshold}
    return out


@pytest.mark.parametrize(("block", "small"), [(16_384, 64), (16_384, 1), (20, 64), (20, 1)])
def test_similar_pairs_against_all_pairs(sketched, monkeypatch, block, small):
    df, by_group = sketched
    monkeypatch.setattr(similarity, "BLOCK", block)
    for threshold in (0.05, 0.3):
        got = {(r.grp, r.a, r.b): r.jaccard for r in similarity.similar_pairs(df, "grp", "id", threshold, SIZE).collect()}
        assert got == _pairs(by_group, threshold) and got


def _clusters(keys, pairs):
    of = {k: k for k in keys}
    for a, b in pairs:
        x, y = sorted((of[a], of[b]))
        of = {k: x if v == y else v for k, v in of.items()}
    return of


def test_forest_ties_what_all_pairs_tie(sketched, monkeypatch):
    df, by_group = sketched
    monkeypatch.setattr(similarity, "BLOCK", 20)
    monkeypatch.setattr(similarity, "LINKS", 30)
    links = [r for r in similarity.similar_forest(df, "grp", "id", 0.1, SIZE).collect()]
    for g, of in by_group.items():
        assert len([r for r in links if r.grp == g]) < len(of)
        for t in (0.1, 0.2, 0.4):
            assert _clusters(of, [(r.a, r.b) for r in links if r.grp == g and r.jaccard >= t]) == _clusters(of, [(a, b) for (h, a, b), j in _pairs(by_group, t).items() if h == g])


def test_components_of_many_links_in_parts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "LINKS", 20)
    rng = random.Random(3)
    edges = [(g, f"{rng.randrange(60)}", f"{rng.randrange(60)}") for g in ("g", "h") for _ in range(50)]
    nodes = [(g, f"{i}") for g in ("g", "h", "i") for i in range(60)]
    got = similarity.components(spark.createDataFrame(nodes, "grp string, node string"), spark.createDataFrame(edges, "grp string, a string, b string"), "grp").collect()
    want = {(g, k): v for g in ("g", "h", "i") for k, v in _clusters([str(i) for i in range(60)], [(a, b) for h, a, b in edges if h == g]).items()}
    assert {(r.grp, r.node): r.component for r in got} == want and len(got) == len(nodes)


def test_clusters_of_groups_of_any_size(sketched):
    df, by_group = sketched
    p = similarity.ClusterParams(sketch_size=SIZE, threshold=0.5, relaxed=(0.3, 0.2), min_genomes=2, min_fraction=0.0, max_genomes=None)
    got = {(r.grp, r.id): (r.cluster, r.threshold) for r in similarity.cluster_genomes(df, "grp", "id", p).collect()}
    want = {}
    for g, of in by_group.items():
        same: dict[tuple, str] = {}
        equal = [(same.setdefault(tuple(of[k]), k), k) for k in sorted(of) if of[k]]
        for t in (0.5, 0.3, 0.2):
            c = _clusters(of, equal + [(a, b) for (h, a, b) in _pairs(by_group, t) if h == g])
            if sum(list(c.values()).count(x) >= 2 for x in set(c.values())) >= 2:
                want |= {(g, k): (v, t) for k, v in c.items()}
                break
    assert got == want and {g for g, _ in got} >= {"a", "c"}
    few = similarity.cluster_genomes(df, "grp", "id", similarity.ClusterParams(sketch_size=SIZE, threshold=0.3, relaxed=(), max_genomes=100))
    assert "a" not in {r.grp for r in few.select("grp").distinct().collect()}


def test_dereplication_against_the_greedy_rule(sketched):
    df, by_group = sketched
    got = {(r.grp, r.id): r.kept_as for r in similarity.dereplicate(df, "grp", "id", similarity.ClusterParams(sketch_size=SIZE, copies=0.2)).collect()}
    near = _pairs(by_group, 0.2)
    for g, of in by_group.items():
        least: dict[tuple, str] = {}
        kept: dict[str, str] = {}
        for k in sorted(of):
            rep = least.setdefault(tuple(of[k]), k) if of[k] else k
            kept[k] = kept[rep] if rep != k else min((a for (h, a, b) in near if h == g and b == k and kept[a] == a), default=k)
            assert got[(g, k)] == kept[k]


def _plasmids(spark, folder, rows):
    spark.createDataFrame(rows, "accession string, host_taxid string, sequence string").write.parquet(f"{folder}/plasmid_records.parquet")
    return str(folder)


def test_genome_components_tie_equal_sketches(spark, tmp_path):
    import duckdb

    rng = random.Random(11)
    seqs = ["".join(rng.choice("ACGT") for _ in range(80)) for _ in range(3)]
    d = _plasmids(spark, tmp_path, [("p1", "7", seqs[0]), ("p2", "7", seqs[0]), ("p3", "7", seqs[1]), ("p4", "7", seqs[1][:70]), ("p5", "7", seqs[1]), ("p6", "7", seqs[2]), ("p7", "8", seqs[0])])
    got = {(r.taxid, r.component, r.n) for r in Q.genome_components(spark, d).collect()}
    assert got == {("7", "p1", 2), ("7", "p3", 3), ("7", "p6", 1), ("8", "p7", 1)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW plasmid_records AS FROM read_parquet('{d}/plasmid_records.parquet/*.parquet')")
    assert set(con.execute(f"SELECT taxid, component, n FROM ({Q.ORACLE['genome_components']})").fetchall()) == got


def test_genome_clusters_have_no_bound(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(similarity, "cluster_genomes", lambda df, group, key, p: seen.append(p) or df.select(group, key, F.col(key).alias("cluster"), F.lit(0.0).alias("threshold")))
    Q.genome_clusters(spark, _plasmids(spark, tmp_path, [("p1", "7", "ACGTACGTACGT")]))
    assert seen[0].max_genomes is None
