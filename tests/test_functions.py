from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from sylva.functions import ids, ranks, sequence, sketch
from sylva.functions.text import accession_key, rank_key, strip_white, taxid_number


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_taxid_is_the_number_written_in_it(spark):
    rows = [(x,) for x in ("42", " 42\t", "taxon:042", "TAXON: 42", "txid42", " 42", "unknown", "", None, "0", "9" * 30)]
    got = [r[0] for r in one(spark, "t string", rows, taxid_number("t"))]
    assert got == [42] * 6 + [None, None, None, 0, None]


def test_accession_and_rank_keys(spark):
    got = one(spark, "a string", [(" NZ_PL1.12\n",), ("nz_pl1",), ("",), (None,), ("GCF_1.x",)], accession_key("a"))
    assert [g[0] for g in got] == ["nz_pl1", "nz_pl1", None, None, "gcf_1.x"]
    assert [g[0] for g in one(spark, "a string", [(" Order ",), (None,), ("  ",)], rank_key("a"))] == ["order", "unknown", "unknown"]
    assert one(spark, "a string", [(" x y　",)], strip_white("a")) == [("x y",)]


def test_reverse_complement(spark):
    assert one(spark, "s string", [("ATCGY",), ("aX",), ("",), (None,)], sequence.reverse_complement("s")) == [("RCGAT",), ("NT",), ("",), (None,)]


def test_windows_and_chunks_cover_each_window_once(spark):
    s = "ACGTACGTTT"
    df = spark.createDataFrame([(s,), ("AC",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(sequence.windows("s", 3)).collect()] == [[s[i : i + 3] for i in range(8)], [], [], []]
    for size in (1, 2, 3, 7, 8, 100):
        got = df.limit(1).select(F.explode(sequence.chunks("s", 3, size)).alias("c")).select(F.explode(sequence.windows("c", 3)).alias("w")).collect()
        assert [r.w for r in got] == [s[i : i + 3] for i in range(8)]


def test_scalars(spark):
    got = one(spark, "s string", [("GGCA",), ("",), (None,), ("NNNN",)], sequence.gc_fraction("s"), sequence.is_pure("s"), sequence.leaf_weight(F.length("s"), 3), sequence.percent_slice("s", F.lit(0.25), F.lit(0.75)))
    assert got == [(0.75, True, 2, "GC"), (None, False, 0, ""), (None, False, 0, None), (0.0, False, 2, "NN")]
    with pytest.raises(ValueError):
        sequence.kmer_vocabulary(spark, 9)
    assert sequence.kmer_vocabulary(spark, 2).count() == 16


def test_virtual_id_vector(spark):
    assert one(spark, "p string", [("10239",)], ids.virtual_id("p", F.lit("low_capacity"))) == [("9233730516624028",)]


def test_ranks(spark):
    rows = [("species",), ("superkingdom",), ("clade",), (None,), ("virtual_x",), ("realm_group",)]
    got = one(spark, "r string", rows, ranks.rank_depth("r"), ranks.at_or_below("r", "species"), ranks.below("r", "genus"), ranks.is_protected("r"), ranks.ends_recursion("r"))
    assert got == [(7, True, True, False, False), (0, False, False, False, False), (None, False, False, False, False), (None, False, False, False, False), (None, False, False, True, True), (None, False, False, True, False)]
    with pytest.raises(ValueError):
        ranks.below("r", "clade")


def test_bottom_k_equals_brute_force(spark):
    import random

    rng = random.Random(1)
    seqs = {f"g{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate((500, 21, 20, 0, 300))}
    df = spark.createDataFrame([*seqs.items(), ("none", None)], "id string, s string")
    got = {r["id"]: r["sketch"] for r in sketch.bottom_k(df, ["id"], "s", 21, 50).collect()}
    for k, s in seqs.items():
        assert got[k] == sorted({zlib.crc32(s[i : i + 21].encode()) for i in range(len(s) - 20)})[:50]
    assert got["none"] == []


def test_jaccard_and_ani(spark):
    rows = [([1, 2, 3], [2, 3, 4]), ([], [1]), ([1], [1])]
    got = [r[0] for r in one(spark, "a array<bigint>, b array<bigint>", rows, sketch.jaccard("a", "b", 3))]
    assert got == [pytest.approx(2 / 3), 0.0, 1.0]
    ani = one(spark, "j double", [(0.0,), (1.0,), (0.5,)], sketch.ani_proxy("j", 21), sketch.ani_bin(sketch.ani_proxy("j", 21)))
    assert ani[0] == (0.0, "ANI<85%") and ani[1] == (1.0, "ANI>=95%") and 0.97 < ani[2][0] < 1
