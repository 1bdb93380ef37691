from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from sylva.llm import leakage as L


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 300):
        seq = rng.integers(1, 4, n).astype(np.int32)
        order = L.suffix_array(seq, max(n, 1))
        s = seq.tolist()
        assert [s[i:] for i in order] == sorted(s[i:] for i in range(n))


def test_suffix_array_sorts_words_up_to_separators():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        seq = np.where(rng.random(n := int(rng.integers(1, 40))) < 0.25, 0, rng.integers(1, 4, n)).astype(np.int32)
        s = [*seq.tolist(), 0]
        words = {i: s[i : s.index(0, i)][:13] for i in range(n) if s[i]}
        order = [words[i] for i in L.suffix_array(seq, 13) if s[i]]
        assert order == sorted(words.values())


def test_words():
    assert L.words_of("A_b-C1 É½x ΟΔΟΣ İźy") == ["a", "b", "c1", "é½x", "οδοσ", "i̇z".replace("̇", "̇"), "y"]


def brute(docs, items, m):
    idx = {}
    for i, t in items:
        w = L.words_of(t or "")
        for j in range(len(w) - m + 1):
            idx.setdefault(tuple(w[j : j + m]), set()).add(i)
    out = set()
    for d, t in docs:
        w = L.words_of(t or "")
        for j in range(len(w) - m + 1):
            out |= {(d, i) for i in idx.get(tuple(w[j : j + m]), ())}
    return out


def test_matches_are_whole_across_groups_of_places():
    passage = " ".join(f"w{i}" for i in range(60))
    tests = L.Tests([(1, passage), (2, "x y z " + passage), (3, "a b " * 10)], 5)
    docs = [np.array([tests.vocabulary.get(w, 0) for w in t.split()], np.int32) for t in [passage + " none " + passage, "none " + passage, "a b " * 30]]
    whole = sorted(L.search(tests, docs, 5))
    assert whole == [(0, 1, 60, 0, 0), (0, 2, 60, 0, 3), (1, 1, 60, 1, 0), (1, 2, 60, 1, 3), (2, 3, 20, 0, 0)]
    for places in (1, 7, 100, 333):
        assert sorted(L.search(tests, docs, 5, places)) == whole


def test_a_repeated_word_keeps_the_longest_match():
    tests = L.Tests([(1, "a " * 2013), (2, "b " + "a " * 500 + "c")], 13)
    a = tests.vocabulary["a"]
    docs = [np.full(5000, a, np.int32), np.array([tests.vocabulary["b"], *[a] * 500, tests.vocabulary["c"]], np.int32)]
    got = {(d, i): n for d, i, n, _, _ in L.search(tests, docs, 13)}
    assert got == {(0, 1): 2013, (0, 2): 500, (1, 1): 500, (1, 2): 502}  # over ten million places


def test_items_beyond_one_pass(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCKS", 2)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(9)]
    docs = [(d, "start " + items[d][1] + " end " + items[(d + 4) % 9][1]) for d in range(9)]
    got = L.longest_matches(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), L.LeakParams(13, block_words=25))
    assert {(r.doc_id, r.item_id, r.n_words) for r in got.collect()} == {(d, i, 20) for d in range(9) for i in (d, (d + 4) % 9)}


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "gamma", "δ", "42", "x"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randint(0, 40))) for i in range(30)] + [(90, None), (91, ""), (92, "Alpha beta")]
    items += [(93, items[0][1] + " beta " + items[1][1]), (94, items[0][1])]
    docs = []
    for d in range(120):
        t = say(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, len(w))
            t += "; ".join(["", ", ".join(w[a : a + rng.randint(0, 30)]).upper(), say(3)])
        docs.append((d, t))
    docs += [(500, None), (501, ""), (502, "word " * 5000 + " ".join(["beta"] * 13))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1))
    it = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    for m, shard, block in ((5, 8_000_000, 2_000_000), (3, 500, 60), (8, 2000, 100)):
        got = L.longest_matches(df, it, L.LeakParams(m, shard, block)).collect()
        assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items, m)
        texts, tests = dict(docs), dict(items)
        for r in got:
            a, b = L.words_of(texts[r.doc_id]), L.words_of(tests[r.item_id])
            assert a[r.doc_from : r.doc_from + r.n_words] == b[r.item_from : r.item_from + r.n_words]
            longest = max(k for i in range(len(b)) for k in [0, *range(r.n_words, len(b) - i + 1)] if k == 0 or any(a[j : j + k] == b[i : i + k] for j in range(len(a) - k + 1)))
            assert r.n_words == longest
    assert L.longest_matches(df.limit(0), it).count() == 0 == L.longest_matches(df, it.limit(0)).count()
    clean = L.without_leaks(df, L.longest_matches(df, it, L.LeakParams(5)))
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in brute(docs, items, 5)}
