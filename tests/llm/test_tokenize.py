from __future__ import annotations

import random

import pytest

from sylva.llm import tokenize_corpus as T

RANKS = T.TokenizerParams().ranks


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(RANKS.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def texts():
    rng = random.Random(0)
    alphabet = ["a", "B", "1", " ", "  ", "\n", "\t", "é", "é", "ф", "語", "🧬", "👩‍🔬", "'s", "'LL", " ", " ", "　", "​", "\u0085", "\x1c", "\x00", ".", "_", "<|endoftext|>", "½", "³", "\r\n", "�", "ﬁ"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [*made, "", None, "   ", " a", "a ", "x" * 20000, "ACGT" * 5000, "1" * 3000, " " * 3000, "don't we'll I'm"]


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_ids_equal_the_public_library(spark, block):
    t = texts()
    df = spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS words", "2 AS block")
    got = {r.doc_id: list(r.ids) for r in T.encode_corpus(df.repartition(3), T.TokenizerParams(block_words=block)).collect()}
    assert got == dict(enumerate(reference(t)))


def test_round_trip_and_defined_cases(spark):
    t = texts()
    df = spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string")
    back = {r.doc_id: r.text for r in T.decode_corpus(T.encode_corpus(df)).collect()}
    assert back == {i: x or "" for i, x in enumerate(t)}
    assert T.encode_corpus(df.limit(0)).count() == 0
    twice = T.encode_corpus(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")).collect()
    assert len(twice) == 3 and sum(r.doc_id is None for r in twice) == 1
    nulls = {r.doc_id: list(r.ids) for r in T.encode_corpus(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), T.TokenizerParams(null_ids=(50256,))).collect()}
    assert nulls == {1: [50256], 2: []}
    with pytest.raises(Exception, match="no piece"):
        T.decode_corpus(spark.createDataFrame([(1, [60000])], "doc_id bigint, ids array<int>")).collect()
