from __future__ import annotations

import random

import numpy as np

from sylva.operators import sampling


def test_texts_drawn_for_together_are_as_drawn_for_alone():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ACGTacgtNé😀") for _ in range(rng.choice((0, 1, 9, 11, 15, 50)))) for _ in range(300)]
    texts[5] = None
    keys = np.array([rng.getrandbits(64) - 2**63 for _ in texts])
    for rate in (0.05, 0.3, 1.0):
        assert sampling.substituted_all(texts, rate, keys) == [None if t is None else sampling.substituted(t, rate, int(k)) for t, k in zip(texts, keys, strict=True)]
    assert sampling.substituted("ACGTACGTACGTACGTACGT", 0.1, 9) != "ACGTACGTACGTACGTACGT"
    assert sampling.substituted_all([], 0.5, np.array([], np.int64)) == []


def test_augmentation_draws_samples_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    rows = [("h", s, i, f"q{i}", 0, "ACGTACGTACGTACGTACGT") for i in range(4) for s in ("train", "val", "test")]
    df = spark.createDataFrame(rows, "head string, split string, class_idx int, header_id string, i int, seq string")
    got = sampling.augment_train(df.mapInArrow(count, df.schema), 0.05).collect()
    assert calls.value == len(rows) and len(got) == 16
    for s, n, other in (("train", 8, 4), ("val", 4, 0), ("test", 4, 0)):
        assert len([r for r in got if r.split == s]) == n and len([r for r in got if r.split == s and r.seq != rows[0][5]]) == other
