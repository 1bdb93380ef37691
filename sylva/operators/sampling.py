"""Windows drawn from sequences: deterministic by hash, so every run and every retry of a task gives the same windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.functions.sequence import COMPLEMENT, IUPAC, percent_slice


@dataclass(frozen=True)
class DrawParams:
    min_len: int
    max_len: int
    seed: int = 42

    def __post_init__(self) -> None:
        if self.min_len <= 0:
            raise ValueError("min_len must be positive")
        if self.min_len > self.max_len:
            raise ValueError("min_len must not exceed max_len")


def strategy(length: Column | str, n: Column | str, p: DrawParams) -> Column:
    """Name of the law by which n windows are drawn from a sequence: null if it is too short or n not positive."""
    length, n = (F.col(x) if isinstance(x, str) else x for x in (length, n))
    full = n * p.max_len
    return (
        F.when((length < p.min_len) | (n <= 0), F.lit(None).cast("string"))
        .when(length >= 2 * full, "non_overlapping")
        .when((length >= full) & (F.floor(length / p.max_len) - n <= 0), "contiguous")
        .when(length >= full, "flanked")
        .otherwise("bounded_random")
    )


def _draw(p: DrawParams, what: str, *ids: Column) -> Column:
    return F.xxhash64(F.lit(p.seed), F.lit(what), *ids)


def window_length(p: DrawParams, available: Column, *ids: Column) -> Column:
    """Uniform in [min_len, min(max_len, available)] in every law, so lengths tell nothing about the class."""
    top = F.least(F.lit(p.max_len), available)
    return F.when(top <= p.min_len, top).otherwise(F.lit(p.min_len) + F.pmod(_draw(p, "length", *ids), top - F.lit(p.min_len - 1))).cast("int")


def placed_window(p: DrawParams, law: Column, length: Column, n: Column, i: Column, task_id: Column) -> Column:
    """``STRUCT<start, len>`` of window ``i`` of a tiled task, start counted from 0.

    * non_overlapping: one window in each of n equal slots, at a hashed place.
    * flanked: pairs from both ends inwards, with even spacing; an odd one in the middle.
    * contiguous: blocks of max_len one after the other.
    """
    slot = F.floor(length / n).cast("int")
    step = F.lit(p.max_len) + F.greatest(F.lit(0), F.floor((length - n * p.max_len) / (n + 1)).cast("int"))
    pair = F.floor(i / 2).cast("int")
    middle = (law == "flanked") & (n % 2 == 1) & (i == n - 1)
    base = F.when(law == "contiguous", i * p.max_len).when(middle, F.lit(0)).when(i % 2 == 0, pair * step).otherwise(length - p.max_len - pair * step)
    available = F.when(law == "non_overlapping", slot).otherwise(length - base)
    size = window_length(p, available.cast("int"), task_id, i)
    in_slot = i * slot + F.pmod(_draw(p, "start", task_id, i), F.greatest(slot - size + 1, F.lit(1)))
    centre = F.least(F.greatest(F.lit(0), F.floor(length / 2).cast("int") - F.floor(size / 2).cast("int")), length - size)
    start = F.when(law == "non_overlapping", in_slot).when(middle, centre).otherwise(base)
    return F.struct(start.cast("int").alias("start"), size.alias("len"))


#: Windows of a tiled task that are cut in one row: what a row holds is bounded, whatever the task's budget.
BLOCK = 2048
#: A short sequence with no more than this many windows for each wanted has all of them listed; of others, as many are drawn.
TRIES = 50
_COMPLEMENT = str.maketrans(IUPAC, COMPLEMENT)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer over whole arrays (the finaliser of a public counter-based generator)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _numbers(key: int, what: int, n: int, first: int = 0) -> np.ndarray:
    """n 64-bit numbers of the stream ``what`` of a key, from number ``first`` on; the same for the same key, whatever the run."""
    salt = _mixed(np.array([(key & 0xFFFFFFFFFFFFFFFF) ^ (what << 56)], np.uint64))[0]
    with np.errstate(over="ignore"):
        return _mixed(np.arange(first, first + n, dtype=np.uint64) + salt)


def _candidates(length: int, n: int, p: DrawParams, key: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, end)`` of windows in the order in which draws with repeats left out would meet them: a length first, all alike, then a place.

    Where a sequence holds few windows all are listed, each with its place in a race whose rates are the chances of being drawn; so an exhausted sequence
    costs no more than its windows. Otherwise at most ``TRIES`` x n are drawn, of which a fiftieth are repeats at most.
    """
    sizes = np.arange(p.min_len, min(p.max_len, length) + 1)
    places = length - sizes + 1
    total = int(places.sum())
    if total <= TRIES * n:
        size = np.repeat(sizes, places)
        start = np.arange(total) - np.repeat(np.cumsum(places) - places, places)
        race = -np.log((_numbers(key, 1, total) + 1.0) / 2.0**64) * np.repeat(places, places)
        order = np.argsort(race, kind="stable")
        return start[order], (start + size)[order]
    some = 2 * n + 64
    size = sizes[(_numbers(key, 1, some) % np.uint64(len(sizes))).astype(np.int64)]
    start = (_numbers(key, 2, some) % (length - size + 1).astype(np.uint64)).astype(np.int64)
    return start, start + size


def unique_windows(seq: str, n: int, p: DrawParams, key: int) -> list[str]:
    """n different windows at random places, each followed by its reverse complement as long as windows are wanted; fewer only of a sequence that holds no more."""
    other = "".join([c if c in IUPAC else "N" for c in seq])[::-1].translate(_COMPLEMENT)
    made: dict[str, None] = {}
    length = len(seq)
    start, end = _candidates(length, n, p, key)
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        made[seq[a:b]] = None
        if len(made) < n:
            made[other[length - b : length - a]] = None
        if len(made) >= n:
            break
    return list(made)


def extract(tasks: DataFrame, sequences: DataFrame, p: DrawParams) -> DataFrame:
    """``tasks(head, split, class_idx, header_id, n, start_pct, end_pct)`` joined with ``sequences(header_id, seq)`` to samples ``head, split, class_idx, header_id, i, seq``.

    Sequences are read in upper case; tasks without a sequence or with too short a slice give none. The tiled laws give exactly n windows, equal
    ones too if the sequence repeats itself; bounded_random gives n different ones, fewer only where the slice is exhausted.
    All windows of a block of a task are cut in one array, so a sequence isn't copied for each window.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(BLOCK)).cast("int"))
    t = tasks.where("n > 0").withColumn("__b", F.explode(blocks))
    j = t.join(sequences.select("header_id", F.upper("seq").alias("__s")), "header_id")
    j = j.withColumn("__s", percent_slice("__s", F.col("start_pct"), F.col("end_pct"))).withColumn("__l", F.length("__s")).withColumn("__n", F.col("n").cast("int"))
    j = j.withColumn("__t", F.concat_ws("|", "head", "split", F.col("class_idx").cast("string"), "header_id", F.col("start_pct").cast("string")))
    j = j.withColumn("__w", strategy("__l", "n", p)).where(F.col("__w").isNotNull() & ((F.col("__w") != "bounded_random") | (F.col("__b") == 0)))

    @F.pandas_udf("array<string>")
    def short(seq: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else unique_windows(s, int(m), p, int(k)) for s, m, k in zip(seq, n, key, strict=True)], dtype=object)

    def cut(i: Column) -> Column:
        w = placed_window(p, F.col("__w"), F.col("__l"), F.col("__n"), i, F.col("__t"))
        return F.substr("__s", w["start"] + 1, w["len"])

    first = F.col("__b") * BLOCK
    tiled = F.transform(F.sequence(first, F.least(F.col("__n"), first + BLOCK) - 1), cut)
    j = j.withColumn("__r", short(F.when(F.col("__w") == "bounded_random", F.col("__s")), F.col("n"), _draw(p, "short", F.col("__t"))))
    ids = ["head", "split", "class_idx", "header_id", "__b"]
    out = j.select(*ids, F.posexplode(F.when(F.col("__w") == "bounded_random", F.col("__r")).otherwise(tiled)).alias("__i", "seq"))
    return out.select(*ids[:-1], (F.col("__b") * BLOCK + F.col("__i")).alias("i"), "seq")


_BASES = "ACGT"


def _codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Characters of a text as numbers, and the place of each in the alphabet of bases, -1 for others; both letter cases count."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = np.full(128, -1, np.int64)
    for i, b in enumerate(_BASES):
        places[[ord(b), ord(b.lower())]] = i
    return chars, np.where(chars < 128, places[np.minimum(chars, 127)], -1)


def _text(chars: np.ndarray) -> str:
    return chars.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def _another(chars: np.ndarray, codes: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """One of the three other bases for each base, in the letter case of the old one."""
    bases = np.array([ord(b) for b in _BASES], np.uint32)
    return bases[(codes + 1 + (draw % np.uint64(3)).astype(np.int64)) % 4] | (chars & np.uint32(0x20))


def substituted(text: str, rate: float, key: int) -> str:
    return substituted_all([text], rate, np.array([key]))[0]


def substituted_all(texts: list[str | None], rate: float, keys: np.ndarray) -> list[str | None]:
    """Of each text round(length x rate) places, drawn without repeats by its key; bases there become one of the three others, other letters stay.

    Texts of one length are drawn for together: short ones cost more in calls than in work otherwise.
    """
    lengths = np.array([0 if t is None else len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    chars, codes = _codes("".join([t for t in texts if t is not None]))
    out = chars.copy()
    keys = keys.astype(np.int64).view(np.uint64)
    one, two = (_mixed(keys ^ np.uint64(what << 56)) for what in (1, 2))
    for length in np.unique(lengths).tolist():
        k = min(length, round(length * rate))
        if k <= 0:
            continue
        rows = np.flatnonzero(lengths == length)
        with np.errstate(over="ignore"):
            draw = _mixed(np.arange(length, dtype=np.uint64) + one[rows, None])
            place = np.argmin(draw, axis=1)[:, None] if k == 1 else np.argsort(draw, axis=1, kind="stable")[:, :k]
            other = _mixed(place.astype(np.uint64) + two[rows, None]).ravel()
        at = (ends[rows] - length)[:, None] + place
        at = at.ravel()
        base = codes[at] >= 0
        at, other = at[base], other[base]
        out[at] = _another(chars[at], codes[at], other)
    made = _text(out)
    return [None if t is None else made[e - n : e] for t, e, n in zip(texts, ends.tolist(), lengths.tolist(), strict=True)]


def substitute(seq: Column | str, rate: float, seed: int, *ids: Column) -> Column:
    """A copy in which round(length x ``rate``) places hold another base; letters besides A, C, G, T stay. Null stays null; ``ids`` seed a row's draw."""
    s = F.col(seq) if isinstance(seq, str) else seq
    if rate <= 0:
        return s

    @F.pandas_udf("string")
    def change(text: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(substituted_all([t if isinstance(t, str) else None for t in text], rate, key.to_numpy()), dtype=object)

    return change(s, F.xxhash64(F.lit(seed), F.lit("sub"), *ids))


def augment_train(samples: DataFrame, rate: float, seed: int = 42) -> DataFrame:
    """Training samples once more with substitutions, appended; other splits stay as they are. Samples are drawn once."""
    if rate <= 0:
        return samples.unionByName(samples.where("split = 'train'"))
    train = F.coalesce(F.col("split") == "train", F.lit(False))
    other = substitute(F.when(train, F.col("seq")), rate, seed, F.col("head"), F.col("header_id"), F.col("i"))
    both = samples.withColumn("__o", other).withColumn("__s", F.explode(F.when(train, F.array("seq", "__o")).otherwise(F.array("seq"))))
    return both.withColumn("seq", F.col("__s")).drop("__o", "__s")


@dataclass(frozen=True)
class ErrorModel:
    """Published rates per base of a long read; insertions and deletions are ``homopolymer_boost`` times as likely where a base repeats the one before it."""

    substitution: float = 0.01
    insertion: float = 0.02
    deletion: float = 0.02
    homopolymer_boost: float = 2.0


def with_errors(text: str, model: ErrorModel, key: int) -> str:
    """A read with errors, drawn for all its bases at once: what is kept, what it is read as, and what is read behind it."""
    if not text:
        return ""
    chars, codes = _codes(text)
    n = len(chars)
    chance = lambda what: _numbers(key, what, n) / 2.0**64
    boost = np.where(np.concatenate([[False], chars[1:] == chars[:-1]]), model.homopolymer_boost, 1.0)
    kept = chance(1) >= model.deletion * boost
    wrong = (codes >= 0) & (chance(2) < model.substitution)
    two = np.empty((n, 2), np.uint32)
    two[:, 0] = np.where(wrong, _another(chars, codes, _numbers(key, 3, n)), chars)
    two[:, 1] = np.array([ord(b) for b in _BASES], np.uint32)[(_numbers(key, 5, n) >> np.uint64(62)).astype(np.int64)]
    return _text(two[np.stack([kept, kept & (chance(4) < model.insertion * boost)], axis=1)])


def noisy_reads(reads: DataFrame, model: ErrorModel, seed: int = 42) -> DataFrame:
    """``reads(read_id, seq)`` with errors, the same in every run; a null read is empty. Letters besides A, C, G, T are never substituted."""

    @F.pandas_udf("string")
    def change(text: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([with_errors(t or "", model, int(k)) for t, k in zip(text, key, strict=True)], dtype=object)

    return reads.select("read_id", change("seq", F.xxhash64(F.lit(seed), F.lit("read"), "read_id")).alias("seq"))
