"""Evaluation texts inside training text, by suffix arrays over shards of the corpus.

A task turns some megabytes of documents into one sequence of word numbers and sorts its suffixes (prefix doubling). Words that occur in no
test item can't be part of a match, so they only separate runs, and runs shorter than the minimum are left out: what is sorted
is the part of the shard that could match at all. Every suffix of every test item is then binary-searched in each shard; the
range of suffixes that share its first words gives all places, and neighbouring places on one diagonal join to the longest verbatim
matches. Shards are independent, so nothing is shuffled but the longest match of each document and item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.session import written

_WORD = re.compile(r"[^\W_]+")
#: So many places of matches are worked off at a time, and so many blocks of test items searched in one pass.
PLACES = 4_000_000
BLOCKS = 8


@dataclass(frozen=True)
class LeakParams:
    """``min_words`` consecutive words make a match; a shard holds about ``shard_chars``; test items go to tasks in blocks of ``block_words``."""

    min_words: int = 13
    shard_chars: int = 8_000_000
    block_words: int = 2_000_000


def words_of(text: str) -> list[str]:
    """Maximal runs of Unicode letters and digits, in lower case; the two small sigmas count as one letter."""
    if "İ" in text:  # the only letter whose lower case isn't all letters
        return [w.lower().replace("ς", "σ") for w in _WORD.findall(text)]
    return _WORD.findall(text.lower().replace("ς", "σ"))


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``seq`` in the order of their suffixes, compared over ``depth`` words; past the end counts 0, the separator."""
    n = len(seq)
    rank = seq.astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        far = np.zeros(n, np.int64)
        if k < n:
            far[: n - k] = rank[k:]
        key = rank * (int(rank.max(initial=0)) + 1) + far
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]])) if n else 0
        separators = seq == 0  # their keys are the least, so the numbers above theirs count the distinct keys of words
        words = int(new.max(initial=0)) - int(new[separators].max(initial=0))
        new[separators] = 0
        if words == n - int(separators.sum()):
            return order
        rank, k = new, k * 2
    return order


class Tests:
    """Word numbers of the test items of a block, end to end."""

    def __init__(self, items: Sequence[tuple[int, str]], min_words: int) -> None:
        self.vocabulary: dict[str, int] = {}
        ids, item, place = [], [], []
        self.longest = 0
        for item_id, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words_of(text or "")]
            if len(w) < min_words:
                continue
            self.longest = max(self.longest, len(w))
            ids += [*w, *[0] * min_words]
            item += [item_id] * (len(w) + min_words)
            place += [*range(len(w)), *[-1] * min_words]
        self.ids, self.item, self.place = np.array(ids, np.int32), np.array(item, np.int64), np.array(place, np.int64)
        starts = np.flatnonzero(self.ids)
        self.starts = starts[self.ids[starts + min_words - 1] > 0] if len(starts) else starts
        self.starts = self.starts[self.place[self.starts + min_words - 1] == self.place[self.starts] + min_words - 1] if len(self.starts) else self.starts


def search(tests: Tests, docs: list[np.ndarray], m: int, places: int = PLACES) -> list[tuple[int, int, int, int, int]]:
    """``(doc, item_id, n_words, doc_from, item_from)``: the longest match of at least ``m`` words of each document with each item; doc counts within ``docs``.

    Places are worked off in the order of the tests, ``places`` at a time (a test place with more of them alone): what may go on in the next group stays open, of the
    rest the longest are kept. So what is held is bounded by the shard, however often it repeats a passage.
    """
    if not len(tests.starts) or not docs:
        return []
    lengths = np.array([len(d) for d in docs])
    whole = np.concatenate([np.append(d, 0) for d in docs]).astype(np.int32)
    doc_start = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    zero = np.flatnonzero(whole == 0)
    run = np.diff(np.concatenate([[-1], zero])) - 1  # words before each zero
    keep_run = run >= m
    if not keep_run.any():
        return []
    mask = np.repeat(keep_run, run + 1)
    at = np.flatnonzero(mask)  # compact place -> place in the shard
    seq = whole[at]
    sa = suffix_array(seq, max(m, tests.longest))
    grams = np.lib.stride_tricks.sliding_window_view(np.concatenate([seq, np.zeros(m, np.int32)]), m)
    can = np.ones(len(sa), bool)
    can &= (grams[sa] > 0).all(axis=1)
    sa = sa[can]  # suffixes of at least m words, still in order
    if not len(sa):
        return []
    test_grams = np.lib.stride_tricks.sliding_window_view(np.concatenate([tests.ids, np.zeros(m, np.int32)]), m)[tests.starts]

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(test_grams), np.int64), np.full(len(test_grams), len(sa), np.int64)
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(sa) - 1)
            there = grams[sa[mid]]
            differs = there != test_grams
            first = differs.argmax(axis=1)
            rows = np.arange(len(mid))
            a, b = there[rows, first], test_grams[rows, first]
            right = (a < b) | ((a == b) & upper)
            still = lo < hi
            lo = np.where(still & right, mid + 1, lo)
            hi = np.where(still & ~right, mid, hi)
        return lo

    low, high = bound(False), bound(True)
    n = high - low
    some = np.flatnonzero(n)
    closed: list[np.ndarray] = []  # columns: document, item, words, place in the document, place in the item
    open_ = np.zeros((3, 0), np.int64)  # stretches that the next group may go on with: place, test place, length
    groups = np.split(some, np.searchsorted(np.cumsum(n[some]), np.arange(places, int(n.sum()) + 1, places))) if len(some) else []
    for g in groups:
        if not len(g):
            continue
        c = n[g]
        ends = np.cumsum(c)
        inside = np.arange(int(ends[-1])) - np.repeat(ends - c, c) + np.repeat(low[g], c)
        p, q, size = at[sa[inside]], np.repeat(tests.starts[g], c), np.ones(int(ends[-1]), np.int64)
        p, q, size = _joined(*(np.concatenate(x) for x in zip((p, q, size), open_, strict=True)))
        goes_on = q + size == tests.starts[g[-1]] + 1
        open_ = np.stack([p[goes_on], q[goes_on], size[goes_on]])
        closed = [_longest([*closed, _rows(tests, doc_start, p[~goes_on], q[~goes_on], size[~goes_on] + m - 1)])]
    best = _longest([*closed, _rows(tests, doc_start, open_[0], open_[1], open_[2] + m - 1)])
    return list(map(tuple, best.tolist()))


def _joined(p: np.ndarray, q: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches that follow each other on one diagonal become one."""
    order = np.lexsort((q, q - p))
    p, q, size = p[order], q[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1] + size[:-1]) | (p[1:] != p[:-1] + size[:-1])]))
    return p[first], q[first], np.add.reduceat(size, first)


def _rows(tests: Tests, doc_start: np.ndarray, p: np.ndarray, q: np.ndarray, words: np.ndarray) -> np.ndarray:
    d = np.searchsorted(doc_start, p, side="right") - 1
    return np.stack([d, tests.item[q], words, p - doc_start[d], tests.place[q]], axis=1)


def _longest(found: list[np.ndarray]) -> np.ndarray:
    """The longest of each document's matches with each item; ties take the first place in the document, then in the item."""
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 4], rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)])] if len(rows) else rows


def _shards(blocks: list[list[tuple[int, str]]], params: LeakParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # each block has its own numbers; tests are few, so they are numbered anew in each task
        tests = [Tests(b, params.min_words) for b in blocks]
        ids: list[int | None] = []
        docs: list[list[np.ndarray]] = [[] for _ in tests]
        held = 0

        def found() -> Iterator[pa.RecordBatch]:
            for t, d in zip(tests, docs, strict=True):
                rows = search(t, d, params.min_words)
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in cols[0]], pa.int64()), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["doc_id", "item_id", "n_words", "doc_from", "item_from"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                w = words_of(text)
                if len(w) < params.min_words:
                    continue
                ids.append(doc_id)
                for t, d in zip(tests, docs, strict=True):
                    d.append(np.fromiter(map(t.vocabulary.get, w, _ZEROS), np.int32, len(w)))
                held += len(text)
                if held >= params.shard_chars:
                    yield from found()
                    ids, docs, held = [], [[] for _ in tests], 0
        yield from found()

    return run


class _Zeros:
    """Endless zeros, the default of every lookup."""

    def __iter__(self) -> _Zeros:
        return self

    def __next__(self) -> int:
        return 0


_ZEROS = _Zeros()


def longest_matches(documents: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_words, doc_from, item_from``: the longest match of each document with each item it leaks, places counted in words.

    Ties take the first place in the document. Null and short texts and items match nothing; rows that share a doc_id count as one document.
    Items are read by the driver ``BLOCKS`` blocks of ``block_words`` words at a time; these are searched in one pass over the corpus, whose matches are
    written before the next items are read. So what the driver and a task hold of the items is bounded (a longer item is a block of its own),
    and usual test suites take one pass. Columns besides those named are ignored.
    """
    source = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, item_id bigint, n_words bigint, doc_from bigint, item_from bigint"
    search_in = lambda blocks: source.mapInArrow(_shards(blocks, params), schema)
    done: list[DataFrame] = []
    blocks: list[list[tuple[int, str]]] = [[]]
    words = 0
    for row in items.where("text is not null and item_id is not null").select("item_id", "text").toLocalIterator():
        n = len(words_of(row["text"]))
        if n < params.min_words:
            continue
        if words and words + n > params.block_words:
            if len(blocks) == BLOCKS:
                done.append(written(search_in(blocks)))
                blocks = []
            blocks.append([])
            words = 0
        words += n
        blocks[-1].append((row["item_id"], row["text"]))
    found = reduce(DataFrame.unionByName, [*done, search_in(blocks)])
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", (-F.col("doc_from")).alias("d"), (-F.col("item_from")).alias("i"))).alias("b"))
    return best.select("doc_id", "item_id", "b.n_words", (-F.col("b.d")).alias("doc_from"), (-F.col("b.i")).alias("item_from"))


def without_leaks(documents: DataFrame, matches: DataFrame) -> DataFrame:
    """``documents`` without those that hold a match; rows without a doc_id stay."""
    return documents.join(matches.select(F.col("doc_id").alias("__leaked")).distinct(), F.col("doc_id") == F.col("__leaked"), "left_anti")
