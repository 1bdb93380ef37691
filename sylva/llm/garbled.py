"""Text that was decoded in another encoding than it had been written in: found by near-twins, restored by learned mappings.

1. The corpus is read as its distinct non-ASCII chunks (digits folded) with their counts. A chunk stripped of its non-ASCII characters is
   the key on which garbled chunks meet their clean near-twins: the most frequent chunk of a key stands for the clean
   text, every other is aligned with it, run by run. Chunks without ASCII letters meet their twins by their restored form.
2. A transformation is a pair (written in, read as), or two or three pairs after each other. Those that explain aligned runs, each character
   of them, are learned; the fewest that explain all explained runs are kept. They are a few dozen at most. Two garbled readings of one text
   also meet, so a garbled run asks for one transformation only, whatever it met. Aligned characters that no pair of
   known encodings explains teach a table of their own: what each clean character was turned into (``character_table``).
3. Counts of character pairs, folded to a sketch of fixed size, say how usual a run is between its neighbours.
4. In every document the learned transformations are undone run by run. A passage (neighbouring runs) is garbled where undoing one
   transformation makes it so much more usual that the summed gain passes the threshold of that kind of transformation.
   Signs that only a lossy decoding leaves (U+FFFD, or a question mark inside a word whose twin has a letter there) count as well.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.operators.hot_join import hot_join, hot_keys
from sylva.session import written

#: Python's names of the encodings that transformations are made of; MULTI are those of several bytes a character.
SINGLE = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp437", "cp850", "cp852", "cp866", "koi8-r", "mac-roman", "mac-cyrillic", "iso8859-2", "iso8859-5", "iso8859-7", "iso8859-15", "cp737", "cp1257")
MULTI = ("utf-8", "cp932", "euc-jp", "gbk", "big5", "euc-kr")
#: Readings of UTF-8 that are tried twice and, each with itself, three times over.
TWICE = ("cp1252", "latin-1", "mac-roman", "cp437", "cp850", "cp1251")

_CHUNK = re.compile(r"[\x21-\x7e]*[^\x00-\x7f][^\x00-\x20\x7f]*")
_RUN = re.compile(r"[^\x00-\x7f]+")
_UNIT = re.compile(r"([\x00-\x7f]?)([^\x00-\x7f]+)(?=([\x00-\x7f]?))")
_WORDED = re.compile(r"[A-Za-z0-9]")
#: A word with a question mark inside.
LOST = r"\p{L}+\?\p{Ll}+"
CHUNK = r"[\x21-\x7e]*[^\x00-\x7f][^\x00-\x20\x7f]*"
BUCKETS = 1 << 18
#: What lossy decoders leave.
LOST_SIGN = "\ufffd"


@dataclass(frozen=True)
class GarbleParams:
    """``min_runs`` distinct aligned runs make a transformation known. Gains are natural logarithms of how much more usual a run becomes.

    ``utf8_gain`` holds for UTF-8 read as something else, whose byte pattern hardly occurs by chance; ``other_gain`` for the rest,
    which also need ``other_units`` different runs, or one run that alone gains ``single_gain``: what it becomes is then far more usual
    between its neighbours in the whole corpus. Repeats of a run with a smaller gain add nothing: usual text repeats as well.

    A character table takes characters that ``table_twins`` twins agree on, needs ``table_chars`` of them and holds the ``table_rows`` most frequent;
    the ``patterns`` most frequent sets of explaining transformations are looked at. Both are far above what occurs and bound what is learned from.
    """

    min_runs: int = 2
    utf8_gain: float = 1.5
    other_gain: float = 6.0
    other_units: int = 2
    single_gain: float = 3.0
    table_twins: int = 2
    table_chars: int = 3
    table_rows: int = 4096
    patterns: int = 10_000
    worst: float = -4.0
    best: float = 5.0


@lru_cache(maxsize=None)
def _tables(codec: str) -> tuple[list[str], dict[str, int]]:
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            chars.append(chr(b))  # readers leave undefined bytes as control characters
    return chars, {c: b for b, c in reversed(list(enumerate(chars)))}


def to_bytes(text: str, codec: str, lossy: bool = False) -> bytes | None:
    if codec in SINGLE:
        table = _tables(codec)[1]
        try:
            return bytes([table[c] for c in text])
        except KeyError:
            return bytes([table.get(c, 63) for c in text]) if lossy else None
    try:
        return text.encode(codec, "replace" if lossy else "strict")
    except UnicodeEncodeError:
        return None


def to_text(data: bytes, codec: str, lossy: bool = False) -> str | None:
    if codec in SINGLE:
        table = _tables(codec)[0]
        return "".join([table[b] for b in data])
    try:
        return data.decode(codec, "replace" if lossy else "strict")
    except UnicodeDecodeError:
        return None


Step = tuple  # (written in, read as), or (TABLE, pairs)
Transformation = tuple[Step, ...]


def garble(text: str, t: Transformation, lossy: bool = False) -> str | None:
    for written_in, read_as in t:
        data = to_bytes(text, written_in, lossy)
        if data is None or (text := to_text(data, read_as, lossy)) is None:
            return None
    return text


#: Stands in a step for a table of characters learned by alignment; the other part of the step is the table as sorted pairs.
TABLE = "table"


@lru_cache(maxsize=64)
def _pieces(pairs: tuple[tuple[str, str], ...]) -> tuple[dict[str, str], re.Pattern]:
    turned = dict(pairs)
    return turned, re.compile("|".join(re.escape(x) for x in sorted(turned, key=len, reverse=True)))


def undo(text: str, t: Transformation) -> str | None:
    if t[0][0] == TABLE:  # characters the table doesn't know stay
        turned, pattern = _pieces(t[0][1])
        return pattern.sub(lambda m: turned[m[0]], text)
    for written_in, read_as in reversed(t):
        data = to_bytes(text, read_as)
        if data is None or (text := to_text(data, written_in)) is None:
            return None
    return text


def undo_run(run: str, t: Transformation) -> str | None:
    """As ``undo``. Outside UTF-8 learned runs seldom tell a reading as cp1252 from one as latin-1; control characters, which only latin-1 leaves, are undone as its."""
    r = undo(run, t)
    if r is None and t[0][1] == "cp1252" and t[0][0] != "utf-8" and any("\x80" <= c < "\xa0" for c in run):
        return undo(run, ((t[0][0], "latin-1"),))
    return r


def candidates() -> list[Transformation]:
    every = [*SINGLE, *MULTI]
    single = [((a, b),) for a in every for b in every if a != b and not (a in MULTI[1:] and b in MULTI[1:])]
    return single + [(("utf-8", a), ("utf-8", b)) for a in TWICE for b in TWICE] + [(("utf-8", a),) * 3 for a in TWICE]


def explain(clean: str, bad: str, tried: Sequence[Transformation]) -> list[int]:
    """The transformations that turn ``clean`` into ``bad``."""
    return [i for i, t in enumerate(tried) if garble(clean, t) == bad]


# --- learning ---------------------------------------------------------------------------------------------


def chunk_counts(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``(form, n)``: distinct non-ASCII chunks, digits folded to 0, over all rows."""
    chunks = documents.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(CHUNK), F.lit(0))).alias("c"))
    return chunks.groupBy(F.regexp_replace("c", "[0-9]+", "0").alias("form")).agg(F.count(F.lit(1)).alias("n"))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligned runs of twins: (clean run, other run, number of twins)."""
    for batch in batches:
        pairs: dict[tuple[str, str], int] = {}
        for clean, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if _RUN.split(clean) == _RUN.split(other):
                for p in {(a, b) for a, b in zip(_RUN.findall(clean), _RUN.findall(other), strict=True) if a != b}:
                    pairs[p] = pairs.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["clean", "other", "n"])


def _explained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair with every transformation that explains it; a clean character that none explains, with t = -1, if it was turned into several characters."""
    tried = candidates()
    for batch in batches:
        rows = []
        for a, b, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found = explain(a, b, tried)
            if not found and len(a) == 1 and 2 <= len(b) <= 4 and a not in b and not re.search(r"\s", b):
                found = [-1]
            rows += [(a, b, i, n) for i in found]
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)], names=["clean", "other", "t", "n"])


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that chunks would hold if they were restored: all readings for chunks without ASCII letters or digits, for dense chunks
    those in which bytes of one character also are ASCII letters. They stand beside the run they come from, or beside the whole chunk
    where its ASCII signs are bytes of characters. Clean runs of one or two characters count only if written in UTF-8, whose byte pattern hardly occurs by chance.
    """
    tried = [(i, t) for i, t in enumerate(candidates()) if len(t) == 1]
    wide = [(i, t) for i, t in tried if t[0][0] in MULTI[1:]]
    for batch in batches:
        rows = []
        for form, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for i, t in wide if _WORDED.search(form) else tried:
                r = undo(form, t)
                if r is not None and r != form:
                    met = zip(_RUN.findall(r), _RUN.findall(form), strict=True) if _RUN.split(r) == _RUN.split(form) else ((x, form) for x in _RUN.findall(r))
                    rows += [(x, y, count, i) for x, y in set(met) if x != y and (len(x) > 2 or t[-1][0] == "utf-8" or (len(x) == 2 and x > "\u3000"))]
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int32()), strict=True)], names=["clean", "other", "n", "t"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(x, n) for form, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in _RUN.findall(form)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["clean", "n"])


def twin_runs(forms: DataFrame) -> DataFrame:
    """``(clean, other, t, n)``: aligned runs of chunks and their clean near-twins, with the transformations that explain them, or -1 for none, and the number of twins."""
    keyed = forms.withColumn("key", F.regexp_replace("form", r"[^\x00-\x7f]", ""))
    worded = keyed.where(F.col("key").rlike("[A-Za-z0-9]"))
    best = worded.groupBy("key").agg(F.max(F.struct("n", "form")).alias("best")).select("key", F.col("best.form").alias("clean"), F.col("best.n").alias("clean_n"))
    # short keys have very many forms
    twins = hot_join(worded, best, "key", hot_keys(worded, "key"), "inner").where("form <> clean and clean_n > n").select("clean", F.col("form").alias("other"))
    runs = twins.mapInArrow(_align, "clean string, other string, n bigint").groupBy("clean", "other").agg(F.sum("n").alias("n"))
    by_key = runs.mapInArrow(_explained, "clean string, other string, t int, n bigint")
    rare = keyed.where((F.length("form") > 2) & (~F.col("key").rlike("[A-Za-z0-9]") | (F.length("key") * 2 < F.length("form"))))
    maybe = rare.select("form", "n").mapInArrow(_restored, "clean string, other string, n bigint, t int")
    runs_n = forms.select("form", "n").mapInArrow(_runs, "clean string, n bigint").groupBy("clean").agg(F.sum("n").alias("clean_n"))
    found = maybe.join(runs_n, "clean").where("clean_n > 2 * n")
    return by_key.unionByName(found.select("clean", "other", "t", "n"))


def character_table(rows: DataFrame, params: GarbleParams = GarbleParams()) -> Transformation | None:
    """The characters of unexplained runs that twins agree on, as one transformation; None if they are too few.

    What a character was turned into must stand for that character alone, or it teaches nothing.
    """
    good = rows.where((F.col("t") == -1) & (F.col("n") >= params.table_twins)).groupBy("other").agg(F.max("clean").alias("clean"), F.count_distinct("clean").alias("k"), F.sum("n").alias("n")).where("k = 1")
    pairs = sorted((r["other"], r["clean"]) for r in good.orderBy(F.desc("n"), "other").limit(params.table_rows).collect())
    return ((TABLE, tuple(pairs)),) if len({c for _, c in pairs}) >= params.table_chars else None


def learn(forms: DataFrame, params: GarbleParams = GarbleParams()) -> list[Transformation]:
    """The fewest transformations that explain the explained runs, most telling first.

    Runs that are explained by the same transformations are alike, so only these patterns and their counts reach the driver. A run that
    itself is explained as a garbled reading of UTF-8 teaches nothing as a clean one. A garbled run counts once for all clean runs of one
    length that it met: some of them are other garbled readings of the same text, and what leads to them is known by the true one.
    """
    tried = candidates()
    every = written(twin_runs(forms))
    rows = every.where("t >= 0").select("clean", "other", "t").distinct()
    utf8 = [i for i, t in enumerate(tried) if t[-1][0] == "utf-8"]
    bad = rows.where(F.col("t").isin(utf8)).select(F.col("other").alias("clean")).distinct()
    alike = rows.join(bad, "clean", "left_anti").groupBy("other", F.length("clean")).agg(F.array_sort(F.collect_set("t")).alias("ts")).groupBy("ts").agg(F.count(F.lit(1)).alias("n"))
    left = [(frozenset(r["ts"]), r["n"]) for r in alike.orderBy(F.desc("n"), "ts").limit(params.patterns).collect()]
    chosen: list[Transformation] = []
    while left:
        support: dict[int, int] = {}
        for ts, n in left:
            for t in ts:
                support[t] = support.get(t, 0) + n
        t = max(support, key=lambda t: (support[t], -t))
        if support[t] < params.min_runs:
            break
        chosen.append(tried[t])
        left = [x for x in left if t not in x[0]]
    table = character_table(every, params)
    return chosen + ([table] if table else [])


def _pairs(left: str, run: str, right: str) -> list[bytes]:
    s = left + run + right
    return [s[i : i + 2].encode("utf-8", "surrogatepass") for i in range(len(s) - 1)]


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * BUCKETS, np.int64)
    for batch in batches:
        for form, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = f" {form} "
            for m in _UNIT.finditer(s):
                for p in _pairs(m[1], m[2], m[3]):
                    h = zlib.crc32(p)
                    total[h % BUCKETS] += n
                    total[BUCKETS + zlib.adler32(p, h) % BUCKETS] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])


def sketch(forms: DataFrame) -> np.ndarray:
    """Logarithms of character-pair counts, two rows of ``BUCKETS``: a fixed size, whatever the corpus."""
    rows = forms.mapInArrow(_bucket_counts, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * BUCKETS)
    total[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return np.log(total + 0.3).astype(np.float32)


# --- applying ---------------------------------------------------------------------------------------------


class Judge:
    """Learned transformations and the sketch, with a memory of units already judged."""

    def __init__(self, learned: Sequence[Transformation], logs: np.ndarray, params: GarbleParams) -> None:
        self.learned, self.logs, self.params = list(learned), logs, params
        self.utf8 = np.array([t[-1][0] == "utf-8" for t in self.learned], bool)
        self.dense = [t for t in self.learned if t[0][0] in MULTI[1:]]
        self.memory: dict[tuple[str, str, str], np.ndarray | None] = {}

    def usual(self, left: str, run: str, right: str) -> float:
        total, pairs = 0.0, _pairs(left, run, right)
        for p in pairs:
            h = zlib.crc32(p)
            total += min(self.logs[h % BUCKETS], self.logs[BUCKETS + zlib.adler32(p, h) % BUCKETS])
        return total / max(1, len(pairs))

    def gains(self, left: str, run: str, right: str) -> np.ndarray | None:
        """Per transformation, how much more usual undoing it makes the run; None if that holds for none."""
        key = (left, run, right)
        if key in self.memory:
            return self.memory[key]
        p, here = self.params, None
        out = np.full(len(self.learned), p.worst, np.float32)
        for i, t in enumerate(self.learned):
            r = undo_run(run, t)
            if r is None or r == run:
                continue
            if here is None:
                here = self.usual(left, run, right)
            out[i] = min(p.best, max(p.worst, self.usual(left, r, right) - here))
        found = out if (out > 0).any() else None
        if len(self.memory) > 200_000:
            self.memory.clear()
        self.memory[key] = found
        return found

    def passages(self, text: str) -> list[tuple[int, int, Transformation]]:
        """Garbled stretches ``(from, to, transformation)`` of a text, by the largest summed gain, apart from each other."""
        units = [((" " if m[1] in ("\n", "\r", "\t", "") else "0" if m[1].isdigit() else m[1]), m[2], (" " if m[3] in ("\n", "\r", "\t", "") else "0" if m[3].isdigit() else m[3]), m.start(2), m.end(2)) for m in _UNIT.finditer(text)]
        rows = [self.gains(*u[:3]) for u in units]
        if not any(r is not None for r in rows):
            return []
        p, k = self.params, len(self.learned)
        none = np.full(k, p.worst, np.float32)
        out: list[tuple[int, int, Transformation]] = []
        spans = [(0, len(units))]
        while spans:
            lo, hi = spans.pop()
            if hi <= lo or not any(r is not None for r in rows[lo:hi]):
                continue
            run, start = np.zeros(k, np.float32), np.full(k, lo)
            best, best_from, best_to = np.zeros(k, np.float32), np.full(k, lo), np.full(k, lo)
            for i in range(lo, hi):
                run = run + (rows[i] if rows[i] is not None else none)
                fresh = run <= 0
                run[fresh] = 0
                start[fresh] = i + 1
                better = run > best
                best[better], best_from[better], best_to[better] = run[better], start[better], i + 1
            enough = best >= np.where(self.utf8, p.utf8_gain, min(p.other_gain, p.single_gain))
            for i in np.flatnonzero(enough & ~self.utf8):
                better = {j: rows[j][i] for j in range(best_from[i], best_to[i]) if rows[j] is not None and rows[j][i] > 0}
                several = best[i] >= p.other_gain and len({units[j][1] for j in better}) >= p.other_units
                enough[i] = several or max(better.values()) >= p.single_gain
            if not enough.any():
                continue
            i = int(np.argmax(np.where(enough, best, -1)))
            a, b = int(best_from[i]), int(best_to[i])
            out.append((units[a][3], units[b - 1][4], self.learned[i]))
            spans += [(lo, a), (b, hi)]
        return sorted(out)

    def lines(self, text: str) -> list[tuple[int, int, Transformation]]:
        """Lines of an encoding of several bytes a character that was read as single bytes; their bytes also are ASCII letters, so whole lines are undone."""
        out, at = [], 0
        for line in text.splitlines(keepends=True):
            foreign = _RUN.findall(line)
            n = sum(map(len, foreign))
            if n >= 6 and n * 5 >= len(line.strip()) and max(map(max, foreign)) < "∀":
                body = line.rstrip("\r\n")
                here = np.mean([self.usual(m[1], m[2], m[3]) for m in _UNIT.finditer(body)])
                for t in self.dense:
                    r = undo(body, t)
                    if r is not None and r != body and len(r) < len(body) and _RUN.search(r) and np.mean([self.usual(m[1], m[2], m[3]) for m in _UNIT.finditer(r)]) > here + self.params.utf8_gain:
                        out.append((at, at + len(body), t))
                        break
            at += len(line)
        return out

    def judge(self, text: str) -> tuple[bool, str | None, bool, str] | None:
        """``(garbled, restored, complete, kinds)`` or None; restored is None if nothing of the original can be had."""
        foreign = not text.isascii()
        found = (self.lines(text) if self.dense and foreign else []) if foreign else []
        taken = [(a, b) for a, b, _ in found]
        if foreign:
            found += [x for x in self.passages(text) if not any(x[0] < b and a < x[1] for a, b in taken)]
        lost = LOST_SIGN in text
        if not found and not lost:
            return None
        pieces, at = [], 0
        for a, b, t in sorted(found):
            part = text[a:b]
            whole = undo(part, t) if t in self.dense and (a, b) in taken else None
            pieces += [text[at:a], whole if whole is not None else _RUN.sub(lambda m: r if (r := undo_run(m[0], t)) is not None else m[0], part)]  # noqa: B023
            at = b
        pieces.append(text[at:])
        kinds = sorted({"learned characters" if t[0][0] == TABLE else " + ".join(f"{a} read as {b}" for a, b in t) for _, _, t in found} | ({"lossy"} if lost else set()))
        restored = "".join(pieces)
        return True, (restored if restored != text else None), not lost, "; ".join(kinds)


def _apply(learned: list[Transformation], logs: np.ndarray, params: GarbleParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(learned, logs, params)
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if text and (r := judge.judge(text)):
                    rows.append((i, text, *r[1:]))
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.bool_()), pa.array([r[4] for r in rows], pa.string())], names=["doc_id", "text", "restored", "complete", "kinds"])

    return run


def garbled_documents(documents: DataFrame, params: GarbleParams = GarbleParams(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, restored, complete, kinds`` of the documents that are garbled, wholly or in a passage.

    ``restored`` has the passages undone and the rest untouched, and is null where nothing could be undone; ``complete`` is false where
    characters were lost. Null, empty and ASCII texts without lost characters are never garbled. Texts are judged whole. In a corpus
    without twins nothing is learned and only lost characters are found. Rows that share an id are judged apart, but
    words with lost letters bring an id out once.
    """
    source = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    forms = written(chunk_counts(source))
    learned = learn(forms, params)
    logs = sketch(forms)
    schema = "doc_id bigint, text string, restored string, complete boolean, kinds string"
    judged = written(source.where(F.col("text").isNotNull()).mapInArrow(_apply(learned, logs, params), schema))
    # words that lost a letter to a question mark, and whose twin without it is known
    gaps = source.select("doc_id", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(LOST), F.lit(0)))).alias("word"))
    keys = forms.select(F.regexp_replace("form", r"[^\x00-\x7f]", "").alias("key")).where("length(key) > 2").distinct()
    known = gaps.withColumn("key", F.regexp_replace("word", r"\?|[^\x00-\x7f]", "")).join(keys, "key", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    only = known.join(judged.select(F.col("doc_id").alias("__d")).distinct(), F.col("doc_id").eqNullSafe(F.col("__d")), "left_anti")
    return judged.unionByName(only.select("doc_id", "text", F.lit(None).cast("string").alias("restored"), F.lit(False).alias("complete"), F.lit("lossy").alias("kinds")))
