"""Samples that match target category proportions, by swap repair over category signatures.

Windows of a head that agree in their category on the head's axis share a signature, so a head is a handful of
(signature, available) counts however many windows it has. Categories without a target form one signature with target 0.
A random floor-satisfying sample is drawn over these counts, then windows of the signature furthest above its target are
exchanged for windows of the one furthest below, as many at a time as help, until no exchange lowers the deviation. A task repairs one head
after the other and holds the signatures of one head, as many as the head has targets. Only then
windows are drawn: the window numbers of a signature's classes are laid end to end in hashed order, and one place is
drawn by hash in each of as many equal strata as windows are wanted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.text import rank_key
from sylva.operators.latest import latest
from sylva.operators.spread_rank import spread_running

#: The signature of categories without a target; the control character keeps it apart from any clean text.
OTHER = "\u0001other"
AXES = ("rank", "class_idx")


@dataclass(frozen=True)
class ProportionParams:
    seed: int = 42
    salts: int = 64


def swap_repair(available: np.ndarray, target: np.ndarray, floor: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Counts per signature: at most ``available``, at least ``min(floor, available)`` where ``size`` allows, ``min(size, sum(available))``
    in all, with the least possible sum of deviations from ``target``.
    """
    available = np.maximum(available.astype(np.int64), 0)
    size = int(min(max(size, 0), available.sum()))
    rng = np.random.default_rng(seed)
    low = np.minimum(np.maximum(floor.astype(np.int64), 0), available)
    if low.sum() > size:  # floors alone exceed the sample: they shrink alike, remainders by signature order
        exact = low * (size / max(low.sum(), 1))
        cut = np.floor(exact).astype(np.int64)
        order = np.argsort(-(exact - cut), kind="stable")
        cut[order[: size - int(cut.sum())]] += 1
        low = cut
    x = low.copy()
    left = size - int(x.sum())
    while left > 0:  # the random start: records fall by share, those a full signature can't hold fall again
        room = available - x
        add = room if left >= room.sum() else np.minimum(rng.multinomial(left, room / room.sum()), room)
        x, left = x + add, left - int(add.sum())
    while True:
        over, under = np.where(x > low, x - target, -1), np.where(x < available, target - x, -1)
        i, j = int(np.argmax(over)), int(np.argmax(under))
        if over[i] <= 0 or under[j] <= 0:
            break
        n = int(min(over[i], under[j], x[i] - low[i], available[j] - x[j]))
        x[i] -= n
        x[j] += n
    return x


def availability(label_map: DataFrame, targets: DataFrame) -> DataFrame:
    """Current classes as (head_taxid, axis_name, category, class_idx, n_windows); axes only of heads with targets.

    Entries with class_idx below 0 or null are no classes. A null or negative n_windows counts 0. Columns other than those named are ignored.
    """
    current = latest(label_map.where("head_taxid is not null"), ["head_taxid", "class_idx"], ["exported_at"], ["rank", "n_windows"])
    classes = current.where("class_idx >= 0").select("head_taxid", "class_idx", rank_key("rank").alias("rank"), F.greatest(F.coalesce("n_windows", F.lit(0)), F.lit(0)).alias("n_windows"))
    axis = targets.where("head_taxid is not null").groupBy("head_taxid").agg(F.max("axis_name").alias("axis_name"))
    return classes.join(axis, "head_taxid").withColumn("category", F.when(F.col("axis_name") == "class_idx", F.col("class_idx").cast("string")).otherwise(F.col("rank"))).drop("rank")


def plan(label_map: DataFrame, requests: DataFrame, targets: DataFrame, params: ProportionParams = ProportionParams()) -> DataFrame:
    """One row per head and signature: ``head_taxid, axis_name, category, target_share, min_windows, available, wanted, short, n_drawn``.

    ``wanted`` is target_share x sample_size to the nearest whole number, halves up (the product's own rounding error doesn't count). ``short`` marks targets whose available windows are fewer than the larger of min_windows and the wanted number. A head
    without request has size 0; a target without classes has 0 available; repeated targets or requests count once (the greatest);
    an empty label_map makes every target with a wanted window short.
    """
    sizes = requests.where("head_taxid is not null").groupBy("head_taxid").agg(F.max("sample_size").alias("sample_size"))
    goal = targets.where("head_taxid is not null").groupBy("head_taxid", "axis_name", "category").agg(F.max("target_share").alias("target_share"), F.max("min_windows").alias("min_windows"))
    goal = goal.withColumn("category", F.when(F.col("axis_name") == "rank", rank_key("category")).otherwise(F.col("category")))
    have = availability(label_map, targets).groupBy("head_taxid", "axis_name", "category").agg(F.sum("n_windows").alias("available"))
    signature = (
        goal.join(have, ["head_taxid", "axis_name", "category"], "full")
        .withColumn("category", F.when(F.col("target_share").isNull() & F.col("min_windows").isNull(), F.lit(OTHER)).otherwise(F.col("category")))
        .groupBy("head_taxid", "axis_name", "category")
        .agg(F.max("target_share").alias("target_share"), F.max("min_windows").alias("min_windows"), F.coalesce(F.sum("available"), F.lit(0)).cast("bigint").alias("available"))
        .join(sizes, "head_taxid", "left")
    )
    columns = ["head_taxid", "axis_name", "category", "target_share", "min_windows", "available", "sample_size"]
    ordered = signature.select(*columns).repartition("head_taxid").sortWithinPartitions("head_taxid", "category")
    schema = "head_taxid string, axis_name string, category string, target_share double, min_windows bigint, available bigint, wanted bigint, short boolean, n_drawn bigint"
    return ordered.mapInArrow(_repair_heads(params.seed), schema)


def _repair_heads(seed: int):
    """Heads come sorted, so a task repairs one after the other; the last head of a batch waits for the next batch."""

    def heads(rows: pa.Table) -> pa.RecordBatch:
        name = rows.column("head_taxid").to_pylist()
        number = lambda c, kind: rows.column(c).to_numpy(zero_copy_only=False) if rows.column(c).null_count == 0 else rows.column(c).fill_null(kind(0)).to_numpy(zero_copy_only=False)
        share, floor, available, size = number("target_share", float), number("min_windows", int), number("available", int), number("sample_size", int)
        other = np.array([c == OTHER for c in rows.column("category").to_pylist()], bool)
        want, drawn = np.zeros(len(name), np.int64), np.zeros(len(name), np.int64)
        starts = [0, *(i for i in range(1, len(name)) if name[i] != name[i - 1]), len(name)]
        for a, b in zip(starts, starts[1:], strict=False):
            n = int(size[a])
            want[a:b] = np.floor(np.round(share[a:b] * n, 6) + 0.5)
            key = int.from_bytes(hashlib.sha256(f"{seed}|{name[a]}".encode()).digest()[:8], "big")
            drawn[a:b] = swap_repair(available[a:b], want[a:b], floor[a:b], n, key)
        short = (available < np.maximum(floor, want)) & ~other
        kept = [rows.column(c).combine_chunks() for c in ("head_taxid", "axis_name", "category", "target_share", "min_windows", "available")]
        kept = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in kept]
        return pa.RecordBatch.from_arrays([*kept, pa.array(want), pa.array(short), pa.array(drawn)], names=["head_taxid", "axis_name", "category", "target_share", "min_windows", "available", "wanted", "short", "n_drawn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            name = rows.column("head_taxid")
            last = name[-1].as_py()
            cut = rows.num_rows
            while cut and name[cut - 1].as_py() == last:
                cut -= 1
            if cut:
                yield heads(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield heads(held)

    return run


def materialise(label_map: DataFrame, targets: DataFrame, plan_rows: DataFrame, params: ProportionParams = ProportionParams()) -> DataFrame:
    """The sampled windows, ``head_taxid, category, class_idx, windows`` with the drawn window numbers of a class in rising order,
    about a million in a row at most (a class with more has several rows).

    No window is listed before it is drawn: a class covers the places ``start .. start + n_windows - 1`` of its signature, and
    the strata that reach into it are computed from those. Classes of which nothing is drawn have no row.
    """
    named = plan_rows.select("head_taxid", "category", "available", "n_drawn", F.lit(True).alias("__named"))
    classes = availability(label_map, targets).where("n_windows > 0")
    goal = plan_rows.where(F.col("category") != OTHER).select("head_taxid", "category", F.lit(1).alias("__t"))
    classes = classes.join(goal, ["head_taxid", "category"], "left").withColumn("category", F.when(F.col("__t").isNull(), F.lit(OTHER)).otherwise(F.col("category"))).drop("__t")
    placed = spread_running(classes, ["head_taxid", "category"], ["class_idx"], "n_windows", salts=params.salts)
    drawn = placed.join(named.where("n_drawn > 0").drop("__named"), ["head_taxid", "category"])
    # a class of which very much is drawn is cut to ranges of its windows, so its strata are many tasks' work
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_windows") * (F.col("n_drawn") / F.col("available")) / F.lit(float(STEP)))).cast("int")
    drawn = drawn.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    edge = lambda i: ((F.col("n_windows").cast("decimal(19,0)") * i) / F.col("parts")).cast("decimal(38,6)")
    lo, hi = F.floor(edge(F.col("part"))).cast("bigint"), F.floor(edge(F.col("part") + 1)).cast("bigint")
    rows = drawn.select(
        "head_taxid", F.when(F.col("category") != OTHER, F.col("category")).alias("category"), "class_idx", F.xxhash64(F.lit(params.seed), "head_taxid", "category").alias("key"),
        "start", lo.alias("lo"), hi.alias("hi"), "available", "n_drawn", "part",
    )
    return rows.repartition("head_taxid", "class_idx", "part").mapInArrow(_draw, "head_taxid string, category string, class_idx int, windows array<bigint>")


#: Strata looked at in one step, which bounds a row of the result, and windows held before they are handed on.
STEP = 1 << 20
HELD = 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer over whole arrays (the finaliser of a public counter-based generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stratum j covers the places floor(j N / x) to floor((j + 1) N / x) - 1; one place of each is drawn by hash.

    A row is the windows ``lo`` to ``hi - 1`` of a class whose first window has place ``start``; strata that reach beyond it are drawn by the neighbour as well, and alike.
    """
    names = ["head_taxid", "category", "class_idx", "windows"]
    for batch in batches:
        head, category, index, key, start, low, high, total, wanted = (batch.column(i).to_pylist() for i in range(9))
        rows: list[tuple[int, np.ndarray]] = []
        held = 0

        def made(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int32)
            flat = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int64)
            take = lambda v, kind: pa.array([v[r[0]] for r in rows], kind)
            return pa.RecordBatch.from_arrays([take(head, pa.string()), take(category, pa.string()), take(index, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=names)  # noqa: B023

        for i in range(batch.num_rows):
            n, x, lo, hi = total[i], wanted[i], start[i] + low[i], start[i] + high[i]
            first, last = max(lo * x // n - 1, 0), min((hi - 1) * x // n + 1, x - 1)
            for a in range(first, last + 1, STEP):
                b = min(a + STEP, last + 1)
                j = np.arange(a, b + 1, dtype=object if (b + 1) * n >= 1 << 62 else np.int64)
                edge = (j * n // x).astype(np.int64)
                with np.errstate(over="ignore"):
                    h = _mix(np.arange(a, b, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key[i] & 0xFFFFFFFFFFFFFFFF))
                place = edge[:-1] + (h % np.maximum(np.diff(edge), 1).astype(np.uint64)).astype(np.int64)
                mine = place[(place >= lo) & (place < hi)] - start[i]
                if len(mine):
                    rows.append((i, mine))
                    held += len(mine)
                if held >= HELD:
                    yield made(rows)
                    rows, held = [], 0
        yield made(rows)
