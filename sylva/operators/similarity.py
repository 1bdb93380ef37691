"""Near-copies and relatives of sequences by bottom-k sketches, without a shuffle of candidate pairs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.sketch import ani_bin, ani_proxy, jaccard
from sylva.operators.by_group import whole_groups
from sylva.session import written


@dataclass(frozen=True)
class ClusterParams:
    """Published defaults."""

    k: int = 21
    sketch_size: int = 200
    threshold: float = 0.30
    relaxed: tuple[float, ...] = (0.20, 0.15, 0.10, 0.07, 0.05)
    min_genomes: int = 2
    min_fraction: float = 0.10
    max_genomes: int | None = 300
    copies: float = 0.95


#: Sketches of a block: a task compares two blocks of a group.
BLOCK = 16_384
#: Groups of at most so many sketches are compared many at a time.
SMALL = 64
#: Numbers that a step over arrays holds.
STEP = 8_000_000
#: Links of a group that one task turns into a forest.
LINKS = 1_000_000


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the links of a maximum spanning forest over nodes 0 to n - 1, and the tree of each node: whole rounds of every tree's best link."""
    order = np.argsort(-weight, kind="stable")
    a, b, tree, kept = a[order], b[order], np.arange(n), []
    left = np.arange(len(order))
    while True:
        x, y = tree[a[left]], tree[b[left]]
        apart = x != y
        left, x, y = left[apart], x[apart], y[apart]
        if not len(left):
            return order[np.concatenate([np.empty(0, np.int64), *kept]).astype(np.int64)], tree
        best = np.full(n, len(order))
        np.minimum.at(best, x, left)
        np.minimum.at(best, y, left)
        roots = np.flatnonzero(best < len(order))
        chosen = best[roots]
        kept.append(np.unique(chosen))
        one, other = tree[a[chosen]], tree[b[chosen]]
        up = np.arange(n)
        up[roots] = np.where(one == roots, other, one)
        both = roots[(up[up[roots]] == roots) & (roots < up[roots])]  # two trees that chose the same link
        up[both] = both
        while not np.array_equal(above := up[up], up):
            up = above
        tree = up[tree]


def _runs(columns: list[pa.ChunkedArray], n: int) -> np.ndarray:
    """Where each run of equal rows begins, and n."""
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        code = pc.fill_null(c.combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.append(np.flatnonzero(new), n)


def _near(m: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of ``m`` (sketches as ordered numbers, -1 behind their end) at ``threshold`` or more, and their similarity."""
    z = np.concatenate([m[a], m[b]], axis=1)
    z.sort(axis=1)
    row, at = np.nonzero((z[:, 1:] == z[:, :-1]) & (z[:, 1:] >= 0))
    shared = np.bincount(row, minlength=len(a))
    nth = np.arange(len(row)) - (np.cumsum(shared) - shared)[row] + 1
    blanks = 2 * m.shape[1] - length[a] - length[b]
    counted = np.bincount(row[at + 2 - nth - blanks[row] <= size], minlength=len(a))
    j = counted / np.minimum(size, length[a] + length[b] - shared)
    ok = j >= threshold
    return a[ok], b[ok], j[ok]


def _compared(rows: pa.Table, threshold: float, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Similar rows of ``group, i, j, block, rep, sketch``, sorted by the first three: inside a block where i = j, between two otherwise."""
    n = rows.num_rows
    starts = _runs([rows.column(c) for c in range(3)], n)
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    i, j, block = (rows.column(c).to_numpy() for c in (1, 2, 3))
    sketch = rows.column(5).combine_chunks()
    length = sketch.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    hashes, row = sketch.flatten().to_numpy(), np.repeat(np.arange(n), length)
    width = int(length.max(initial=1))
    order = np.lexsort((hashes, of[row]))
    new = np.append(True, (hashes[order[1:]] != hashes[order[:-1]]) | (of[row[order[1:]]] != of[row[order[:-1]]]))
    code = np.empty(len(order), np.int32)
    code[order] = np.cumsum(new) - 1
    m = np.full((n, width), -1, np.int32)
    m[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = code
    post, begin = row[order], np.append(np.flatnonzero(new), len(order))
    most = max(1, STEP // width)

    def fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (i[a] == j[a]) | (block[a] != block[b])

    # many small groups: all pairs of rows that share a hash, as often as they share one
    counts = np.diff(starts)
    small = counts <= SMALL
    of_post = of[post]
    place = np.arange(len(post))
    later = np.where(small[of_post], np.repeat(begin[1:], np.diff(begin)) - place - 1, 0)
    total = np.cumsum(later)
    at = 0
    while at < len(post) and total[-1] > (total[at - 1] if at else 0):
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + STEP // 4, side="right"))
        end = len(post) if end >= len(post) else int(np.searchsorted(of_post, of_post[end]))  # numbers are by group, so this is a group's first
        if end <= at:
            end = int(np.searchsorted(of_post, of_post[at], side="right"))
        first = np.repeat(place[at:end], later[at:end])
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(later[at:end]) - later[at:end], later[at:end])
        a, b = np.divmod(np.unique(post[first] * n + post[second]), n)
        ok = fits(a, b)
        a, b = a[ok], b[ok]
        for k in range(0, len(a), most):
            yield _near(m, length, a[k : k + most], b[k : k + most], threshold, size)
        at = end
    # large ones: a row meets the lists of its hashes, and only rows met often enough are compared
    heads = of_post[begin[:-1]]
    need = np.maximum(1, np.ceil(threshold * np.minimum(size, length) - 1e-9)).astype(np.int64)
    for g in np.flatnonzero(~small):
        lo, hi = starts[g], starts[g + 1]
        same = i[lo] == j[lo]
        mine = np.arange(lo, hi) if same else lo + np.flatnonzero(block[lo:hi] == i[lo])
        if not len(mine):
            continue
        c0, c1 = (int(np.searchsorted(heads, g, side=x)) for x in ("left", "right"))
        inside = post[begin[c0] : begin[c1]] - lo
        cuts = begin[c0 + 1 : c1] - begin[c0]
        if not same:
            theirs = block[lo:hi][inside] == j[lo]
            cuts = np.cumsum(theirs)[cuts - 1] if len(cuts) else cuts
            inside = inside[theirs]
        lists = np.split(inside, cuts)
        held: list[tuple[int, np.ndarray]] = []
        waiting = 0
        for x in mine.tolist():
            met = np.flatnonzero(np.bincount(np.concatenate([lists[c - c0] for c in m[x, : length[x]].tolist()]), minlength=hi - lo) >= need[x]) + lo
            met = met[met > x] if same else met
            if len(met):
                held.append((x, met))
                waiting += len(met)
            if waiting >= most or (x == mine[-1] and held):
                a, b = np.repeat([y for y, _ in held], [len(z) for _, z in held]), np.concatenate([z for _, z in held])
                held, waiting = [], 0
                for k in range(0, len(a), most):
                    yield _near(m, length, a[k : k + most], b[k : k + most], threshold, size)


def _representatives(sketches: DataFrame, group: str, key: str) -> DataFrame:
    """``group, i, j, block, rep, sketch``: one row per different sketch and pair of blocks that it is compared in."""
    s = sketches.where(F.col(group).isNotNull() & (F.size("sketch") > 0))
    reps = written(s.groupBy(group, "sketch").agg(F.min(key).alias("rep")))
    large = reps.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("__b")).where("__b > 1")  # at most one for each BLOCK rows
    r = reps.join(F.broadcast(large), group, "left").withColumn("__b", F.coalesce("__b", F.lit(1)))
    r = r.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("__b")).cast("int")).withColumn("__x", F.explode(F.sequence(F.lit(0), F.col("__b") - 1)))
    r = r.select(group, F.least("block", "__x").alias("i"), F.greatest("block", "__x").alias("j"), "block", "rep", "sketch")
    return r.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _pair_schema(df: DataFrame, group: str, key: str) -> str:
    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    return f"`{group}` {kind[group]}, a {kind[key]}, b {kind[key]}, jaccard double"


def _paired(groups: pa.ChunkedArray, keys: pa.ChunkedArray, a: np.ndarray, b: np.ndarray, j: np.ndarray, group: str) -> pa.RecordBatch:
    g, x, y = groups.take(pa.array(a)).combine_chunks(), keys.take(pa.array(a)).combine_chunks(), keys.take(pa.array(b)).combine_chunks()
    right = pc.less(x, y)
    return pa.RecordBatch.from_arrays([g, pc.if_else(right, x, y), pc.if_else(right, y, x), pa.array(j, pa.float64())], names=[group, "a", "b", "jaccard"])


def similar_pairs(sketches: DataFrame, group: str, key: str, threshold: float, size: int = 200) -> DataFrame:
    """``group, a, b, jaccard`` with a < b and jaccard at least ``threshold`` (above 0), exact on the sketches.

    Two sketches with a positive similarity share a hash among the least of their union, so a row meets the lists of its hashes; equal
    sketches are compared once, represented by their least key. A group is cut to blocks of ``BLOCK`` sketches, and a task compares two of
    them in memory: candidates are never shuffled, only similar pairs leave it. A sketch is shuffled once for each block of its group. Null groups have no pairs.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3, BLOCK):
            for a, b, j in _compared(rows, threshold, size):
                if len(a):
                    yield _paired(rows.column(0), rows.column(4), a, b, j, group)

    return _representatives(sketches, group, key).mapInArrow(run, _pair_schema(sketches, group, key))


def similar_forest(sketches: DataFrame, group: str, key: str, threshold: float, size: int = 200) -> DataFrame:
    """Of ``similar_pairs`` those of a maximum spanning forest: the clusters at every threshold from this one on, in fewer rows than there are sketches.

    A task keeps a forest of what it compares, so pairs that tell nothing new are never written.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3, BLOCK):
            a, b, j = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
            held: list[tuple[np.ndarray, ...]] = []
            for found in _compared(rows, threshold, size):
                held.append(found)
                if sum(len(x[0]) for x in held) >= STEP // 4:
                    a, b, j = (np.concatenate(x) for x in zip((a, b, j), *held, strict=True))
                    kept, _ = spanning_forest(rows.num_rows, a, b, j)
                    a, b, j, held = a[kept], b[kept], j[kept], []
            a, b, j = (np.concatenate(x) for x in zip((a, b, j), *held, strict=True))
            kept, _ = spanning_forest(rows.num_rows, a, b, j)
            if len(kept):
                yield _paired(rows.column(0), rows.column(4), a[kept], b[kept], j[kept], group)

    return _one_forest(_representatives(sketches, group, key).mapInArrow(run, _pair_schema(sketches, group, key)), group)


def _numbered(*columns: pa.ChunkedArray) -> tuple[pa.Array, list[np.ndarray]]:
    """The different values of all columns in order, and each column as numbers of them."""
    every = pa.concat_arrays([c.combine_chunks() for c in columns])
    values = every.unique()
    values = values.take(pc.sort_indices(values))
    numbers = pc.index_in(every, values).to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.split(numbers, np.cumsum([len(c) for c in columns])[:-1])


def _nodes(of: np.ndarray, *columns: tuple[np.ndarray, pa.ChunkedArray]) -> tuple[np.ndarray, pa.Array, np.ndarray, list[np.ndarray]]:
    """Nodes of several groups, each (group, name) once and in that order: group, names, number of the name, and the columns' rows as numbers of nodes."""
    names, numbers = _numbered(*[c for _, c in columns])
    all_ = np.concatenate([of[rows] * len(names) + x for (rows, _), x in zip(columns, numbers, strict=True)])
    nodes, back = np.unique(all_, return_inverse=True)
    return nodes // max(1, len(names)), names, nodes % max(1, len(names)), np.split(back, np.cumsum([len(x) for x in numbers])[:-1])


def _one_forest(edges: DataFrame, group: str) -> DataFrame:
    """A maximum spanning forest of each group's ``a, b, jaccard``: groups of more than ``LINKS`` links in parts first, until parts no longer save a half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 2, BLOCK):
            starts = _runs([rows.column(0), rows.column(1)], rows.num_rows)
            of, here = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), np.arange(rows.num_rows)
            nodes, _, _, (a, b) = _nodes(of, (here, rows.column(2)), (here, rows.column(3)))
            kept, _ = spanning_forest(len(nodes), a, b, rows.column(4).to_numpy())
            out = rows.take(pa.array(np.sort(kept))).combine_chunks()
            yield from out.select([0, 2, 3, 4]).to_batches()

    edges = written(edges)
    before = None
    while True:
        # how many parts: at most one for each LINKS rows, so these groups meet a broadcast
        parts = edges.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > LINKS)
        large = parts.agg(F.sum("__n")).first()[0] or 0
        split = large and (before is None or large * 2 <= before)
        e = edges.join(F.broadcast(parts), group, "left") if split else edges.withColumn("__n", F.lit(None).cast("bigint"))
        e = e.withColumn("__p", F.coalesce(F.pmod(F.xxhash64("a", "b"), F.ceil(F.col("__n") / F.lit(LINKS))), F.lit(0)).cast("int"))
        e = e.select(group, "__p", "a", "b", "jaccard").repartition(group, "__p").sortWithinPartitions(group, "__p")
        edges = written(e.mapInArrow(run, edges.select(group, "a", "b", "jaccard").schema))
        if not split:
            return edges
        before = large


def sketch_classes(sketches: DataFrame, group: str, key: str) -> DataFrame:
    """``group, key, rep``: the representative of each key's equal sketches; empty sketches represent themselves."""
    w = Window.partitionBy(group, "sketch")
    return sketches.select(group, key, F.when(F.size("sketch") > 0, F.min(key).over(w)).otherwise(F.col(key)).alias("rep"))


def _by_group(df: DataFrame, rule: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``rule`` on whole groups, many at a time, which the first column names; it gets the number of each row's group too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1, BLOCK):
            starts = _runs([rows.column(0)], rows.num_rows)
            yield rule(rows, np.repeat(np.arange(len(starts) - 1), np.diff(starts)))

    by = df.columns[0]
    return df.repartition(by).sortWithinPartitions(by).mapInArrow(run, schema)


def components(nodes: DataFrame, edges: DataFrame, group: str) -> DataFrame:
    """``group, node, component``: the component is its least node. Edges may name nodes that aren't listed.

    A spanning forest first, in parts where a group has many edges; then a task holds the forest of a group, which has fewer rows than nodes.
    """
    kind = {f.name: f.dataType.simpleString() for f in nodes.schema}
    e = edges.where(F.col(group).isNotNull() & F.col("a").isNotNull() & F.col("b").isNotNull()).select(group, "a", "b", F.lit(1.0).alias("jaccard"))

    def label(rows: pa.Table, of: np.ndarray) -> pa.RecordBatch:
        here = np.arange(rows.num_rows)
        g, names, name, (a, b) = _nodes(of, (here, rows.column(1)), (here, rows.column(2)))
        _, tree = spanning_forest(len(g), a, b, np.ones(len(a)))
        least = np.full(len(g), len(g))
        np.minimum.at(least, tree, np.arange(len(g)))
        some = np.zeros(len(g), np.int64)
        some[a], some[b] = here, here
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(some)).combine_chunks(), names.take(pa.array(name)), names.take(pa.array(name[least[tree]]))], names=[group, "node", "component"])

    labels = _by_group(_one_forest(e, group).select(group, "a", "b"), label, f"`{group}` {kind[group]}, node {kind['node']}, component {kind['node']}")
    return nodes.select(group, "node").join(labels, [group, "node"], "left").select(group, "node", F.coalesce("component", "node").alias("component"))


def cluster_genomes(sketches: DataFrame, group: str, key: str, params: ClusterParams = ClusterParams()) -> DataFrame:
    """``group, key, cluster, threshold``: single-linkage clusters at the first of the thresholds that yields two clusters of sufficient size.

    Groups of fewer than 2 genomes or more than ``max_genomes`` (None for no bound), and those no threshold splits, have no rows. Sketches are
    compared once, at the least threshold; what clusters them at any threshold is a maximum spanning forest, so a task holds a group's different
    sketches and fewer links than that, whatever the number of similar pairs.
    """
    w = Window.partitionBy(group)
    ok = sketches
    if params.max_genomes is not None:
        ok = sketches.withColumn("__n", F.count(F.lit(1)).over(w)).where(F.col("__n") <= params.max_genomes).drop("__n")
    ok = written(ok)
    schedule = [params.threshold, *[t for t in params.relaxed if t < params.threshold]]
    links = similar_forest(ok, group, key, min(schedule), params.sketch_size)
    classes = written(sketch_classes(ok.where(F.col(group).isNotNull()), group, key))
    kind = {f.name: f.dataType.simpleString() for f in classes.schema}

    def run(rows: pa.Table, of: np.ndarray) -> pa.RecordBatch:
        b, n, w = rows.column(2), pc.fill_null(rows.column(3), 0).to_numpy(), pc.fill_null(rows.column(4), 0.0).to_numpy()
        link = pc.is_valid(b).to_numpy()
        one, two = np.flatnonzero(~link), np.flatnonzero(link)
        g, names, name, (member, x, y) = _nodes(of, (one, rows.column(1).filter(pa.array(~link))), (two, rows.column(1).filter(pa.array(link))), (two, b.filter(pa.array(link))))
        weight, at = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
        weight[member], at[member] = n[one], one
        genomes = np.bincount(g, weights=weight, minlength=of[-1] + 1)
        need = np.maximum(params.min_genomes, np.ceil(params.min_fraction * genomes))
        cluster, threshold = np.full(len(g), -1), np.zeros(len(g))
        for t in schedule:
            close = w[two] >= t
            _, tree = spanning_forest(len(g), x[close], y[close], w[two][close])
            least = np.full(len(g), len(g))
            np.minimum.at(least, tree, np.arange(len(g)))
            sizes = np.bincount(tree, weights=weight, minlength=len(g))
            enough = np.bincount(g, weights=(tree == np.arange(len(g))) & (sizes >= need[g]), minlength=of[-1] + 1) >= 2
            new = (cluster < 0) & enough[g]
            cluster[new], threshold[new] = least[tree][new], t
        made = np.flatnonzero(cluster >= 0)
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(at[made])).combine_chunks(), names.take(pa.array(name[made])), names.take(pa.array(name[cluster[made]])), pa.array(threshold[made])], names=[group, "rep", "cluster", "threshold"])

    null = lambda kind: F.lit(None).cast(kind)
    members = classes.groupBy(group, "rep").agg(F.count(F.lit(1)).alias("n")).select(group, F.col("rep").alias("a"), null(kind["rep"]).alias("b"), "n", null("double").alias("jaccard"))
    both = members.unionByName(links.select(group, "a", "b", null("bigint").alias("n"), "jaccard"))
    found = _by_group(both, run, f"`{group}` {kind[group]}, rep {kind['rep']}, cluster {kind['rep']}, threshold double")
    return classes.join(found, [group, "rep"]).select(group, key, "cluster", "threshold")


def dereplicate(sketches: DataFrame, group: str, key: str, params: ClusterParams = ClusterParams()) -> DataFrame:
    """``group, key, kept_as``: greedy in order of the key; a genome similar to a kept one at ``copies`` or more is dropped in its favour.

    Genomes with empty sketches are kept; a threshold of 1 or more keeps all. Only similar pairs reach the greedy step, so its groups are small
    where copies are few; equal sketches were one representative before.
    """
    sketches = written(sketches)
    classes = sketch_classes(sketches, group, key)
    if params.copies >= 1:
        return classes.select(group, key, F.col(key).alias("kept_as"))
    near = similar_pairs(sketches, group, key, params.copies, params.sketch_size).select(group, "a", "b")
    kind = {f.name: f.dataType.simpleString() for f in near.schema}

    def run(rows: pa.Table, of: np.ndarray) -> pa.RecordBatch:
        here = np.arange(rows.num_rows)
        _, names, name, (a, b) = _nodes(of, (here, rows.column(1)), (here, rows.column(2)))
        first = list(range(len(name)))
        for x, y in np.stack([b, a], axis=1)[np.lexsort((a, b))].tolist():  # nodes are in order of their keys: what x may go to is settled before x
            if first[x] == x and first[y] == y:
                first[x] = y
        some = np.zeros(len(name), np.int64)
        some[a], some[b] = here, here
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(some)).combine_chunks(), names.take(pa.array(name)), names.take(pa.array(name[first]))], names=[group, "rep", "kept"])

    chosen = _by_group(near, run, f"`{group}` {kind[group]}, rep {kind['a']}, kept {kind['a']}")
    return classes.join(chosen, [group, "rep"], "left").select(group, key, F.coalesce("kept", "rep").alias("kept_as"))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 21, size: int = 200) -> DataFrame:
    """``query, nearest, jaccard, ani, bin``: the most similar candidate of each query in its group, the least id on ties; 4 decimals.

    ``queries(group, query, sketch)``, ``candidates(group, candidate, sketch)``; queries without candidates or with an empty sketch have no row.
    Only candidates that share a hash with a query are compared with it; to a query that shares none with any, all are alike and the least id is its nearest.
    """
    q = written(queries.where(F.col("group").isNotNull() & (F.size("sketch") > 0)).select("group", "query", F.col("sketch").alias("sa")))
    c = written(candidates.where(F.col("group").isNotNull() & (F.size("sketch") > 0)).select("group", "candidate", F.col("sketch").alias("sb")))
    met = q.select("group", "query", F.explode("sa").alias("h")).join(c.select("group", "candidate", F.explode("sb").alias("h")), ["group", "h"]).where("query <> candidate").select("group", "query", "candidate").distinct()
    j = met.join(q, ["group", "query"]).join(c, ["group", "candidate"]).select("query", jaccard("sa", "sb", size).alias("j"), "candidate").where("j > 0")
    best = j.groupBy("query").agg(F.min(F.struct((-F.col("j")).alias("m"), "candidate")).alias("b")).select("query", (-F.col("b.m")).alias("j"), F.col("b.candidate").alias("nearest"))
    # the two least candidates of each group: a query may be the first of them itself
    first = c.groupBy("group").agg(F.min("candidate").alias("one"))
    second = c.join(first, "group").where("candidate <> one").groupBy("group").agg(F.min("candidate").alias("two"))
    least = q.select("group", "query").join(first, "group").join(second, "group", "left").select("query", F.when(F.col("query") != F.col("one"), F.col("one")).otherwise(F.col("two")).alias("any")).where("any is not null")
    least = least.groupBy("query").agg(F.min("any").alias("any"))
    out = least.join(best, "query", "left").select("query", F.coalesce("nearest", "any").alias("nearest"), F.coalesce("j", F.lit(0.0)).alias("j"))
    ani = ani_proxy("j", k)
    return out.select("query", "nearest", F.round("j", 4).alias("jaccard"), F.round(ani, 4).alias("ani"), ani_bin(ani).alias("bin"))
