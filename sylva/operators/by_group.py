"""Sequential rules per group, many groups to a task: groups come sorted and are worked off one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int, rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups, of ``rows`` rows or somewhat more, or of one larger group; batches come sorted by their first ``n_keys`` columns."""

    def key(batch: pa.RecordBatch, at: int) -> list:
        return [batch.column(i)[at].as_py() for i in range(n_keys)]

    done: list[pa.RecordBatch] = []
    last: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for i in range(n_keys):
            c = batch.column(i)
            same &= (pc.fill_null(pc.equal(c, c[-1]), False) if c[-1].is_valid else pc.is_null(c)).to_numpy(zero_copy_only=False)
        cut = batch.num_rows - (int(np.argmin(same[::-1])) if not same.all() else batch.num_rows)
        if cut:
            done += [*last, batch.slice(0, cut)]
            last = [batch.slice(cut)]
        elif last and key(last[-1], 0) == key(batch, 0):
            last.append(batch)
        else:
            done += last
            last = [batch]
        if sum(x.num_rows for x in done) >= rows:
            yield pa.Table.from_batches(done)
            done = []
    if done or last:
        yield pa.Table.from_batches(done + last)


def map_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], rule: Callable[..., list], out: str, kind: str) -> DataFrame:
    """``keys, columns`` of ``df`` plus ``out``: ``rule`` gets a group's ``columns`` as lists, in ``order``, and returns a value for each row.

    One shuffle by the keys and a sort that spills; a group is held by one task, so its size must be bounded by the caller's rules. Handing over
    single groups costs milliseconds each, this costs microseconds. Null keys form a group; an empty table calls nothing.
    """
    names = [*keys, *columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema) + f", `{out}` {kind}"
    n_keys = len(keys)

    def work(rows: pa.Table) -> pa.RecordBatch:
        cols = [rows.column(i).to_pylist() for i in range(len(names))]
        key = list(zip(*cols[:n_keys], strict=True))
        starts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
        made: list = []
        for a, b in zip(starts, starts[1:], strict=False):
            made += rule(*[c[a:b] for c in cols[n_keys:]])
        flat = [c.combine_chunks() for c in rows.columns]
        flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in flat]
        return pa.RecordBatch.from_arrays([*flat, pa.array(made, pa.string() if kind == "string" else pa.int64())], names=[*names, out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            last = [rows.column(i)[-1].as_py() for i in range(n_keys)]
            cut = rows.num_rows
            while cut and [rows.column(i)[cut - 1].as_py() for i in range(n_keys)] == last:
                cut -= 1
            if cut:
                yield work(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield work(held)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).select(*names).mapInArrow(run, schema)
