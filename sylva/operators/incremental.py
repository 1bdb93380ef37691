"""Processing only new or changed records, by fingerprints of partitions.

A table is cut into partitions: by columns that follow how it changes (an arrival day, a run), and inside each of those by a hash of the key. A
partition's fingerprint is its row count and two additive hashes of its rows, so it is one hash aggregate over the table and doesn't depend on the
order of rows. Partitions whose fingerprint is unchanged are never looked at again; the others are recomputed and replaced as a whole by dynamic
partition overwrite.

What keeps a failed run from skipping or repeating records:

1. the rows of changed partitions are fixed in a snapshot, and the fingerprints that will be stored are those of the snapshot;
2. before any output is touched the partitions are marked open in the stored fingerprints, and an open partition counts as changed in every
   later run, even if its records have meanwhile gone back to what they were;
3. the output is replaced, and only then the new fingerprints are stored, by one rename.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.session import written
from sylva.tables import hadoop, read_table, table_exists, write_table


@dataclass(frozen=True)
class IncrementalParams:
    """``n_buckets`` hash parts (of each value of the partitioning columns); None takes as many as the first run's rows need at ``rows_per_bucket`` each.

    A store keeps the number it began with. A table that grows by new values of its partitioning columns gets new partitions for them; one that is
    cut by the hash alone should begin with parts to spare.
    """

    n_buckets: int | None = None
    rows_per_bucket: int = 250_000
    least: int = 64


def bucket_of(keys: Sequence[str], n_buckets: int, by: Sequence[str] = ()) -> Column:
    """The partition of a row as text, fit for a folder's name: values of ``by`` (null as ``null``), then ``b`` and the hash part of the key."""
    plain = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("null")), "[^0-9A-Za-z_.-]", "_") for c in by]
    return F.concat_ws("-", *plain, F.concat(F.lit("b"), F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("string")))


def fingerprints(df: DataFrame, columns: Sequence[str], by: str = "bucket") -> DataFrame:
    """``(bucket, n, h1, h2)``; nulls count as values of their own, the halves of a 64-bit row hash are summed apart so no sum overflows."""
    marked = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    h = F.xxhash64(*marked)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("h1"), F.sum(F.shiftrightunsigned(h, 32)).alias("h2"))


def changed_buckets(now: DataFrame, before: DataFrame) -> DataFrame:
    """Buckets whose fingerprints differ, or which only one side has."""
    b = before.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("n", "h1", "h2")])
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_b"))
    return now.join(b, "bucket", "full").where(~same).select("bucket")


def differing_rows(now: DataFrame, before: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of ``now`` that ``before`` lacks or holds with other values; nulls equal nulls, also in keys. Both sides hold one row per key."""
    b = before.select(*[F.col(c).alias(f"__b_{c}") for c in [*keys, *values]], F.lit(True).alias("__known"))
    on, differs = F.lit(True), F.col("__known").isNull()
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
    for c in values:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__b_{c}"))
    return now.join(b, on, "left").where(differs).drop("__known", *[f"__b_{c}" for c in [*keys, *values]])


def changed_rows(now: DataFrame, before: DataFrame, keys: Sequence[str], values: Sequence[str], n_buckets: int = 4096) -> DataFrame:
    """``differing_rows`` without a store: unchanged buckets fall out by their fingerprints before the join on the key.

    An empty ``before`` makes all rows new, an empty ``now`` gives none. Columns of ``before`` outside ``keys`` and ``values`` are ignored.
    """
    columns = [*keys, *values]
    now, before = (d.withColumn("__bucket", bucket_of(keys, n_buckets)) for d in (now, before.select(*columns)))
    marks = [fingerprints(d, columns, "__bucket").withColumnRenamed("__bucket", "bucket") for d in (now, before)]
    hot = F.broadcast(changed_buckets(*marks).select(F.col("bucket").alias("__bucket")))  # at most n_buckets rows
    return differing_rows(now.join(hot, "__bucket", "left_semi"), before.join(hot, "__bucket", "left_semi"), keys, values).drop("__bucket")


_MARKS = "bucket string, n bigint, h1 bigint, h2 bigint, open boolean, parts int"


def _stored(spark: SparkSession, store: str) -> DataFrame | None:
    path = f"{store}/fingerprints"
    return read_table(spark, path) if table_exists(spark, path) else None


def _parts(source: DataFrame, stored: DataFrame | None, params: IncrementalParams) -> int:
    kept = stored.agg(F.max("parts")).first()[0] if stored is not None else None
    if kept is not None:
        if params.n_buckets not in (None, kept):
            raise ValueError(f"the store is cut into {kept} parts, not {params.n_buckets}")
        return kept
    return params.n_buckets or max(params.least, -(-source.count() // params.rows_per_bucket))


def adopt(state: DataFrame, keys: Sequence[str], values: Sequence[str], store: str, params: IncrementalParams = IncrementalParams(), *, by: Sequence[str] = ()) -> None:
    """Take a state that earlier runs reached elsewhere as handled: its fingerprints are stored, nothing is processed."""
    n = _parts(state, _stored(state.sparkSession, store), params)
    marks = fingerprints(state.withColumn("bucket", bucket_of(keys, n, by)), [*keys, *values])
    write_table(marks.select("bucket", "n", "h1", "h2", F.lit(False).alias("open"), F.lit(n).alias("parts")).coalesce(1), f"{store}/fingerprints")


def handled_now(state: DataFrame, keys: Sequence[str], store: str, *, by: Sequence[str] = ()) -> DataFrame:
    """The rows of another table, cut as the store is, that lie in the partitions the current run handles; for use inside ``process``."""
    spark = state.sparkSession
    n = _parts(state, _stored(spark, store), IncrementalParams())
    todo = spark.read.schema("bucket string").parquet(f"{store}/todo").select(F.col("bucket").alias("__bucket"))
    return state.withColumn("__bucket", bucket_of(keys, n, by)).join(todo, "__bucket", "left_semi").drop("__bucket")


def run_incremental(
    source: DataFrame, keys: Sequence[str], values: Sequence[str], store: str, process: Callable[[DataFrame], DataFrame], params: IncrementalParams = IncrementalParams(), *,
    by: Sequence[str] = (), on_written: Callable[[], None] | None = None,
) -> DataFrame:
    """One run: ``process`` sees only the changed partitions of ``source``; its output replaces theirs in ``store/output``.

    ``process`` gets the source's columns and ``bucket``, which it must keep. ``by`` are columns of the source that partitions follow.
    ``on_written`` is called when the output is in place and not yet counted as handled; what it raises leaves the run failed.
    Returns the buckets handled, as stored. A failed run leaves its partitions marked open, so the next run handles them again, once, and
    overwrites whatever the failed one had written. A partition that lost all its rows, or of which ``process`` keeps none, is emptied. Null
    keys and values count like others; an empty source on an empty store handles nothing.
    """
    if "bucket" in source.columns:
        raise ValueError("the source has a column named bucket")
    spark = source.sparkSession
    stored = _stored(spark, store)
    n = _parts(source, stored, params)
    stored = stored if stored is not None else spark.createDataFrame([], _MARKS)
    data = source.withColumn("bucket", bucket_of(keys, n, by))
    columns = [*keys, *values]
    now = fingerprints(data, columns)
    todo = changed_buckets(now, stored.where("not open and n > 0").select("bucket", "n", "h1", "h2")).unionByName(stored.where("open").select("bucket")).distinct()
    work = f"{store}/todo"
    todo.coalesce(1).write.mode("overwrite").parquet(work)
    todo = spark.read.schema("bucket string").parquet(work)
    if todo.isEmpty():
        return todo
    # the rows of changed partitions, fixed; a source that moves on meanwhile differs from what is stored and is met again by the next run
    data.join(todo, "bucket", "left_semi").hint("rebalance", "bucket").write.mode("overwrite").parquet(f"{store}/snapshot")
    fixed = spark.read.schema(data.schema).parquet(f"{store}/snapshot")
    fresh = fingerprints(fixed, columns)
    marks = stored.join(todo, "bucket", "left_anti")
    mark = lambda rows, is_open: write_table(marks.unionByName(rows.select("bucket", "n", "h1", "h2", F.lit(is_open).alias("open"), F.lit(n).alias("parts"))).coalesce(1), f"{store}/fingerprints")
    nothing = F.lit(0).cast("bigint")
    mark(todo.select("bucket", nothing.alias("n"), nothing.alias("h1"), nothing.alias("h2")), True)
    out = written(process(fixed))  # made once; which partitions hold anything is read from it
    out.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{store}/output")
    filled = {r["bucket"] for r in out.select("bucket").distinct().collect()}  # at most the partitions handled
    names, fs, _ = hadoop(spark, store)
    for row in todo.toLocalIterator():  # partitions that come out empty: dynamic overwrite leaves them as they were
        if row["bucket"] not in filled:
            fs.delete(names.Path(f"{store}/output/bucket={row['bucket']}"), True)
    if on_written is not None:
        on_written()
    left = todo.join(fresh, "bucket", "left").select("bucket", *[F.coalesce(c, nothing).alias(c) for c in ("n", "h1", "h2")])
    mark(left, False)
    return todo


def output(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """What all runs so far have put out; ``schema`` without the bucket, so a store without any output is an empty table."""
    path = f"{store}/output"
    return spark.read.schema(f"{schema}, bucket string").parquet(path).drop("bucket") if table_exists(spark, path) else spark.createDataFrame([], schema)
