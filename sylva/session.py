"""Session helpers: building a session, reading tables, cutting lineage in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "sylva", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and local runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ui.retainedExecutions", "20")  # plans of past queries fill the heap of a long session
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
        .config("spark.ui.retainedTasks", "1000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Only where it is unset and the master is local (tests) a temporary folder is made;
    on a cluster without the setting this raises instead of using a machine's own disk.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sylva-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a zstd Parquet work table in the shared folder and read it back.

    It survives the loss of executors like a checkpoint, is columnar (later reads prune columns)
    and takes a fraction of a checkpoint's space.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"work-{uuid.uuid4().hex}")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A test table, with only the named columns so that nothing else is read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
