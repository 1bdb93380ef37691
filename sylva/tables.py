"""Tables that are replaced in one step, whatever file system they lie on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: The file of a table's folder that names its current version.
CURRENT = "_current"


def hadoop(spark: SparkSession, path: str) -> tuple:
    """The names of the file system's classes, the file system of ``path``, and ``path`` as its own type."""
    names = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = names.Path(path)
    return names, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path``; any other trouble with the file system is raised, never taken for a missing table.

    A folder that holds nothing but versions none of which ever became the current one is no table.
    """
    _, fs, at = hadoop(spark, path)
    return fs.exists(at) and any((name := x.getPath().getName()) == CURRENT or not name.startswith((".", "_", "v-")) for x in fs.listStatus(at))


def _version(spark: SparkSession, path: str) -> str | None:
    names, fs, _ = hadoop(spark, path)
    mark = names.Path(path, CURRENT)
    if not fs.exists(mark):
        return None
    with_lines = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(mark)))
    try:
        return with_lines.readLine()
    finally:
        with_lines.close()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, or a folder of plain Parquet files as it is."""
    version = _version(spark, path)
    return spark.read.parquet(f"{path}/{version}" if version else path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table in one step: a new version is written beside the old ones, then the file that names the current one is replaced by a rename that overwrites.

    A run that dies anywhere leaves either the old table or the new one; there is no moment without a table. The version before stays for readers that
    have begun, older ones and plain files that were there before are removed last. ``df`` may read the table that is replaced.
    """
    spark = df.sparkSession
    old, new = _version(spark, path), f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{new}")
    names, fs, at = hadoop(spark, path)
    mark, fresh = names.Path(at, CURRENT), names.Path(at, f"_{new}")
    out = fs.create(fresh, True)
    out.write(bytearray(new.encode()))
    out.close()
    context = names.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context.rename(fresh, mark, options)
    for x in fs.listStatus(at):
        if x.getPath().getName() not in (CURRENT, new, old):
            fs.delete(x.getPath(), True)
