"""Summary reports that arrive as files, taken up incrementally.

The catalogue's only incremental input are reports, a JSON object a line. Files are read once each; a micro-batch merges insert-only, so a repeated
or retried batch changes nothing. There are no event-time windows here because the data model has no event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylva import schema
from sylva.sources.release import report_rows
from sylva.tables import table_exists


def ingest_reports(spark: SparkSession, incoming: str, catalogue: str, checkpoint: str) -> None:
    """Add accessions of new report files to the Parquet table ``catalogue``; returns when all files present are taken up."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = report_rows(batch.where("organism.tax_id is not null and accession is not null")).dropDuplicates(["accession"])
        if table_exists(spark, catalogue):  # the first batch makes the table; a table that can't be read stops the run
            rows = rows.join(spark.read.schema("accession string").parquet(catalogue), "accession", "left_anti")
        rows.write.mode("append").parquet(catalogue)

    source = spark.readStream.schema(schema.REPORT).option("mode", "PERMISSIVE").json(incoming)
    source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
