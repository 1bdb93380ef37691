"""Queries over the test tables do the whole job that the query before them planned."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylva.plans import dataset_queries as Q


def test_samples_draw_what_was_allocated(spark, sf):
    assert Q.samples(spark, sf).agg(F.max("i")).first()[0] > 20  # i counts the windows of a task
