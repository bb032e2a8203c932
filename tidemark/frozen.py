"""Rows that are computed once and kept where lost executors cannot take them along."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in ``spark.checkpoint.dir``, so that its rows and their order stay as they are.

    Only on one machine a temporary folder takes the place of an unset one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return df.checkpoint()


@contextlib.contextmanager
def pushing(spark: SparkSession) -> Iterator[None]:
    """While this holds, Spark offers filters to Python data sources.

    Spark keeps one set of pushed filters for all scans of a loaded table, so two
    queries on one DataFrame, or two branches of one, would read with each other's filters. A
    source that takes filters is therefore loaded for one scan, whose rows are ``frozen`` within this.
    """
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
