"""Schemas of the engine's tables, in the order of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _D, _F, _B = T.StringType(), T.LongType(), T.DateType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


DAILY = _schema(("item", _S, False), ("day", _D, False), ("n", _L, False))
RAW_COUNTS = _schema(("channel", _S, True), ("artifact", _S, True), ("release", _S, True), ("day", _D, True), ("n", _L, True))
ENTRIES = _schema(("channel", _S, True), ("source_id", _L, True), ("artifact", _S, True), ("release", _S, True), ("arch", _S, True), ("status", _S, True), ("published", _S, True))
LEDGER = _schema(("name_lower", _S, False), ("display_name", _S, True), ("lifecycle", _S, True))
IDENTITY = _schema(("artifact", _S, False), ("item", _S, False), ("namespace", _S, False), ("display_name", _S, True), ("lifecycle", _S, True))
RELEASES = _schema(
    ("channel", _S, False), ("artifact", _S, False), ("release", _S, False), ("source_id", _L, True), ("item", _S, True), ("namespace", _S, True),
    ("display_name", _S, True), ("lifecycle", _S, True), ("n_total", _L, True), ("last_day", _D, True), ("done", _B, True),
)
#: What the summary keeps of an item's days in one year, and the artifacts that have counts in one.
STATE = _schema(("item", _S, False), ("first_day", _D, False), ("last_day", _D, False), ("n", _L, False))
ARTIFACTS = _schema(("artifact", _S, False), ("of_year", T.IntegerType(), False))
SUMMARY = _schema(
    ("item", _S, False), ("item_lower", _S, True), ("namespace", _S, True), ("display_name", _S, True), ("total_30d", _L, True), ("total_90d", _L, True), ("total_365d", _L, True),
    ("rank_30d", _L, True), ("rank_90d", _L, True), ("rank_365d", _L, True), ("avg_daily_30d", _F, True), ("trend", _F, True), ("first_day", _D, True), ("last_day", _D, True), ("n_total", _L, True), ("lifecycle", _S, True),
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and order of ``schema``; columns that an older table lacks are null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


class KeyViolation(ValueError):
    """A table breaks its key."""


def require_key(df: DataFrame, *key: str) -> DataFrame:
    """``df`` itself, once its key is known to be unique and without nulls."""
    missing = F.lit(False)
    for k in key:
        missing |= F.col(k).isNull()
    bad = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).select(missing.alias("missing"), "rows").where("missing or rows > 1").first()
    if bad is not None:
        raise KeyViolation(f"{'null' if bad['missing'] else 'repeated'} key ({', '.join(key)})")
    return df
