"""Sets of candidate names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import PREFIXES


def prefixed(names: DataFrame, namespace: str) -> DataFrame:
    """Lower-cased names under a namespace's prefix; null and empty ones drop out."""
    return names.where("name is not null and trim(name) <> ''").select(F.concat(F.lit(PREFIXES[namespace]), F.lower(F.trim("name"))).alias("name"))


def candidates(cran: DataFrame, archived: DataFrame, bioc: DataFrame, extras: tuple[str, ...] = ()) -> DataFrame:
    """The distinct names to look for."""
    parts = [prefixed(cran, "cran"), prefixed(archived, "cran"), prefixed(bioc, "bioc")]
    if extras:
        parts.append(cran.sparkSession.createDataFrame([(e,) for e in extras], "name string"))
    return reduce(DataFrame.union, parts).distinct()


def limited(names: DataFrame, n: int) -> DataFrame:
    """The first n names, or all where n is not positive."""
    return names.orderBy("name").limit(n) if n > 0 else names


def remaining(names: DataFrame, asked: DataFrame) -> DataFrame:
    return names.select("name").subtract(asked.select("name"))


def already(names: DataFrame, asked: DataFrame) -> DataFrame:
    return names.select("name").intersect(asked.select("name"))


def united(one: DataFrame, two: DataFrame) -> DataFrame:
    return one.union(two).distinct()


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")
