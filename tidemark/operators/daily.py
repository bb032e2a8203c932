"""Daily counts: one row for each item and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import shard_letter
from tidemark.operators.order import numbered
from tidemark.schemas import DAILY, conform


def usable(raw: DataFrame, observed: Observation | None = None) -> DataFrame:
    """Rows with a day and a count; ``observed`` counts those without (metric ``dropped``)."""
    lost = F.col("day").isNull() | F.col("n").isNull()
    if observed is not None:
        raw = raw.observe(observed, F.count_if(lost).alias("dropped"))
    return raw.where(~lost)


def aggregate_counts(raw: DataFrame, identity: DataFrame, observed: Observation | None = None) -> DataFrame:
    """Raw counts summed to (item, day) by the identity of their artifact; unknown artifacts drop out.

    The identity has one row for each artifact, so the join cannot repeat counts.
    """
    known = identity.select("artifact", "item").dropDuplicates(["artifact"])
    return usable(raw, observed).join(known, "artifact").groupBy("item", "day").agg(F.sum("n").cast("long").alias("n"))


def sum_partials(*parts: DataFrame) -> DataFrame:
    """Partial daily tables added up; how the counts were split makes no difference."""
    return reduce(DataFrame.unionByName, parts).groupBy("item", "day").agg(F.sum("n").cast("long").alias("n"))


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of both; where both have a key, that of ``new``."""
    fresh = new.select("item", "day", "n")
    kept = old.select("item", "day", "n").join(fresh.select("item", "day"), ["item", "day"], "left_anti")
    return kept.unionByName(fresh)


def keep_first(*sources: DataFrame) -> DataFrame:
    """One row for each key, from the first source that has it (within a source, the larger count)."""
    ranked = [s.select("item", "day", "n", F.lit(i).alias("source")) for i, s in enumerate(sources)]
    return keep_least_source(reduce(DataFrame.unionByName, ranked))


def keep_least_source(tagged: DataFrame) -> DataFrame:
    """``keep_first`` for one table of all sources, where ``source`` orders them; combined before the shuffle.

    A null count comes after all counts of its source.
    """
    order = F.struct("source", F.col("n").isNull().alias("none"), (-F.col("n")).alias("less"))
    return tagged.groupBy("item", "day").agg(F.min_by("n", order).alias("n"))


def year_extract(daily: DataFrame, year: int) -> DataFrame:
    """Rows of one year, by a range on the bare column that a scan can prune by."""
    return daily.where(F.col("day").between(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31))))


def recent_extract(daily: DataFrame, anchor: Column, days: int) -> DataFrame:
    """Rows from ``days`` before the anchor on, that day included; there is no upper end."""
    return daily.where(F.col("day") >= F.date_sub(anchor, days))


def years(daily: DataFrame) -> DataFrame:
    return daily.select(F.year("day").alias("year")).where("year is not null").distinct().orderBy("year")


def anchor_day(daily: DataFrame):
    """The last day that there is, or None."""
    return daily.agg(F.max("day")).first()[0]


def coverage(daily: DataFrame, *by: str) -> DataFrame:
    """Rows (null days too), first and last day."""
    return daily.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def shard_rows(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """``df`` with its shard: rows in a total order, dealt in turn. Without shards there are no rows.

    For mere parallelism, repartition.
    """
    if shards <= 0:
        return df.withColumn("shard", F.lit(0)).where(F.lit(False))
    return numbered(df, order, "_row").withColumn("shard", F.pmod("_row", F.lit(shards)).cast("int")).drop("_row")


def by_letter(items: DataFrame) -> DataFrame:
    return items.withColumn("letter", shard_letter("item"))


def as_daily(df: DataFrame) -> DataFrame:
    return conform(df, DAILY)
