"""Facts: one count for each channel, artifact, release and day, from which daily counts are derived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.daily import usable
from tidemark.operators.releases import KEY

FACT_KEY = [*KEY, "day"]


def facts_of(raw: DataFrame) -> DataFrame:
    """Raw counts as facts: several rows of a day are added."""
    return usable(raw).groupBy(*FACT_KEY).agg(F.sum("n").cast("long").alias("n"))


def upsert_facts(old: DataFrame, new: DataFrame) -> DataFrame:
    """The facts of both; where both have a key, the new one. Days that ``new`` lacks stay."""
    return old.join(new.select(*FACT_KEY), FACT_KEY, "left_anti").unionByName(new)


def asked_for(facts: DataFrame, read: DataFrame) -> DataFrame:
    """The facts in the intervals that were read: of each release of ``read``, from its ``since`` on (null: all)."""
    asked = read.select(*KEY, F.col("since").alias("_since"))
    return facts.join(asked, KEY).where(F.col("_since").isNull() | (F.col("day") >= F.col("_since"))).select(*facts.columns)


def replace_intervals(old: DataFrame, new: DataFrame, read: DataFrame) -> DataFrame:
    """``old`` with the intervals that were read replaced as a whole by ``new``.

    A day that the source has withdrawn, one in an interval without a new fact, goes;
    facts before an interval and of other releases stay, also where ``new`` has none.
    """
    asked = read.select(*KEY, F.col("since").alias("_since"), F.lit(True).alias("_read"))
    kept = old.join(asked, KEY, "left").where(F.col("_read").isNull() | (F.col("day") < F.col("_since"))).select(*old.columns)
    return upsert_facts(kept, new)
