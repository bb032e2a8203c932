"""The ranked rolling-window summary: one row for each item."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_NAMESPACE, WINDOWS
from tidemark.functions.text import percent_change
from tidemark.operators.order import ranks
from tidemark.schemas import SUMMARY, conform


def window_totals(daily: DataFrame, anchor: datetime.date | Column) -> DataFrame:
    """First and last day, the total, and windowed totals, in one pass.

    A window of N days takes the anchor and the N days before it; the previous
    one the days strictly between 60 and 30 before the anchor.
    """
    a = anchor if isinstance(anchor, Column) else F.lit(anchor)
    day, n = F.col("day"), F.col("n")
    since = [F.sum(F.when(day >= F.date_sub(a, w), n).otherwise(0)).cast("long").alias(f"total_{w}d") for w in (30, 90, 365)]
    before = F.sum(F.when((day > F.date_sub(a, 60)) & (day < F.date_sub(a, 30)), n).otherwise(0)).cast("long")
    return daily.groupBy("item").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("n").cast("long").alias("n_total"), *since, before.alias("prev_30d"))


def averages(totals: DataFrame) -> DataFrame:
    return totals.withColumns({"avg_daily_30d": F.bround(F.col("total_30d") / 30, 2), "trend": percent_change(F.col("total_30d"), F.col("prev_30d"))})


def with_identity(totals: DataFrame, identity: DataFrame) -> DataFrame:
    """Identity by item, joined after the aggregation; unknown items belong to the default namespace."""
    order = Window.partitionBy("item").orderBy("artifact") if "artifact" in identity.columns else Window.partitionBy("item").orderBy("namespace", "display_name")
    first = identity.withColumn("_at", F.row_number().over(order)).where("_at = 1").select("item", "namespace", "display_name", "lifecycle")
    joined = totals.join(first, "item", "left")
    return joined.withColumns({"namespace": F.coalesce("namespace", F.lit(DEFAULT_NAMESPACE)), "display_name": F.coalesce("display_name", "item"), "item_lower": F.lower("item")})


def carry_forward(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Items of the prior summary that have no current rows, with empty windows; first days are the earliest ever."""
    gone = prior.join(current.select("item"), "item", "left_anti").withColumns({"total_30d": F.lit(0), "total_90d": F.lit(0), "total_365d": F.lit(0), "avg_daily_30d": F.lit(0.0), "trend": F.lit(None)})
    older = prior.select("item", F.col("first_day").alias("_first"))
    kept = current.join(older, "item", "left").withColumn("first_day", F.least("first_day", "_first"))
    return conform(kept, SUMMARY).unionByName(conform(gone, SUMMARY))


def ranked(summary: DataFrame) -> DataFrame:
    """Ranks by each window, ties sharing the least; no task sees all items."""
    return ranks(summary, {f"total_{w}d": f"rank_{w}d" for w in (30, 90, 365)})


def item_state(daily: DataFrame, *by: Column) -> DataFrame:
    """First and last day and the total of each item (and of each value of ``by``): what the summary keeps of days that its windows have left behind.

    States of disjoint sets of rows merge into that of all rows, see ``merged_state``.
    """
    return daily.groupBy("item", *by).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("n").cast("long").alias("n"))


def merged_state(states: DataFrame) -> DataFrame:
    return states.groupBy("item").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("n").cast("long").alias("n_total"))


def open_days(anchor: datetime.date) -> datetime.date:
    """The first day that a window of the summary can still see."""
    return anchor - datetime.timedelta(days=max(WINDOWS.summary))


def totals_from_state(states: DataFrame, recent: DataFrame, anchor: datetime.date) -> DataFrame:
    """``window_totals`` of a history, from states that cover all of it and its daily rows from ``open_days`` on."""
    windows = window_totals(recent.where(F.col("day") >= F.lit(open_days(anchor))), anchor).drop("first_day", "last_day", "n_total")
    joined = merged_state(states).join(windows, "item", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in windows.columns if c != "item"})


def build(daily: DataFrame, identity: DataFrame, anchor: datetime.date | Column, prior: DataFrame | None = None) -> DataFrame:
    """The summary of all items, ordered by the 30-day rank, then name."""
    return summarized(window_totals(daily, anchor), identity, prior)


def build_from_state(states: DataFrame, recent: DataFrame, identity: DataFrame, anchor: datetime.date, prior: DataFrame | None = None) -> DataFrame:
    """``build`` without the daily rows that no window sees: ``states`` stand for them, see ``totals_from_state``."""
    return summarized(totals_from_state(states, recent, anchor), identity, prior)


def summarized(totals: DataFrame, identity: DataFrame, prior: DataFrame | None) -> DataFrame:
    """The summary of windowed totals, with the items of ``prior`` that have none."""
    current = with_identity(averages(totals), identity)
    rows = carry_forward(current, prior) if prior is not None else conform(current, SUMMARY)
    return conform(ranked(rows), SUMMARY).orderBy("rank_30d", "item")


def top(summary: DataFrame, k: int, by: str = "rank_30d") -> DataFrame:
    """The first k by a rank, or the largest by a total; ties by name."""
    order = F.col(by) if by.startswith("rank") else F.desc(by)
    return summary.orderBy(order, "item").limit(k)
