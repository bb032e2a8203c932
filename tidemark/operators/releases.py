"""The roster of releases, and what has been fetched of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import PREFERRED_ARCH, WINDOWS
from tidemark.operators.identity import resolve
from tidemark.schemas import RELEASES, conform

KEY = ["channel", "artifact", "release"]


def dedup(entries: DataFrame) -> DataFrame:
    """One entry for each release: of the preferred architecture if there is one, then the least source id."""
    order = F.struct(F.coalesce(F.col("arch") != PREFERRED_ARCH, F.lit(True)).alias("other"), F.col("source_id").isNull().alias("none"), "source_id", "arch")
    rest = [c for c in entries.columns if c not in KEY]
    best = entries.groupBy(*KEY).agg(F.min_by(F.struct(*rest), order).alias("best"))
    return best.select(*(F.col(c) if c in KEY else F.col("best")[c].alias(c) for c in entries.columns))


def build_roster(entries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Releases of resolved artifacts, nothing of them fetched yet."""
    identity = resolve(entries, ledger)
    rows = dedup(entries).join(identity, "artifact")
    return conform(rows.withColumns({"n_total": F.lit(None), "last_day": F.lit(None), "done": F.lit(False)}), RELEASES)


def append_missing(roster: DataFrame, found: DataFrame) -> DataFrame:
    """The roster and the releases that it lacks; rows that it has stay."""
    return roster.unionByName(found.join(roster.select(*KEY), KEY, "left_anti"))


def enrich(roster: DataFrame, identity: DataFrame) -> DataFrame:
    """Names and lifecycle anew where the artifact is resolved; other rows stay as they are."""
    new = identity.select("artifact", *(F.col(c).alias(f"_{c}") for c in ("item", "namespace", "display_name", "lifecycle")))
    hit = F.col("_item").isNotNull()
    joined = roster.join(new, "artifact", "left")
    return joined.withColumns({c: F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("item", "namespace", "display_name", "lifecycle")}).select(*roster.columns)


def is_active(today: Column, force: bool = False, days: int = WINDOWS.active) -> Column:
    """Whether a release is to be fetched again."""
    if force:
        return F.lit(True)
    return ~F.coalesce("done", F.lit(False)) | F.col("last_day").isNull() | (F.col("last_day") >= F.date_sub(today, days))


def active_tail(roster: DataFrame, today: Column, force: bool = False) -> DataFrame:
    return roster.where(is_active(today, force))


def lower_bound(force: bool = False, days: int = WINDOWS.revision) -> Column:
    """The first day to ask the source for; null asks for all."""
    return F.lit(None).cast("date") if force else F.date_sub("last_day", days)


def record_fetch(roster: DataFrame, fetched: DataFrame) -> DataFrame:
    """Last days moved on and releases marked done, for the keys in ``fetched`` (with day, null if it had no rows)."""
    seen = fetched.groupBy(*KEY).agg(F.max("day").alias("_day"), F.lit(True).alias("_seen"))
    joined = roster.join(seen, KEY, "left")
    return joined.withColumns({"last_day": F.greatest("last_day", "_day"), "done": F.coalesce("_seen", "done")}).select(*roster.columns)


def fill_totals(roster: DataFrame, raw: DataFrame) -> DataFrame:
    """The count of each release over all its days; null where nothing was counted."""
    totals = raw.groupBy(*KEY).agg(F.sum("n").cast("long").alias("_n"))
    return roster.join(totals, KEY, "left").withColumn("n_total", F.col("_n")).select(*roster.columns)


def move_totals(roster: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals moved on by what some days' counts have changed; a release without a change keeps its total."""
    signed = before.select(*KEY, (-F.col("n")).alias("n")).unionByName(after.select(*KEY, "n"))
    moved = signed.groupBy(*KEY).agg(F.sum("n").cast("long").alias("_n"))
    total = F.when(F.col("_n").isNull(), F.col("n_total")).otherwise(F.coalesce("n_total", F.lit(0)) + F.col("_n"))
    return roster.join(moved, KEY, "left").withColumn("n_total", total).select(*roster.columns)


def never_counted(roster: DataFrame) -> DataFrame:
    """Releases that were fetched without a row; they stay active."""
    return roster.where("done and last_day is null")
