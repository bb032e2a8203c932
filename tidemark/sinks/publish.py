"""Publishing: tables in parts (years, buckets), their marks, notes, and SQLite copies."""

from __future__ import annotations

import datetime
import hashlib
import os
import sqlite3
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.daily import coverage
from tidemark.operators.releases import KEY
from tidemark.schemas import require_key


def write_years(daily: DataFrame, path: str, only: Iterable[int] | None = None) -> None:
    """Write daily rows by year; ``only`` rewrites just these years and leaves the others' files alone.

    ``daily`` must not read from ``path``.
    """
    rows = daily.withColumn("year", F.year("day"))
    if only is not None:
        rows = rows.where(F.col("year").isin(sorted(only)))
    write_parts(rows, path, "year", *(("item", "day") if "item" in rows.columns else ()))


def write_parts(rows: DataFrame, path: str, by: str, *sort: str) -> None:
    """Write ``rows`` in a folder for each value of ``by``; folders of other values stay."""
    # Rebalancing gives a part as many files as its bytes ask for, so no part is one task's work.
    even = rows.hint("rebalance", by)
    even = even.sortWithinPartitions(*sort) if sort else even
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_table(df: DataFrame, path: str, *key: str) -> DataFrame:
    """Write a whole table and return it as read again, once the key of what was written holds."""
    df.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return require_key(written, *key) if key else written


def touched_years(delta: DataFrame) -> list[int]:
    return [r[0] for r in delta.select(F.year("day")).where(F.year("day").isNotNull()).distinct().orderBy(F.year("day")).collect()]


def with_bucket(roster: DataFrame, buckets: int) -> DataFrame:
    """The roster with the bucket that the hash of a release's key puts it in."""
    return roster.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int"))


def changed_buckets(new: DataFrame, old: DataFrame, buckets: int) -> DataFrame:
    """All rows (with ``bucket``) of the buckets in which some row of ``new`` is not, in all columns, one of ``old``.

    One pass: rows meet their old state by key, and a bucket's rows learn of each
    other in the shuffle that its files need anyway.
    """
    rest = [c for c in new.columns if c not in KEY]
    before = old.select(*KEY, F.struct(*rest).alias("_old"))
    joined = with_bucket(new, buckets).join(before, KEY, "left").withColumn("_changed", ~F.col("_old").eqNullSafe(F.struct(*rest)))
    moved = joined.groupBy("bucket").agg(F.bool_or("_changed").alias("_moved")).where("_moved").select("bucket")
    return joined.join(F.broadcast(moved), "bucket", "left_semi").select(*new.columns, "bucket")


def _checksum(df: DataFrame, but: Iterable[str] = ("year", "bucket")) -> Column:
    """Of rows in any order: the sum of their hashes, as decimal text."""
    return F.coalesce(F.sum(F.xxhash64(*sorted(c for c in df.columns if c not in but)).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")


def table_marks(df: DataFrame) -> dict:
    """Rows and checksum of a written table, by which a reader can tell that it is whole."""
    return df.agg(F.count(F.lit(1)).alias("rows"), _checksum(df)).first().asDict()


def part_marks(df: DataFrame, by: str) -> dict[str, dict]:
    """Rows and checksum of each part of a table that has its parts' column."""
    rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), _checksum(df, (by,))).collect()
    return {f"{r[by]:04d}": {"rows": r["rows"], "checksum": r["checksum"]} for r in sorted(rows, key=lambda r: r[by])}


def year_coverage(daily: DataFrame) -> dict[str, dict]:
    """Rows, days and checksum by year, as a version holds them."""
    dated = daily.withColumn("year", F.year("day")).where("year is not null")
    rows = coverage(dated, "year").join(dated.groupBy("year").agg(_checksum(daily)), "year").collect()
    return {f"{r['year']:04d}": {"rows": r["rows"], "first_day": str(r["first_day"]), "last_day": str(r["last_day"]), "checksum": r["checksum"]} for r in sorted(rows, key=lambda r: r["year"])}


def merge_coverage(old: dict[str, dict], new: dict[str, dict]) -> dict[str, dict]:
    """The old map with the new entries over it."""
    return {**old, **new}


def iso(at: datetime.datetime) -> str:
    return at.astimezone(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def notes(content: dict) -> str:
    """A version for readers, as Markdown."""

    def shown_time(value: str | None) -> str:
        return (value or "n/a").replace("T", " ").replace("Z", " UTC")

    run, data = content.get("run") or {}, content.get("data") or {}
    lines = [f"Version {content.get('version', 'n/a')}, a {run.get('mode', 'n/a')} run at {shown_time(run.get('at'))}.", f"Rows last changed in version {data.get('version', 'n/a')}, at {shown_time(data.get('at'))}.", ""]
    lines += [f"- {name}: {t.get('rows', 'n/a')} rows" for name, t in sorted((content.get("tables") or {}).items())]
    lines += ["", "Rewritten: " + (", ".join(f"{table} {' '.join(parts)}" for table, parts in sorted((content.get("rewritten") or {}).items()) if parts) or "none"), ""]
    lines += ["| daily counts of | first day | last day | rows |", "| --- | --- | --- | --- |"]
    years = (content.get("parts") or {}).get("daily") or {}
    lines += [f"| {y} | {c.get('first_day') or 'n/a'} | {c.get('last_day') or 'n/a'} | {c.get('rows', 'n/a')} |" for y, c in sorted(years.items())]
    return "\n".join([*lines, ""])


def file_sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def file_marks(path: str) -> dict:
    """By what a copy of a file shows that it is whole."""
    return {"bytes": os.path.getsize(path), "sha256": file_sha256(path)}


def export_sqlite(path: str, tables: dict[str, DataFrame], indexes: dict[str, str] | None = None) -> dict:
    """Small tables as one SQLite file on the driver, replaced as a whole; rows arrive a partition at a time.

    Returns the file's marks and the rows that each table got.
    """
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL"}
    new = f"{path}.new"
    if os.path.exists(new):
        os.remove(new)
    rows = {}
    db = sqlite3.connect(new)
    for name, df in tables.items():
        plain = df.select(*(F.col(c).cast("string").alias(c) if t in ("date", "timestamp") else F.col(c) for c, t in df.dtypes))
        columns = ", ".join(f'"{c}" {kinds.get(t, "TEXT")}' for c, t in plain.dtypes)
        db.execute(f'create table "{name}" ({columns})')
        db.executemany(f'insert into "{name}" values ({", ".join("?" * len(plain.columns))})', (tuple(r) for r in plain.toLocalIterator()))
        rows[name] = db.execute(f'select count(*) from "{name}"').fetchone()[0]
        if indexes and name in indexes:
            db.execute(f'create index "{name}_{indexes[name]}" on "{name}" ("{indexes[name]}")')
    db.commit()
    db.execute("vacuum")
    db.close()
    os.replace(new, path)
    return {**file_marks(path), "rows": rows}
