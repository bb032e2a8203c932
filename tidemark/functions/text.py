"""Column functions on names, addresses and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import PREFIXES


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def source_id(link: Column | str) -> Column:
    """The number after ``+binarypub/``; null without one or beyond 64 bits."""
    return trailing_id(link, r"\+binarypub/")


def trailing_id(link: Column | str, marker: str) -> Column:
    return F.regexp_extract(_c(link), marker + r"([0-9]+)", 1).try_cast("bigint")


def last_segment(link: Column | str) -> Column:
    """What follows the last slash; null stays null."""
    return F.substring_index(_c(link), "/", -1)


def encode_ref(ref: Column | str) -> Column:
    """Percent-encoding of a whole reference; a blank is %20."""
    return F.replace(F.url_encode(_c(ref)), F.lit("+"), F.lit("%20"))


def namespace_of(artifact: Column | str) -> Column:
    """cran, bioc, other, or null; prefixes count case-sensitively."""
    out = F.lit(None).cast("string")
    for name, prefix in reversed(PREFIXES.items()):
        out = F.when(_c(artifact).startswith(prefix), F.lit(name)).otherwise(out)
    return out


def item_token(artifact: Column | str) -> Column:
    """The lower-cased name without its prefix."""
    return F.lower(F.regexp_replace(_c(artifact), "^(" + "|".join(PREFIXES.values()) + ")", ""))


def preference(namespace: Column | str) -> Column:
    """0 for the namespace that wins, then 1, 2; unknown ones last."""
    out = F.lit(len(PREFIXES))
    for i, name in reversed(list(enumerate(PREFIXES))):
        out = F.when(_c(namespace) == name, F.lit(i)).otherwise(out)
    return out


def shard_letter(item: Column | str) -> Column:
    """The lower-cased first letter if it is a to z, else 0."""
    first = F.lower(F.substring(_c(item), 1, 1))
    return F.when(first.rlike("^[a-z]$"), first).otherwise(F.lit("0"))


def iso_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_tag(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "'v'yyyyMMdd-HHmmss")


def shown_time(iso: Column | str) -> Column:
    """An ISO time for reading; n/a where there is none."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(_c(iso), "T", " "), "Z$", " UTC"), F.lit("n/a"))


def shard_file(prefix: str, year: Column | str) -> Column:
    return F.format_string(f"{prefix}-%04d.parquet", _c(year))


def percent_change(now: Column, before: Column) -> Column:
    """Change in per cent to two places, half to even; null without a base."""
    return F.when(before > 0, F.bround((now / before - 1) * 100, 2))
