"""Readers of the name universes: control files in stanzas, and directory indexes.

A universe is read from several addresses, files on any store that Spark reaches or
http(s) addresses. One that cannot be read contributes no names, and an
``Observation`` counts it under the universe's name, so that a universe with a part of
its names is told from a whole one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.files import exists
from tidemark.sources.pages import directories
from tidemark.sources.rest import follow_texts, get

TEXTS_DDL = "universe string, kind string, text string, failed boolean"
#: What parts two stanzas: an empty line, or several, which may have blanks.
_GAP = r"\n(?:[ \t\r]*\n)+"


@dataclass(frozen=True)
class Universe:
    """Names of one origin; ``kind`` is ``control`` (stanzas with a Package field) or ``index`` (links to directories)."""

    name: str
    kind: str
    addresses: tuple[str, ...]


def stanzas(texts: DataFrame) -> DataFrame:
    """The stanzas of control files (text), one a row, in no order; the other columns stay."""
    rows = texts.withColumn("text", F.explode(F.split(F.coalesce("text", F.lit("")), _GAP)))
    return rows.where("trim(text) <> ''")


def field(stanza: Column | str, name: str) -> Column:
    """The value of a field, its continuation lines (which begin with a blank) joined by one blank; null where there is none."""
    stanza = F.col(stanza) if isinstance(stanza, str) else stanza
    found = F.regexp_extract(stanza, rf"(?m)^{name}:([^\n]*(?:\n[ \t][^\n]*)*)", 1)
    value = F.trim(F.regexp_replace(F.regexp_replace(found, r"\r", ""), r"\n[ \t]+", " "))
    return F.when(value != "", value)


def texts(spark: SparkSession, universes: list[Universe], connections: int = 16, tries: int = 9, wait: float = 5.0, fetch: Callable[[str], str] = get) -> DataFrame:
    """universe, kind, text, failed: the texts of all addresses, and a row without text for each that can't be read.

    Control files come a stanza at a time where they have plain line ends, so a large one is read in parallel.
    """
    parts = [spark.createDataFrame([], TEXTS_DDL)]
    remote = []
    for u in universes:
        for address in u.addresses:
            tags = [F.lit(u.name).alias("universe"), F.lit(u.kind).alias("kind")]
            if address.startswith(("http://", "https://")):
                remote.append((u.name, u.kind, address))
            elif exists(spark, address):
                lines = spark.read.option("lineSep", "\n\n") if u.kind == "control" else spark.read.option("wholetext", "true")
                parts.append(lines.text(address).select(*tags, F.col("value").alias("text"), F.lit(False).alias("failed")))
            else:
                parts.append(spark.range(1).select(*tags, F.lit(None).cast("string").alias("text"), F.lit(True).alias("failed")))
    if remote:
        asked = spark.createDataFrame(remote, "universe string, kind string, url string")
        got = follow_texts(asked, connections, tries, wait, fetch)
        parts.append(asked.join(got, "url").select("universe", "kind", "text", (~F.col("ok")).alias("failed")))
    return reduce(DataFrame.unionByName, parts)


def universe_names(found: DataFrame, universes: list[Universe], observed: Observation | None = None) -> DataFrame:
    """universe and name, each once, of the texts of ``texts``; ``observed`` counts the failed addresses of each universe."""
    if observed is not None:
        found = found.observe(observed, *(F.count_if(F.col("failed") & (F.col("universe") == u)).alias(u) for u in sorted({u.name for u in universes})))
    control = F.transform(F.split("text", _GAP), lambda s: field(s, "Package"))
    names = F.when(F.col("kind") == "index", directories(F.col("text"))).otherwise(control)
    return found.where("not failed").select("universe", F.explode(names).alias("name")).where("name is not null").distinct()
