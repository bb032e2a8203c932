"""Effects of a run over a paged REST source: what joins addresses, pages, universes and ledgers.

    io = live_io(spark, Source(api="https://...", work="hdfs://.../work", channels=channels, universes=[...], ledgers={...}))
    refresh(spark, io, folder, channels)

Everything that is fetched is written to ``work`` before it is used, so the source is
asked once however often Spark reads the answers, and a lost executor costs no request.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Channel
from tidemark.operators import names as N
from tidemark.operators.releases import KEY
from tidemark.plans.enumeration import ASKS_DDL, Frontier, enumerate_all
from tidemark.plans.pipeline import Io
from tidemark.schemas import LEDGER, RAW_COUNTS, conform
from tidemark.sources import pages as P
from tidemark.sources import rest, sqlite
from tidemark.sources import urls as U
from tidemark.sources.universes import Universe, texts, universe_names

#: How channels are listed: by looking up candidate names, or whole; or only some names, to try a source.
MODES = ("names", "archives", "trial")


@dataclass
class Source:
    """A source and the folder (on a store that executors share) for what is fetched from it."""

    api: str
    work: str
    channels: list[Channel]
    mode: str = "names"
    universes: list[Universe] = field(default_factory=list)
    #: The namespace that a universe's names belong to, by the universe's name.
    namespaces: dict[str, str] = field(default_factory=dict)
    #: Full artifact names that are always looked for, and those that a trial looks for alone.
    extras: tuple[str, ...] = ()
    trial: tuple[str, ...] = ()
    #: SQLite files and tables of the ledgers: {"cran": (path, table), "bioc": (path, table)}.
    ledgers: dict[str, tuple[str, str]] = field(default_factory=dict)
    connections: int = 16
    passes: int = 4
    pause: float = 3.0
    page_size: int = 300
    force_incomplete: bool = False
    now: Callable[[], datetime.datetime] = lambda: datetime.datetime.now(datetime.timezone.utc)
    fetch: Callable[[str], str] = rest.get

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"no such mode: {self.mode}")


@dataclass
class Report:
    """What a run could not read: failed addresses by universe."""

    universes: dict[str, int] = field(default_factory=dict)


def candidates(spark: SparkSession, source: Source, report: Report | None = None) -> DataFrame:
    """The distinct artifact names to look for (name), with what could not be read in ``report``."""
    if source.mode == "trial":
        return spark.createDataFrame([(n,) for n in source.trial], "name string").distinct()
    names = spark.createDataFrame([], "universe string, name string")
    if source.universes:
        observed = Observation()
        path = f"{source.work}/names-{uuid.uuid4().hex}"
        universe_names(_look_texts(spark, source), source.universes, observed).write.parquet(path)
        if report is not None:
            report.universes = {k: v for k, v in observed.get.items() if v}
        names = spark.read.schema(names.schema).parquet(path)
    parts = [N.prefixed(names.where(F.col("universe") == u), namespace) for u, namespace in sorted(source.namespaces.items())]
    parts.append(spark.createDataFrame([(n,) for n in source.extras], "name string"))
    return reduce(DataFrame.union, parts).distinct()


def _look_texts(spark: SparkSession, source: Source) -> DataFrame:
    return texts(spark, source.universes, source.connections, tries=source.passes, wait=source.pause, fetch=source.fetch)


def asks(spark: SparkSession, source: Source, channels: list[Channel], report: Report | None = None) -> DataFrame:
    """The questions that list the channels: one a name and channel, or one a channel."""
    if source.mode == "archives":
        parts = [spark.range(1).select(F.lit(c.key).alias("channel"), F.lit(None).cast("string").alias("name"), U.listing_url(source.api, F.lit(c.ref), 0, source.page_size).alias("url")) for c in channels]
    else:
        names = candidates(spark, source, report)
        parts = [names.select(F.lit(c.key).alias("channel"), "name", U.name_url(source.api, F.lit(c.ref), F.col("name"), source.page_size).alias("url")) for c in channels]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], ASKS_DDL))


def live_io(spark: SparkSession, source: Source, report: Report | None = None) -> Io:
    """``Io`` over ``source``. Listings go on where an earlier run stopped; ``report`` learns what could not be read."""

    refs = F.create_map(*(F.lit(x) for c in source.channels for x in (c.key, c.ref)))

    def look(asked: DataFrame) -> DataFrame:
        return rest.follow(asked, source.connections, tries=1, fetch=source.fetch, passes=source.passes, pause=source.pause)

    def entries(channels: list[Channel]) -> DataFrame:
        frontier = Frontier.current(spark, f"{source.work}/listings")
        return enumerate_all(frontier, asks(spark, source, channels, report), look, force=source.force_incomplete)

    def counts(roster: DataFrame) -> tuple[DataFrame, DataFrame]:
        base = f"{source.work}/counts-{uuid.uuid4().hex}"
        url = U.counts_url(source.api, refs[F.col("channel")], F.col("source_id"), F.col("since"), source.page_size)
        asked = roster.where("source_id is not null").select(*KEY, url.alias("url"))
        asked.write.parquet(f"{base}/asked")
        asked = spark.read.schema(asked.schema).parquet(f"{base}/asked")
        pages = look(asked)
        pages.write.parquet(f"{base}/pages")
        whole, bad = rest.whole_chains(spark.read.schema(pages.schema).parquet(f"{base}/pages"))
        answered = whole.join(asked.select(F.col("url").alias("first_url"), "channel").distinct(), "first_url")
        rows = conform(P.count_rows(answered), RAW_COUNTS)
        failed = asked.join(bad.select(F.col("first_url").alias("url")), "url", "left_semi").select(*KEY)
        unasked = roster.where("source_id is null").select(*KEY)
        return rows, failed.unionByName(unasked)

    def books() -> tuple[DataFrame, DataFrame] | None:
        if set(source.ledgers) != {"cran", "bioc"}:
            return None
        loaded = [sqlite.load(spark, *source.ledgers[k], LEDGER) for k in ("cran", "bioc")]
        return loaded[0], loaded[1]

    return Io(now=source.now, entries=entries, counts=counts, ledgers=books, complete=True)
