"""Typed listings of the source as Spark tables whose filters go into the addresses.

``published_entries`` has the entries of archives: an equality of ``channel`` or
``artifact`` (or a list of values) asks for just these, and one of ``status`` is passed on.
``release_counts`` has the daily counts of releases: it needs the ``source_id``s that it
is to read, as a filter, and a lower bound of ``day`` is passed on as the first day.
Spark applies every filter again, so a source that heeds none gives the same rows.
Use the functions rather than the formats: they read in one scan, see ``frozen.pushing``.

A chain that breaks fails the read, as a table with a part of its rows would pass
for the whole; use ``rest.follow`` where failures are to be listed instead.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition

from tidemark.frozen import frozen, pushing
from tidemark.sources import rest
from tidemark.sources.urls import counts_address, listing_address

ENTRIES_DDL = "channel string, source_id long, artifact string, release string, arch string, status string, published string"
COUNTS_DDL = "channel string, source_id long, artifact string, release string, day date, n long"


class _Asks(InputPartition):
    """Channel, what is asked for in it, and first address of each chain that a task follows."""

    def __init__(self, asks: list[tuple]):
        super().__init__(None)
        self.asks = asks


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.api, self.size = options["api"], int(options.get("size", "300"))
        self.channels: dict[str, str] = json.loads(options["channels"])
        self.connections = max(1, int(options.get("connections", "16")))
        self.tasks = max(1, int(options.get("partitions", "4")))
        self.passes, self.pause = int(options.get("passes", "4")), float(options.get("pause", "3"))
        self.wanted: dict[str, set] = {}
        self.since: datetime.date | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.attribute == ("day",):
                self.since = f.value if self.since is None else max(self.since, f.value)
            yield f

    def asks(self) -> list[tuple]:
        raise NotImplementedError

    def rows(self, channel: str, what: str | int | None, entries: list[dict]) -> Iterator[tuple]:
        raise NotImplementedError

    def open_channels(self) -> dict[str, str]:
        return {k: ref for k, ref in self.channels.items() if "channel" not in self.wanted or k in self.wanted["channel"]}

    def partitions(self) -> list[InputPartition]:
        asks = self.asks()
        tasks, _ = rest.shares(self.connections, min(self.tasks, max(1, len(asks))))
        return [_Asks(asks[i::tasks]) for i in range(tasks)]

    def read(self, partition: _Asks) -> Iterator[tuple]:
        _, pool = rest.shares(self.connections, self.tasks)
        of = {url: (channel, what) for channel, what, url in partition.asks}
        held: dict[str, list[tuple]] = {}  # of open chains, whose rows count once they are whole
        for first, _, text, ok, k in rest.passes_over(of, rest.get, pool, self.passes, self.pause):
            if ok:
                page = json.loads(text)
                held.setdefault(first, []).extend(self.rows(*of[first], page.get("entries") or []))
                if not page.get("next_collection_link"):
                    yield from held.pop(first)
            elif k + 1 < self.passes:
                held.pop(first, None)  # the chain begins anew
            else:
                raise OSError(f"a listing broke off: {first}")


def _last(link: str | None) -> str | None:
    return None if link is None else link.rsplit("/", 1)[-1]


class _Entries(_Reader):
    def asks(self) -> list[tuple]:
        status = next(iter(self.wanted["status"])) if len(self.wanted.get("status", ())) == 1 else None
        names = sorted(self.wanted["artifact"]) if "artifact" in self.wanted else [None]
        return [(k, name, listing_address(self.api, ref, status, name, self.size)) for k, ref in self.open_channels().items() for name in names]

    def rows(self, channel: str, what: str | None, entries: list[dict]) -> Iterator[tuple]:
        """A source that does not heed the name answers several questions with the same rows, so others are left out here."""
        for e in (e for e in entries if what is None or e.get("binary_package_name") == what):
            number = (e.get("self_link") or "").partition("+binarypub/")[2].split("/")[0]
            yield channel, int(number) if number.isdigit() else None, e.get("binary_package_name"), e.get("binary_package_version"), _last(e.get("distro_arch_series_link")), e.get("status"), e.get("date_published")


class _Counts(_Reader):
    def asks(self) -> list[tuple]:
        if "source_id" not in self.wanted:
            raise ValueError("release_counts needs an equality or a list of source_id")
        since = self.since.isoformat() if self.since else None
        return [(k, i, counts_address(self.api, ref, i, since, self.size)) for k, ref in self.open_channels().items() for i in sorted(self.wanted["source_id"])]

    def rows(self, channel: str, what: int, entries: list[dict]) -> Iterator[tuple]:
        for e in entries:
            day = e.get("day")
            yield channel, what, e.get("binary_package_name"), e.get("binary_package_version"), datetime.date.fromisoformat(day) if day else None, e.get("count")


class PublishedEntries(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published_entries"

    def schema(self) -> str:
        return ENTRIES_DDL

    def reader(self, schema) -> DataSourceReader:
        return _Entries(self.options)


class ReleaseCounts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "release_counts"

    def schema(self) -> str:
        return COUNTS_DDL

    def reader(self, schema) -> DataSourceReader:
        return _Counts(self.options)


def _read(spark: SparkSession, source: type[DataSource], api: str, channels: dict[str, str], condition: Column | str | None, options: dict) -> DataFrame:
    spark.dataSource.register(source)
    with pushing(spark):
        rows = spark.read.format(source.name()).options(api=api, channels=json.dumps(channels), **options).load()
        return frozen(rows if condition is None else rows.where(condition))


def published_entries(spark: SparkSession, api: str, channels: dict[str, str], condition: Column | str | None = None, **options) -> DataFrame:
    """The entries of the channels (key: reference) for which ``condition`` holds, asked for now and once; see the module for what goes into the addresses."""
    return _read(spark, PublishedEntries, api, channels, condition, options)


def release_counts(spark: SparkSession, api: str, channels: dict[str, str], condition: Column | str, **options) -> DataFrame:
    """The counts for which ``condition`` holds, which has to name the releases by ``source_id``."""
    return _read(spark, ReleaseCounts, api, channels, condition, options)
