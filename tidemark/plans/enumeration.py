"""Listing the source in waves that a later run can go on with.

A frontier is a folder with what has been asked and what was answered. A wave takes names that were not
asked yet (an anti-join), writes its answers first and its mark last, so what
stands between two marks is committed as a whole: after a crash at most the open
wave is asked again, and nothing committed is lost or asked twice. Names that failed are
asked again once all others have been; while any is left the listing is not complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTRIES, conform, empty
from tidemark.sinks.files import delete, exists, names_in, write_text
from tidemark.sources import pages as P
from tidemark.sources.rest import whole_chains

#: One question: a channel, the name that is looked for (null: the whole channel), and the address that answers.
ASKS_DDL = "channel string, name string, url string"


class Incomplete(RuntimeError):
    """Questions that no pass could answer."""

    def __init__(self, left: int):
        super().__init__(f"{left} addresses could not be read; run again to go on")
        self.left = left


class Frontier:
    """The waves of one listing: ``found`` entries and ``asked`` questions by wave, and a mark once it is complete."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def current(cls, spark: SparkSession, folder: str) -> Frontier:
        """The open listing of a folder, or a new one where the last was completed."""
        done = sorted(int(n.split("=")[1]) for n in names_in(spark, folder) if n.startswith("listing="))
        if done:
            last = cls(spark, f"{folder}/listing={done[-1]}")
            if not last.complete():
                return last
        return cls(spark, f"{folder}/listing={done[-1] + 1 if done else 0}")

    def complete(self) -> bool:
        return exists(self.spark, f"{self.folder}/_COMPLETE")

    def close(self) -> None:
        write_text(self.spark, f"{self.folder}/_COMPLETE", "")

    def waves(self) -> list[int]:
        """The committed waves: those whose mark is whole."""
        named = [n for n in names_in(self.spark, f"{self.folder}/asked") if n.startswith("wave=")]
        return sorted(int(n.split("=")[1]) for n in named if exists(self.spark, f"{self.folder}/asked/{n}/_SUCCESS"))

    def _of(self, kind: str, schema) -> DataFrame:
        paths = [f"{self.folder}/{kind}/wave={k}" for k in self.waves()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def found(self) -> DataFrame:
        """The entries of all committed waves."""
        waves = self._of("found", ENTRIES)
        return conform(waves.distinct(), ENTRIES) if self.waves() else empty(self.spark, ENTRIES)

    def asked(self) -> DataFrame:
        """url and ok of every question, asked in whichever wave; ok if any answer was whole."""
        return self._of("asked", "url string, ok boolean").groupBy("url").agg(F.bool_or("ok").alias("ok"))

    def commit(self, asks: DataFrame, pages: DataFrame) -> None:
        """Write a wave: its pages (which asks the source), the entries of whole chains, then the mark."""
        wave = max(self.waves(), default=-1) + 1
        raw = f"{self.folder}/pages/wave={wave}"
        pages.write.mode("overwrite").parquet(raw)
        whole, bad = whole_chains(self.spark.read.parquet(raw))
        answered = whole.join(asks.select(F.col("url").alias("first_url"), "channel"), "first_url")
        P.published_entries(answered).write.mode("overwrite").parquet(f"{self.folder}/found/wave={wave}")
        failed = bad.select(F.col("first_url").alias("url"), F.lit(True).alias("failed"))
        asks.select("url").join(failed, "url", "left").select("url", F.col("failed").isNull().alias("ok")).write.mode("overwrite").parquet(f"{self.folder}/asked/wave={wave}")
        delete(self.spark, raw)


def enumerate_all(frontier: Frontier, asks: DataFrame, look: Callable[[DataFrame], DataFrame], batch: int = 20_000, retries: int = 1, force: bool = False) -> DataFrame:
    """The entries that answer all of ``asks``, listed from where an earlier run stopped.

    ``look`` gives the pages of the chains of some asks, see ``rest.follow``. New questions go
    in waves of about ``batch``; failed ones follow in up to ``retries`` waves of their own.
    Questions that are still open raise, unless ``force``.
    """
    asks = asks.dropDuplicates(["url"])

    def wave(some: DataFrame) -> None:
        frontier.commit(some, look(some))

    new = asks.join(frontier.asked(), "url", "left_anti")
    waves = -(-new.count() // batch)
    for k in range(waves):
        part = asks.where(F.pmod(F.xxhash64("url"), F.lit(waves)) == k).join(frontier.asked(), "url", "left_anti")
        if not part.isEmpty():
            wave(part)
    for _ in range(retries):
        open_ = still_open(frontier, asks)
        if open_.isEmpty():
            break
        wave(open_)
    left = still_open(frontier, asks).count()
    if left and not force:
        raise Incomplete(left)
    frontier.close()
    return frontier.found()


def still_open(frontier: Frontier, asks: DataFrame) -> DataFrame:
    """The questions without a whole answer."""
    return asks.join(frontier.asked().where("ok"), "url", "left_anti")
