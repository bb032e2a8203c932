import datetime
import hashlib
import os
import shutil
import sqlite3
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import Channel, Floors
from tidemark.plans import pipeline as L
from tidemark.sinks import commits as C
from tidemark.sinks import publish as P
from tidemark.streaming import upserts

D = datetime.date


def test_only_touched_years_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "daily")
    P.write_years(spark.createDataFrame([("a", D(2023, 1, 1), 1), ("a", D(2024, 1, 1), 2)], schemas.DAILY), path)
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{path}/year=2023") for f in fs}
    new = spark.createDataFrame([("a", D(2023, 1, 1), 9), ("a", D(2024, 1, 1), 3)], schemas.DAILY)
    P.write_years(new, path, only=[2024])
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{path}/year=2023") for f in fs}
    assert before == after
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]
    assert P.touched_years(new) == [2023, 2024]


def test_versions_and_notes(spark, tmp_path):
    folder = str(tmp_path)
    years = P.merge_coverage({"2023": {"rows": 1}, "2024": {"rows": 2}}, {"2024": {"rows": 3, "first_day": "2024-01-01", "last_day": None}})
    assert C.head(spark, folder) == (0, None)
    m = C.commit(spark, folder, {"run": {"mode": "live", "at": "2024-01-02T03:04:05Z"}, "parts": {"daily": years}, "rewritten": {"daily": ["2024"]}}, 0)
    assert C.head(spark, folder) == (1, m) and m["parts"]["daily"]["2023"] == {"rows": 1}
    text = P.notes(m)
    assert "2024-01-02 03:04:05 UTC" in text and "n/a" in text and text.index("| 2023 |") < text.index("| 2024 |") and "Rewritten: daily 2024" in text
    assert "Rewritten: none" in P.notes({**m, "rewritten": {}})
    with pytest.raises(C.Conflict):
        C.commit(spark, folder, {"run": {}}, 0)
    assert C.head(spark, folder) == (1, m)
    # A version that was never written to its end is passed over, and its number is not used again.
    (tmp_path / C.VERSIONS / "000000000002.json").write_text('{"run": ')
    assert C.head(spark, folder) == (2, m)
    assert C.commit(spark, folder, {"run": {}}, 2)["version"] == 3


def test_sqlite_export(spark, tmp_path):
    path = str(tmp_path / "out.db")
    daily = spark.createDataFrame([("a", D(2024, 1, 2), 3)], schemas.DAILY)
    marks = P.export_sqlite(path, {"daily": daily, "summary": spark.createDataFrame([], schemas.SUMMARY)}, {"daily": "day"})
    with open(path, "rb") as f:
        held = f.read()
    assert marks == {"bytes": len(held), "sha256": hashlib.sha256(held).hexdigest(), "rows": {"daily": 1, "summary": 0}}
    with sqlite3.connect(path) as db:
        assert db.execute("select * from daily").fetchall() == [("a", "2024-01-02", 3)] and db.execute("select count(*) from summary").fetchone() == (0,)


class Source:
    """Entries and counts of a small imaginary archive."""

    def __init__(self, spark, ledger=True):
        self.spark, self.time, self.ledger, self.broken, self.asked = spark, datetime.datetime(2024, 7, 1, tzinfo=datetime.timezone.utc), ledger, [], []
        self.listed = [("main", 1, "r-cran-abc", "1", "amd64"), ("main", 2, "r-cran-abc", "2", "amd64"), ("main", 3, "r-bioc-b", "1", "i386"), ("main", 4, "junk", "1", "amd64")]
        self.counted = [("main", "r-cran-abc", "1", D(2024, 6, 1), 5), ("main", "r-cran-abc", "2", D(2024, 6, 1), 7), ("main", "r-bioc-b", "1", D(2023, 5, 1), 2)]

    def io(self):
        return L.Io(now=lambda: self.time, entries=self.entries, counts=self.counts, ledgers=self.books)

    def entries(self, channels):
        return self.spark.createDataFrame([(*e, "Published", None) for e in self.listed], schemas.ENTRIES)

    def counts(self, roster):
        self.asked.append({(r.artifact, r.release, r.since) for r in roster.collect()})
        all_ = self.spark.createDataFrame(self.counted, schemas.RAW_COUNTS)
        failed = self.spark.createDataFrame([("main", *b) for b in self.broken], "channel string, artifact string, release string")
        rows = all_.join(roster.select("channel", "artifact", "release", "since"), ["channel", "artifact", "release"]).where(F.col("since").isNull() | (F.col("day") >= F.col("since"))).join(failed, ["channel", "artifact", "release"], "left_anti")
        return rows.select(*schemas.RAW_COUNTS.names), failed

    def books(self):
        if not self.ledger:
            return None
        row = lambda *x: self.spark.createDataFrame([x], schemas.LEDGER)
        return row("abc", "ABC", "live"), row("b", "B", "archived")


CHANNELS, FLOORS = [Channel("main", "x")], Floors(1, 1)
_FIRST: list[tuple[str, dict]] = []


def published(spark, folder):
    """A folder after the first run, which is made once and copied: the source, and the version."""
    if not _FIRST:
        made = tempfile.mkdtemp(prefix="spark-first-")
        _FIRST.append((made, L.refresh(spark, Source(spark).io(), made, CHANNELS, floors=FLOORS)))
    shutil.copytree(_FIRST[0][0], folder, dirs_exist_ok=True)
    return Source(spark), _FIRST[0][1]


def table(spark, folder, name):
    store = L.Store(spark, folder)
    assert store.damaged() == []
    if name == "releases":
        return store.read_roster()
    return store.read_years(name, schemas.DAILY) if name == "daily" else spark.read.parquet(store.path(name))


def test_cold_run_then_revision_then_heartbeat(spark, tmp_path):
    folder = str(tmp_path)
    src, m = published(spark, folder)
    assert m["tables"]["summary"]["rows"] == 2 and m["anchor"] == "2024-06-01" and m["rewritten"]["daily"] == ["2023", "2024"]
    assert {(r.item, r.day, r.n) for r in table(spark, folder, "daily").collect()} == {("abc", D(2024, 6, 1), 12), ("b", D(2023, 5, 1), 2)}
    # A late revision of one release leaves the other's counts alone; a release that fails keeps what it had.
    src.counted, src.broken = [("main", "r-cran-abc", "1", D(2024, 6, 1), 6)], [("r-cran-abc", "2")]
    src.time += datetime.timedelta(days=1)
    m = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    assert src.asked[-1] == {("r-cran-abc", "1", D(2024, 3, 3)), ("r-cran-abc", "2", D(2024, 3, 3))}
    assert {(r.item, r.n) for r in table(spark, folder, "daily").collect()} == {("abc", 13), ("b", 2)}
    assert m["rewritten"]["daily"] == ["2024"]
    # Nothing new: only the check moves on.
    src.counted, src.broken = [], []
    src.counted = [("main", "r-cran-abc", "1", D(2020, 1, 1), 6)]
    src.time += datetime.timedelta(days=1)
    h = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    assert h["run"]["mode"] == "unchanged" and h["rewritten"] == {} and h["data"] == m["data"] == {"version": 2, "at": "2024-07-02T00:00:00Z"} and h["parts"] == m["parts"] and h["version"] == 3


def test_a_refresh_leaves_untouched_years_alone_and_tells_of_damage(spark, tmp_path):
    folder = str(tmp_path)
    src, first = published(spark, folder)
    src.counted = [("main", "r-cran-abc", "1", D(2024, 6, 2), 4)]
    src.time += datetime.timedelta(days=1)
    m = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    for kind in ("facts", "daily"):
        assert m["parts"][kind]["2023"] == first["parts"][kind]["2023"] and m["parts"][kind]["2024"]["snapshot"] == m["tables"]["summary"]["snapshot"]
    assert not os.path.exists(tmp_path / m["tables"]["summary"]["snapshot"] / "daily" / "year=2023")
    assert {(r.artifact, r.release, r.n_total) for r in table(spark, folder, "releases").collect()} == {("r-cran-abc", "1", 9), ("r-cran-abc", "2", 7), ("r-bioc-b", "1", 2)}
    assert {(r.item, r.n_total) for r in table(spark, folder, "summary").collect()} == {("abc", 16), ("b", 2)}
    # A namespace that is preferred appears: the counts of the other one drop out of all years.
    src.listed, src.counted = [("main", 9, "r-cran-b", "1", "amd64")], [("main", "r-cran-b", "1", D(2024, 6, 3), 1)]
    src.time += datetime.timedelta(days=1)
    roster = L.Store(spark, folder).read_roster()
    identity = L.known_identity(roster).withColumn("item", F.when(F.col("artifact") != "r-bioc-b", F.col("item"))).where("item is not null")
    assert L.moved_years(L.Store(spark, folder), L.known_identity(roster), identity, {2024}) == {2023}
    file = next((tmp_path / first["parts"]["daily"]["2023"]["snapshot"] / "daily" / "year=2023").glob("*.parquet"))
    spark.createDataFrame([("b", D(2023, 5, 1), 3)], schemas.DAILY).coalesce(1).write.parquet(str(tmp_path / "other"))
    file.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    assert L.Store(spark, folder).damaged() == ["daily 2023"]


def test_runs_without_ledgers(spark, tmp_path):
    src = Source(spark, ledger=False)
    L.refresh(spark, src.io(), str(tmp_path), CHANNELS, floors=FLOORS)
    assert {(r.item, r.display_name, r.lifecycle) for r in table(spark, str(tmp_path), "summary").collect()} == {("abc", "abc", None), ("b", "b", None)}
    with pytest.raises(L.RunAborted):
        L.refresh(spark, src.io(), str(tmp_path), CHANNELS, reclassify=True, floors=FLOORS)
    src.ledger = True
    src.time += datetime.timedelta(days=1)
    m = L.refresh(spark, src.io(), str(tmp_path), CHANNELS, reclassify=True, floors=FLOORS)
    assert m["run"]["mode"] == "reclassify" and m["rewritten"]["daily"] == [] and m["data"]["version"] == 1
    assert {(r.item, r.display_name) for r in table(spark, str(tmp_path), "summary").collect()} == {("abc", "ABC"), ("b", "B")}


def test_history_is_protected_and_cold_runs_must_find_something(spark, tmp_path):
    src, _ = published(spark, str(tmp_path))
    snapshot = L.Store(spark, str(tmp_path)).parts("facts")["2023"]["snapshot"]
    os.rename(tmp_path / snapshot / "facts" / "year=2023", tmp_path / "gone")
    with pytest.raises(L.RunAborted, match="facts"):
        L.refresh(spark, src.io(), str(tmp_path), CHANNELS, floors=FLOORS)
    src.listed = src.listed[3:]
    with pytest.raises(L.RunAborted, match="no release"):
        L.refresh(spark, src.io(), str(tmp_path / "new"), CHANNELS, floors=FLOORS)


def test_backfill_is_complete_or_nothing(spark, tmp_path):
    src = Source(spark)
    src.broken = [("r-bioc-b", "1")]
    with pytest.raises(L.RunAborted, match="could not be read"):
        L.backfill(spark, src.io(), str(tmp_path / "a"), CHANNELS, FLOORS)
    assert C.head(spark, str(tmp_path / "a")) == (0, None)
    m = L.backfill(spark, src.io(), str(tmp_path / "b"), CHANNELS, FLOORS, require_complete=False)
    assert m["tables"]["summary"]["rows"] == 1
    assert {(r.artifact, r.release, r.done, r.n_total) for r in table(spark, str(tmp_path / "b"), "releases").collect()} == {("r-cran-abc", "1", True, 5), ("r-cran-abc", "2", True, 7), ("r-bioc-b", "1", False, None)}


def test_a_backfill_goes_on_where_it_stopped(spark, tmp_path):
    src, out, work = Source(spark), str(tmp_path / "out"), str(tmp_path / "work")
    src.broken = [("r-bioc-b", "1")]
    with pytest.raises(L.RunAborted, match="1 releases could not be read"):
        L.resumable_backfill(spark, src.io(), out, work, CHANNELS, FLOORS, waves=3)
    assert C.head(spark, out) == (0, None)
    src.broken, src.asked = [], []
    m = L.resumable_backfill(spark, src.io(), out, work, CHANNELS, FLOORS, waves=3)
    asked = set().union(*src.asked)
    assert ("r-bioc-b", "1", None) in asked and len(asked) < 3 and m["tables"]["summary"]["rows"] == 2
    assert {(r.item, r.n) for r in table(spark, out, "daily").collect()} == {("abc", 12), ("b", 2)}
    assert all(r.done for r in table(spark, out, "releases").collect())


def test_stream_of_count_files(spark, tmp_path):
    source, facts, ck = (str(tmp_path / x) for x in ("in", "facts", "ck"))
    row = lambda n: spark.createDataFrame([("m", "a", "1", D(2024, 1, 1), n), ("m", "a", "1", D(2024, 1, 1), 1), ("m", "a", "1", None, 1)], schemas.RAW_COUNTS)
    for n in (5, 8):
        row(n).coalesce(1).write.mode("append").parquet(source)
        upserts.start(spark, source, facts, ck).awaitTermination()
    assert [tuple(r) for r in upserts.current(spark, facts).collect()] == [("m", "a", "1", D(2024, 1, 1), 9)]
