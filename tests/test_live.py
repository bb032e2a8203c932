import datetime
import sqlite3

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.test_pushdown import Archive, count, entry
from tidemark.config import Channel, Floors
from tidemark.plans import enumeration as E
from tidemark.plans import live
from tidemark.plans import pipeline as L
from tidemark.sources import rest
from tidemark.sources import universes as V

D = datetime.date
CONTROL = "Package: Abc\nVersion: 1\nDepends: x,\n y\n\n \nVersion: 2\nPackage: B.c\n  d\n\nNo: 1\n"


# -- name universes ---------------------------------------------------------


def test_fields_of_stanzas(spark):
    texts = spark.createDataFrame([(CONTROL,), (CONTROL.replace("\n", "\r\n"),), (None,), ("",)], "text string")
    got = [(r.p, r.d) for r in V.stanzas(texts).select(V.field("text", "Package").alias("p"), V.field("text", "Depends").alias("d")).collect()]
    assert sorted(got, key=str) == sorted([("Abc", "x, y"), ("B.c d", None), (None, None)] * 2, key=str)


def test_a_missing_file_of_four_leaves_three_and_a_count_of_one(spark, tmp_path):
    files = [tmp_path / f"v{k}" for k in range(4)]
    for k, f in enumerate(files[:3]):
        f.write_text(f"Package: n{k}\nTitle: x\n\nPackage: shared\n")
    index = tmp_path / "index.html"
    index.write_text('<a href="../">up</a> <a href="Old/">Old</a> <a href="f.txt">f</a>')
    universes = [V.Universe("views", "control", tuple(map(str, files))), V.Universe("archive", "index", (str(index),)), V.Universe("gone", "index", (str(tmp_path / "no"),))]
    observed = Observation()
    got = V.universe_names(V.texts(spark, universes), universes, observed).collect()
    assert sorted(map(tuple, got)) == [("archive", "Old"), ("views", "n0"), ("views", "n1"), ("views", "n2"), ("views", "shared")]
    assert observed.get == {"views": 1, "archive": 0, "gone": 1}


def test_universes_from_addresses(spark):
    pages = {"http://h/v1": "Package: a\n\nPackage: b\n", "http://h/i": '<a href="C/">C</a>'}

    def fetch(url):
        return pages[url]

    universes = [V.Universe("views", "control", ("http://h/v1", "http://h/v2")), V.Universe("archive", "index", ("http://h/i",))]
    observed = Observation()
    found = V.texts(spark, universes, tries=1, fetch=fetch)
    assert sorted(map(tuple, V.universe_names(found, universes, observed).collect())) == [("archive", "C"), ("views", "a"), ("views", "b")]
    assert observed.get == {"views": 1, "archive": 0}


# -- enumeration ------------------------------------------------------------


class Stop(RuntimeError):
    pass


def asks_of(spark, names):
    return spark.createDataFrame([("main", n, f"u/{n}") for n in names], E.ASKS_DDL)


def looking(log, broken=(), stop_after=None):
    def look(asked):
        if stop_after is not None and len(log) >= stop_after:
            raise Stop
        names = [r.url for r in asked.select("url").collect()]
        log.append(names)
        rows = []
        for url in names:
            page = '{"entries": [{"self_link": "https://x/+binarypub/1", "binary_package_name": "%s", "binary_package_version": "1"}]}' % url.split("/")[1]
            rows.append((url, 0, None if url in broken else page, url not in broken, 0))
        return asked.sparkSession.createDataFrame(rows, rest.PAGE_DDL)

    return look


def test_a_listing_goes_on_where_it_was_stopped(spark, tmp_path):
    names = [f"n{i}" for i in range(40)]
    first, second = [], []
    with pytest.raises(Stop):
        E.enumerate_all(E.Frontier.current(spark, str(tmp_path)), asks_of(spark, names), looking(first, stop_after=2), batch=10)
    assert len(first) == 2
    # A crash after the entries of a wave and before its mark: the wave counts for nothing.
    frontier = E.Frontier.current(spark, str(tmp_path))
    frontier.found().limit(1).write.parquet(f"{frontier.folder}/found/wave=2")
    got = E.enumerate_all(E.Frontier.current(spark, str(tmp_path)), asks_of(spark, names), looking(second), batch=10)
    asked = [u for wave in first + second for u in wave]
    assert sorted(asked) == sorted(f"u/{n}" for n in names)  # each once
    assert sorted(r.artifact for r in got.collect()) == sorted(names)
    assert E.Frontier.current(spark, str(tmp_path)).waves() == []  # the next listing is a new one


def test_names_that_fail_keep_a_listing_open(spark, tmp_path):
    names, log = [f"n{i}" for i in range(9)], []
    frontier = E.Frontier.current(spark, str(tmp_path))
    with pytest.raises(E.Incomplete, match="1 addresses"):
        E.enumerate_all(frontier, asks_of(spark, names), looking(log, broken={"u/n3"}))
    assert log[-1] == ["u/n3"] and len(log) == 2  # it came again after all others
    again = []
    got = E.enumerate_all(E.Frontier.current(spark, str(tmp_path)), asks_of(spark, names), looking(again))
    assert again == [["u/n3"]] and got.count() == 9
    forced = E.Frontier.current(spark, str(tmp_path / "f"))
    assert E.enumerate_all(forced, asks_of(spark, names), looking([], broken={"u/n3"}), force=True).count() == 8 and forced.complete()


# -- a refresh over a local server ------------------------------------------


def ledgers(tmp_path):
    path = str(tmp_path / "ledgers.db")
    if (tmp_path / "ledgers.db").exists():
        return {"cran": (path, "cran_names"), "bioc": (path, "bioc_names")}
    with sqlite3.connect(path) as db:
        for table, row in (("cran_names", ("abc", "Abc", "live")), ("bioc_names", ("b", "B", "archived"))):
            db.execute(f"create table {table} (name_lower text, display_name text, lifecycle text)")
            db.execute(f"insert into {table} values (?, ?, ?)", row)
    return {"cran": (path, "cran_names"), "bioc": (path, "bioc_names")}


def source_of(archive, tmp_path, **more):
    (tmp_path / "views").write_text("Package: B\n\nPackage: gone\n")
    (tmp_path / "index").write_text('<a href="Abc/">Abc</a>')
    universes = [V.Universe("bioc", "control", (str(tmp_path / "views"), str(tmp_path / "none"))), V.Universe("cran", "index", (str(tmp_path / "index"),))]
    options = {"work": str(tmp_path / "work"), "universes": universes, "namespaces": {"bioc": "bioc", "cran": "cran"}, "extras": ("r-other-x",), "pause": 0.0, "passes": 2, "ledgers": ledgers(tmp_path), "now": lambda: datetime.datetime(2024, 7, 1, tzinfo=datetime.timezone.utc)}
    return live.Source(api=archive.url, channels=[Channel("main", "~t/a"), Channel("off", "no", False)], **{**options, **more})


def small():
    e = [entry(1, "r-cran-abc"), entry(2, "r-bioc-b"), entry(3, "r-other-x"), entry(4, "r-cran-unknown")]
    c = {1: [count("r-cran-abc", "2024-06-01", 5), count("r-cran-abc", "2024-06-02", 6), count("r-cran-abc", "2024-06-02", 1)], 2: [count("r-bioc-b", "2023-05-01", 2)], 3: [count("r-other-x", "2024-06-01", 3)], 4: [count("r-cran-unknown", "2024-06-01", 9)]}
    return Archive({"~t/a": e}, c)


def daily(spark, folder):
    store = L.Store(spark, folder)
    assert store.damaged() == []
    return {(r.item, str(r.day), r.n) for r in store.read_years("daily", L.DAILY).collect()}


def test_refresh_over_http_by_names(spark, tmp_path):
    folder = str(tmp_path / "out")
    with small() as a:
        source, report = source_of(a, tmp_path), live.Report()
        m = L.refresh(spark, live.live_io(spark, source, report), folder, source.channels, floors=Floors(1, 1))
        assert report.universes == {"bioc": 1}
        assert daily(spark, folder) == {("abc", "2024-06-01", 5), ("abc", "2024-06-02", 7), ("b", "2023-05-01", 2), ("x", "2024-06-01", 3)}
        summary = {r.item: (r.display_name, r.namespace, r.n_total) for r in L.Store(spark, folder).read("summary", L.SUMMARY).collect()}
        assert summary == {"abc": ("Abc", "cran", 12), "b": ("B", "bioc", 2), "x": ("x", "other", 3)}
        assert m["anchor"] == "2024-06-02" and a.most <= source.connections
        # The source withdraws a day and adds one; what lies before the interval that is read again stays.
        a.counts[1] = [count("r-cran-abc", "2024-06-01", 5), count("r-cran-abc", "2024-06-20", 4)]
        a.asked.clear()
        L.refresh(spark, live.live_io(spark, source), folder, source.channels, floors=Floors(1, 1))
        assert any("/+binarypub/1?" in p and "start_date=2024-03-04" in p for p in a.asked) and not any("getPublishedBinaries" in p for p in a.asked)
        assert daily(spark, folder) == {("abc", "2024-06-01", 5), ("abc", "2024-06-20", 4), ("b", "2023-05-01", 2), ("x", "2024-06-01", 3)}
        totals = {r.artifact: r.n_total for r in L.Store(spark, folder).read_roster().collect()}
        assert totals == {"r-cran-abc": 9, "r-bioc-b": 2, "r-other-x": 3}


def test_refresh_over_http_by_archive_and_on_trial(spark, tmp_path):
    with small() as a:
        whole = source_of(a, tmp_path, mode="archives", work=str(tmp_path / "w1"))
        L.refresh(spark, live.live_io(spark, whole), str(tmp_path / "o1"), whole.channels, floors=Floors(1, 1))
        assert {i for i, _, _ in daily(spark, str(tmp_path / "o1"))} == {"abc", "b", "x", "unknown"}
        some = source_of(a, tmp_path, mode="trial", trial=("r-cran-abc", "r-cran-none"), work=str(tmp_path / "w2"))
        L.backfill(spark, live.live_io(spark, some), str(tmp_path / "o2"), some.channels, Floors(1, 1))
        assert {i for i, _, _ in daily(spark, str(tmp_path / "o2"))} == {"abc"}
    with pytest.raises(ValueError, match="mode"):
        source_of(a, tmp_path, mode="other")


def test_a_release_that_cannot_be_read_keeps_its_counts(spark, tmp_path):
    folder = str(tmp_path / "out")
    with small() as a:
        source = source_of(a, tmp_path)
        L.refresh(spark, live.live_io(spark, source), folder, source.channels, floors=Floors(1, 1))
        a.counts[3] = [count("r-other-x", "2024-06-03", 8)]
        for p in list(a.asked):
            if "/+binarypub/1?" in p:
                a.fail[p.replace("ws.size=300", "ws.size=300&start_date=2024-03-04")] = 100
        L.refresh(spark, live.live_io(spark, source), folder, source.channels, floors=Floors(1, 1))
        assert daily(spark, folder) == {("abc", "2024-06-01", 5), ("abc", "2024-06-02", 7), ("b", "2023-05-01", 2), ("x", "2024-06-03", 8)}
        roster = L.Store(spark, folder).read_roster()
        assert {r.artifact: str(r.last_day) for r in roster.where(F.col("artifact") != "r-bioc-b").collect()} == {"r-cran-abc": "2024-06-02", "r-other-x": "2024-06-03"}
