import datetime
import os

import pytest
from pyspark.sql import functions as F

from tests.test_publish_pipeline import CHANNELS, FLOORS, Source, published, table
from tidemark import schemas
from tidemark.operators import facts as A
from tidemark.plans import pipeline as L
from tidemark.sinks import commits as C
from tidemark.sinks import publish as P

D = datetime.date


def test_the_second_of_two_interleaved_runs_aborts(spark, tmp_path):
    folder = str(tmp_path)
    src, _ = published(spark, folder)
    src.time += datetime.timedelta(days=1)
    io = src.io()
    inner, once = io.counts, []

    def counts(roster):
        if not once:
            once.append(1)  # another run comes in between, from its start to its end
            src.counted = [("main", "r-cran-abc", "1", D(2024, 6, 5), 50)]
            L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
            src.counted = [("main", "r-cran-abc", "1", D(2024, 6, 6), 60)]
        return inner(roster)

    io.counts = counts
    with pytest.raises(C.Conflict):
        L.refresh(spark, io, folder, CHANNELS, floors=FLOORS)
    assert C.head(spark, folder)[0] == 2
    assert {(r.item, r.day, r.n) for r in table(spark, folder, "daily").collect()} == {("abc", D(2024, 6, 1), 12), ("abc", D(2024, 6, 5), 50), ("b", D(2023, 5, 1), 2)}


def test_sweeping_leaves_what_versions_name_and_readers_may_hold(spark, tmp_path):
    folder = str(tmp_path)
    src, _ = published(spark, folder)
    for k in range(3):
        src.time += datetime.timedelta(days=1)
        src.counted = [*src.counted, ("main", "r-cran-abc", "1", D(2024, 6, 10 + k), k + 1)]
        L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    (tmp_path / "snapshot-in-flight").mkdir()
    held = {n for n in os.listdir(folder) if n.startswith("snapshot-")}
    assert C.sweep(spark, folder, keep=2) == []  # all of them are young
    for n in held - {"snapshot-in-flight"}:
        os.utime(tmp_path / n, (1, 1))
    for v in os.listdir(tmp_path / C.VERSIONS):
        os.utime(tmp_path / C.VERSIONS / v, (1, 1))
    named = [C.snapshots_of(C.read_version(spark, folder, v)) for v in (1, 2, 3, 4)]
    gone = set(C.sweep(spark, folder, keep=2))
    left = {n for n in os.listdir(folder) if n.startswith("snapshot-")}
    # The year 2023 was written by the first run alone, and is current for ever after.
    assert gone == named[1] - named[2] - named[3] and gone and left == held - gone and "snapshot-in-flight" in left and named[0] <= left
    assert C.versions(spark, folder) == [3, 4] and L.Store(spark, folder).damaged() == []
    assert C.sweep(spark, str(tmp_path / "none")) == []


def test_untouched_buckets_keep_their_files(spark, tmp_path, monkeypatch):
    folder, src = str(tmp_path), Source(spark)
    src.listed = [("main", i, f"r-cran-p{i}", "1", "amd64") for i in range(40)]
    src.counted = [("main", f"r-cran-p{i}", "1", D(2024, 6, 1), 1) for i in range(40)]
    first = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    src.counted = [("main", "r-cran-p7", "1", D(2024, 6, 2), 5)]
    src.time += datetime.timedelta(days=1)
    second = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    rewritten = second["rewritten"]["releases"]
    assert len(rewritten) == 1 and len(first["parts"]["releases"]) > 10
    assert all(first["parts"]["releases"][b] == second["parts"]["releases"][b] for b in first["parts"]["releases"] if b not in rewritten)
    store = L.Store(spark, folder)
    assert store.damaged() == [] and store.read_roster().count() == 40
    assert {(r.artifact, r.n_total, r.last_day) for r in store.read_roster({int(rewritten[0])}).collect()} >= {("r-cran-p7", 6, D(2024, 6, 2))}


def test_a_refresh_opens_no_file_of_closed_years(spark, tmp_path):
    folder, src = str(tmp_path), Source(spark)
    src.counted = [("main", "r-cran-abc", "1", D(y, 6, 1), y) for y in range(2018, 2025)] + [("main", "r-bioc-b", "1", D(2019, 5, 1), 2)]
    L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    # Daily counts and facts of years that no window sees become unreadable: the run doesn't notice.
    spoilt = [f for kind in ("daily", "facts") for y in range(2018, 2023) for s in tmp_path.glob("snapshot-*") for f in (s / kind / f"year={y}").glob("*.parquet")]
    assert len(spoilt) >= 10
    for f in spoilt:
        f.write_bytes(b"no parquet")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    src.counted = [("main", "r-cran-abc", "1", D(2024, 6, 2), 4)]
    src.time += datetime.timedelta(days=1)
    L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS)
    summary = {r.item: (r.first_day, r.last_day, r.n_total, r.total_30d) for r in L.Store(spark, folder).read("summary", schemas.SUMMARY).collect()}
    assert summary == {"abc": (D(2018, 6, 1), D(2024, 6, 2), sum(range(2018, 2025)) + 4, 2028), "b": (D(2019, 5, 1), D(2019, 5, 1), 2, 0)}


def test_intervals_are_replaced_as_a_whole(spark):
    day = lambda m, d: D(2024, m, d)
    old = spark.createDataFrame([("m", "a", "1", day(1, 1), 1), ("m", "a", "1", day(3, 1), 2), ("m", "a", "1", day(3, 2), 3), ("m", "b", "1", day(3, 1), 4), ("m", "c", "1", day(3, 1), 5)], schemas.RAW_COUNTS)
    new = spark.createDataFrame([("m", "a", "1", day(3, 2), 9), ("m", "a", "1", day(4, 1), 8)], schemas.RAW_COUNTS)
    read = spark.createDataFrame([("m", "a", "1", day(2, 1)), ("m", "b", "1", None)], "channel string, artifact string, release string, since date")
    got = {(r.artifact, r.day, r.n) for r in A.replace_intervals(old, new, read).collect()}
    assert got == {("a", day(1, 1), 1), ("a", day(3, 2), 9), ("a", day(4, 1), 8), ("c", day(3, 1), 5)}
    assert {(r.artifact, r.day) for r in A.asked_for(old, read).collect()} == {("a", day(3, 1)), ("a", day(3, 2)), ("b", day(3, 1))}


def test_a_withdrawn_day_goes_where_counts_are_complete(spark, tmp_path):
    for complete, left in ((True, {("abc", D(2024, 6, 1), 7), ("abc", D(2024, 6, 4), 1), ("b", D(2023, 5, 1), 2)}), (False, {("abc", D(2024, 6, 1), 12), ("abc", D(2024, 6, 4), 1), ("b", D(2023, 5, 1), 2)})):
        folder = str(tmp_path / str(complete))
        src, _ = published(spark, folder)
        src.counted, src.time = [("main", "r-cran-abc", "2", D(2024, 6, 1), 7), ("main", "r-cran-abc", "1", D(2024, 6, 4), 1)], src.time + datetime.timedelta(days=1)
        io = src.io()
        io.complete = complete
        L.refresh(spark, io, folder, CHANNELS, floors=FLOORS)
        assert {(r.item, r.day, r.n) for r in table(spark, folder, "daily").collect()} == left


def test_exports_are_marked_and_checked(spark, tmp_path):
    folder, src, out = str(tmp_path / "o"), Source(spark), str(tmp_path / "copy.db")
    m = L.refresh(spark, src.io(), folder, CHANNELS, floors=FLOORS, export=out)
    assert m["export"]["rows"] == {"recent": 2, "summary": 2, "releases": 3} and not L.Store(spark, folder).damaged_export()
    with open(out, "ab") as f:
        f.write(b"x")
    assert L.Store(spark, folder).damaged_export()


def test_only_buckets_with_a_changed_row_are_given(spark):
    row = lambda a, n: ("m", a, "1", 1, None, None, None, None, n, None, False)
    old = spark.createDataFrame([row(f"a{i}", i) for i in range(30)], schemas.RELEASES)
    new = old.withColumn("n_total", F.when(F.col("artifact") == "a3", 99).otherwise(F.col("n_total"))).unionByName(spark.createDataFrame([row("new", None)], schemas.RELEASES))
    got = P.changed_buckets(new, old, 16)
    where = {r.artifact: r.bucket for r in P.with_bucket(new, 16).collect()}
    wanted = {where["a3"], where["new"]}
    assert {r.artifact for r in got.collect()} == {a for a, b in where.items() if b in wanted}
    assert P.changed_buckets(old, old, 16).count() == 0
