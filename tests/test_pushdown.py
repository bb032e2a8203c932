import datetime
import http.server
import json
import sqlite3
import threading
import time
import urllib.parse
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

from tidemark import schemas
from tidemark.sources import listings, rest, sqlite
from tidemark.sources import urls as U

D = datetime.date


class Archive:
    """A local server of paged listings that keeps what it was asked and how many connections were open at once."""

    def __init__(self, entries, counts, size=2, slow=0.0, heed=True):
        self.entries, self.counts, self.size, self.slow, self.heed = entries, counts, size, slow, heed
        self.asked, self.open, self.most, self.fail, self.lock = [], 0, 0, Counter(), threading.Lock()

    def answer(self, path, query):
        if query["ws.op"] == "getDownloadCounts":
            rows = [r for r in self.counts.get(int(path.rsplit("/", 1)[1]), []) if not self.heed or r["day"] >= query.get("start_date", "")]
        else:
            rows = self.entries[urllib.parse.unquote(path.split("/")[1])]
            if self.heed:
                rows = [r for r in rows if query.get("status") in (None, r["status"]) and query.get("binary_name") in (None, r["binary_package_name"])]
        at = int(query.get("ws.start", 0))
        page = {"entries": rows[at : at + self.size]}
        if at + self.size < len(rows):
            page["next_collection_link"] = f"{self.url}{path}?" + urllib.parse.urlencode({**query, "ws.start": at + self.size})
        return page

    def __enter__(self):
        archive = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):  # noqa: N802
                with archive.lock:
                    archive.asked.append(self.path)
                    archive.open += 1
                    archive.most = max(archive.most, archive.open)
                    failing = archive.fail[self.path] > 0
                    archive.fail[self.path] -= failing
                time.sleep(archive.slow)
                path, _, query = self.path.partition("?")
                body = None if failing else archive.answer(path, dict(urllib.parse.parse_qsl(query)))
                with archive.lock:
                    archive.open -= 1
                self.send_response(200 if body is not None else 503)
                self.end_headers()
                if body is not None:
                    self.wfile.write(json.dumps(body).encode())

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_):
        self.server.shutdown()


def entry(i, name, status="Published"):
    return {"self_link": f"https://x/+binarypub/{i}", "binary_package_name": name, "binary_package_version": "1", "distro_arch_series_link": "https://x/s/amd64", "status": status, "date_published": None}


def count(name, day, n):
    return {"binary_package_name": name, "binary_package_version": "1", "day": day, "count": n}


def archive(**more):
    entries = {"~t/a b": [entry(i, f"r-cran-n{i}", "Published" if i % 2 else "Deleted") for i in range(7)], "other": [entry(9, "r-cran-n1")]}
    return Archive(entries, {1: [count("r-cran-n1", f"2024-01-{d:02d}", d) for d in range(1, 6)], 9: [count("r-cran-n1", "2023-01-01", 4)]}, **more)


CHANNELS = {"main": "~t/a b", "old": "other"}


def test_text_and_column_addresses_are_the_same(spark):
    api, ref, name = "https://api.example.org/", "~team/+archive/a b", "r-cran-a+b"
    at = lambda c: spark.range(1).select(c.alias("v")).first().v
    query = lambda u: (u.partition("?")[0], set(u.partition("?")[2].split("&")))
    assert query(U.listing_address(api, ref, "Published")) == query(at(U.listing_url(api, F.lit(ref), status="Published")).replace("%7E", "~"))
    assert query(U.listing_address(api, ref, name=name)) == query(at(U.name_url(api, F.lit(ref), F.lit(name))).replace("%7E", "~"))
    assert query(U.counts_address(api, ref, 7, "2024-01-02")) == query(at(U.counts_url(api, F.lit(ref), F.lit(7), F.lit(D(2024, 1, 2)))).replace("%7E", "~"))


@pytest.mark.parametrize("heed", [True, False])
def test_filters_of_entries_go_into_the_address_and_hold_anyway(spark, heed):
    with archive(heed=heed) as a:
        got = listings.published_entries(spark, a.url, CHANNELS, "channel = 'main' and status = 'Published' and source_id > 1").select("source_id", "arch")
        assert sorted(got.collect()) == [(3, "amd64"), (5, "amd64")]
        assert a.asked and all("status=Published" in p and p.startswith("/~t%2Fa%20b") for p in a.asked)
        a.asked.clear()
        assert got.count() == 2 and a.asked == []  # it was asked once
        some = listings.published_entries(spark, a.url, CHANNELS, "artifact in ('r-cran-n1', 'r-cran-n3')")
        assert sorted(some.select("channel", "source_id").collect()) == [("main", 1), ("main", 3), ("old", 9)]
        names = Counter(dict(urllib.parse.parse_qsl(p.partition("?")[2])).get("binary_name") for p in a.asked)
        assert set(names) == {"r-cran-n1", "r-cran-n3"} and all("exact_match=true" in p for p in a.asked if "ws.start=" not in p)
        assert listings.published_entries(spark, a.url, CHANNELS).count() == 8
        assert spark.conf.get("spark.sql.python.filterPushdown.enabled") == "false"


@pytest.mark.parametrize("heed", [True, False])
def test_filters_of_counts_go_into_the_address_and_hold_anyway(spark, heed):
    with archive(heed=heed) as a:
        late = (F.col("source_id") == 1) & (F.col("channel") == "main") & (F.col("day") >= F.lit(D(2024, 1, 3))) & (F.col("day") != F.lit(D(2024, 1, 4)))
        assert sorted(listings.release_counts(spark, a.url, CHANNELS, late).select("day", "n").collect()) == [(D(2024, 1, 3), 3), (D(2024, 1, 5), 5)]
        assert a.asked and all("start_date=2024-01-03" in p and "/+binarypub/1?" in p for p in a.asked)
        assert listings.release_counts(spark, a.url, CHANNELS, "source_id in (1, 9) and channel = 'main'").agg(F.sum("n")).first()[0] == 19
        with pytest.raises(Exception, match="source_id"):
            listings.release_counts(spark, a.url, CHANNELS, "n > 0")


def test_a_listing_that_breaks_off_fails(spark):
    with archive() as a:
        first = "/other?ws.op=getPublishedBinaries&ordered=false&ws.size=300&ws.start=0"
        a.fail[first] = 1
        assert listings.published_entries(spark, a.url, CHANNELS, pause="0", tries="1").count() == 8
        a.fail[first] = 100
        with pytest.raises(Exception, match="broke off"):
            listings.published_entries(spark, a.url, CHANNELS, pause="0", passes="1")


def test_all_tasks_together_keep_to_the_bound_and_failures_come_again_later(spark):
    entries = {f"c{i}": [entry(i, "x"), entry(i, "y"), entry(i, "z")] for i in range(24)}
    with Archive(entries, {}, slow=0.02) as a:
        urls = spark.createDataFrame([(U.listing_address(a.url, c),) for c in entries], "url string").repartition(8)
        a.fail[U.listing_address("", "c3")] = 1
        second = f"/c5?{urllib.parse.urlencode({'ws.op': 'getPublishedBinaries', 'ordered': 'false', 'ws.size': 300, 'ws.start': 2})}"
        a.fail[second] = 2
        a.fail[U.listing_address("", "c7")] = 1000
        pages = rest.follow(urls, connections=6, tries=1, passes=3, pause=0.0).collect()
        assert 2 <= a.most <= 6
        pages = spark.createDataFrame(pages, rest.PAGE_DDL)
        good, bad = rest.whole_chains(pages)
        assert [r.first_url for r in bad.collect()] == [U.listing_address(a.url, "c7")]
        assert Counter(r.first_url for r in good.collect()) == Counter({U.listing_address(a.url, c): 2 for c in entries if c != "c7"})
        assert a.asked.count(U.listing_address("", "c3")) == 2 and a.asked.count(second) == 3
        order = [p for p in a.asked if p.startswith(("/c3?", "/c7?"))]
        assert len(a.asked) - a.asked[::-1].index(U.listing_address("", "c3")) > len(entries)  # the second try comes after all first ones
        assert len(order) >= 5
        a.most = 0
        spark.dataSource.register(rest.PagedRest)
        read = spark.read.format("paged_rest").option("urls", "\n".join(U.listing_address(a.url, c) for c in entries)).option("connections", "3").option("partitions", "8").option("tries", "1").load()
        assert read.where("ok").count() >= 46 and a.most <= 3


def test_shares_never_exceed_the_bound():
    for connections in range(1, 30):
        for tasks in range(1, 30):
            n, pool = rest.shares(connections, tasks)
            assert n * pool <= connections and n >= 1 and pool >= 1


# -- SQLite -----------------------------------------------------------------

DAILY = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.DAILY.fields])


@pytest.fixture
def file(tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute("create table daily (item text, day text, n integer)")
        first = D(2020, 1, 1)
        db.executemany("insert into daily values (?, ?, ?)", [(f"i{k % 10}", str(first + datetime.timedelta(days=k)), k) for k in range(1000)])
        db.execute("insert into daily (rowid, item, day, n) values (5000000, 'far', '2030-01-01', 7)")
        db.execute("insert into daily values ('odd', 'someday', 'many')")
        db.execute("insert into daily values (null, null, null)")
        db.execute("create index by_day on daily (day)")
    return path


def read_rows(path, filters, **options):
    reader = sqlite.PushedReader({"path": path, "table": "daily", **options}, DAILY)
    assert list(reader.pushFilters(filters)) == filters  # all are applied again
    return [list(reader.read(p)) for p in reader.partitions()]


def test_only_matching_rows_are_read(file):
    def number(*filters, **options):
        return sum(map(len, read_rows(file, list(filters), **options)))

    assert number() == 1003
    assert number(GreaterThanOrEqual(("day",), D(2022, 9, 1))) == 28  # 26 days, the far one, and the text that is no day
    assert number(GreaterThanOrEqual(("day",), D(2022, 9, 1)), LessThan(("day",), D(2022, 9, 3))) == 2
    assert number(EqualTo(("item",), "i3"), IsNotNull(("day",))) == 100
    assert number(In(("item",), ("i1", "i2")), GreaterThanOrEqual(("n",), 900)) == 20
    assert number(EqualTo(("no such",), 1)) == 1003
    assert number(by="day") == 1003 and number(GreaterThanOrEqual(("day",), D(2022, 9, 1)), by="day") == 28


def test_ranges_have_even_numbers_of_rows(file):
    # By row id the gap of five million ids makes no empty and no full range; by day neither.
    for options in ({}, {"by": "day"}):
        parts = [len(p) for p in read_rows(file, [], partitions="5", **options)]
        assert sum(parts) == 1003 and max(parts) <= 202 and sum(n > 150 for n in parts) == 5


def test_filters_of_typed_columns_give_the_rows_of_the_whole_table(spark, file):
    whole = spark.createDataFrame(sqlite.load(spark, file, "daily", schemas.DAILY).collect(), DAILY)
    for by in (None, "day"):
        for condition in ("day >= date'2022-09-01'", "day between date'2020-02-01' and date'2020-02-03'", "n > 990 and item = 'i9'", "n = 5", "day is null", "n is not null and day is null", "item in ('i1', 'far') and n < 40", "item <=> null", "not (n < 995)"):
            got = sqlite.load(spark, file, "daily", schemas.DAILY, by, condition)
            assert sorted(map(str, got.collect())) == sorted(map(str, whole.where(condition).collect())), condition
    assert whole.count() == 1003 and whole.where("day is null").count() == 2


def test_older_files_lack_columns(spark, file):
    wide = T.StructType([*schemas.DAILY.fields, T.StructField("lifecycle", T.StringType())])
    got = sqlite.load(spark, file, "daily", wide)
    assert got.where("lifecycle is null").count() == 1003 and sqlite.load(spark, file, "daily", wide, condition="lifecycle = 'x'").count() == 0
