import datetime
import http.server
import json
import sqlite3
import threading

import pytest
from pyspark.sql import functions as F

from tidemark import config, schemas
from tidemark.functions import text as X
from tidemark.sources import pages as P
from tidemark.sources import rest, sqlite
from tidemark.sources import urls as U


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_addresses(spark):
    api, ref = "https://api.example.org/", F.lit("~team/+archive/a b")
    assert one(spark, X.encode_ref(F.lit("a+b c/d"))) == "a%2Bb%20c%2Fd"
    assert one(spark, U.listing_url(api, ref, 300)).endswith("ordered=false&ws.size=300&ws.start=300")
    assert one(spark, U.listing_url(api, ref, status="Published")).endswith("&status=Published")
    assert "exact_match=true" in one(spark, U.name_url(api, ref, F.lit("r-cran-a")))
    assert one(spark, U.counts_url(api, ref, F.lit(7), F.lit(datetime.date(2024, 1, 2)))).endswith("/+binarypub/7?ws.op=getDownloadCounts&ws.size=300&start_date=2024-01-02")
    assert "start_date" not in one(spark, U.counts_url(api, ref, F.lit(7), F.lit(None).cast("date")))


def test_ids_segments_and_times(spark):
    assert one(spark, X.source_id(F.lit("https://x/+binarypub/123"))) == 123
    assert one(spark, X.source_id(F.lit("https://x/123"))) is None
    assert one(spark, X.source_id(F.lit("https://x/+binarypub/99999999999999999999"))) is None
    assert one(spark, X.last_segment(F.lit("https://x/noble/amd64"))) == "amd64" and one(spark, X.last_segment(F.lit(None).cast("string"))) is None
    at = F.lit(datetime.datetime(2024, 1, 2, 3, 4, 5))
    assert (one(spark, X.iso_time(at)), one(spark, X.run_tag(at))) == ("2024-01-02T03:04:05Z", "v20240102-030405")
    assert one(spark, X.shown_time(X.iso_time(at))) == "2024-01-02 03:04:05 UTC" and one(spark, X.shown_time(F.lit(None).cast("string"))) == "n/a"


def pages(spark, *objects):
    return spark.createDataFrame([("m", o if isinstance(o, str) else json.dumps(o)) for o in objects], "channel string, text string")


def test_published_pages(spark):
    entry = {"self_link": "https://x/+binarypub/5", "binary_package_name": "r-cran-a", "binary_package_version": "1", "distro_arch_series_link": None, "status": "Published", "extra": 1}
    got = P.published_entries(pages(spark, {"entries": [entry]}, {"entries": []}, {"total_size": 0}))
    assert got.schema.names == schemas.ENTRIES.names
    assert [tuple(r) for r in got.collect()] == [("m", 5, "r-cran-a", "1", None, "Published", None)]


def test_count_pages(spark):
    e = lambda day, n: {"binary_package_name": "a", "binary_package_version": "1", "day": day, "count": n, "country_link": "x"}
    got = P.count_rows(pages(spark, {"entries": [e("2024-01-02", 3), e(None, 1), e("2024-01-02", None)], "next_collection_link": "u2"}))
    assert [(r.day, r.n) for r in got.collect()] == [(datetime.date(2024, 1, 2), 3), (None, 1), (datetime.date(2024, 1, 2), None)]
    assert P.next_links(pages(spark, {"next_collection_link": "u"}, {})).select("next").collect() == [("u",), (None,)]


def test_malformed_pages_raise(spark):
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        P.count_rows(pages(spark, '{"entries": [')).collect()


def test_index_and_control_text(spark):
    html = spark.createDataFrame([('<a href="../">up</a><a href="abc/">abc/</a><a href="x.txt">x</a><a href="D.e/">D</a>',), (None,), ("",)], "html string")
    assert [r.name for r in P.directory_names(html).collect()] == ["abc", "D.e"]
    text = spark.createDataFrame([("Package: zoo \nVersion: 1\n\nPackage: abc\nNotPackage: q\n",), (None,)], "text string")
    assert [r.name for r in P.control_names(text).orderBy("line_no").collect()] == ["zoo", "abc"]


@pytest.fixture
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            port = self.server.server_address[1]
            body = {"/a": {"entries": [1], "next_collection_link": f"http://127.0.0.1:{port}/a2"}, "/a2": {"entries": [2]}, "/bad": {"entries": [], "next_collection_link": f"http://127.0.0.1:{port}/none"}}.get(self.path)
            self.send_response(200 if body else 503)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode() if body else b"")

        def log_message(self, *a):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}"
    s.shutdown()


def test_rest_source_reads_whole_chains_and_reports_broken_ones(spark, server):
    spark.dataSource.register(rest.PagedRest)
    urls = "\n".join(f"{server}/{p}" for p in ("a", "bad"))
    got = spark.read.format("paged_rest").option("urls", urls).option("tries", "1").load()
    good, failed = rest.whole_chains(got)
    assert [(r.page_no, json.loads(r.text)["entries"]) for r in good.orderBy("page_no").collect()] == [(0, [1]), (1, [2])]
    assert [r.first_url for r in failed.collect()] == [f"{server}/bad"]


def test_chains_follow_from_a_table_of_addresses(spark, server):
    addresses = spark.createDataFrame([(f"{server}/a",), (f"{server}/a",), (f"{server}/bad",), (None,)], "url string")
    got = sorted((r.first_url.rsplit("/", 1)[1], r.page_no, r.ok) for r in rest.follow(addresses, tries=1).collect())
    assert got == [("a", 0, True), ("a", 1, True), ("bad", 0, True), ("bad", 1, False)]


def test_chains_hold_a_page_each():
    fetched = []

    def fetch(url):
        fetched.append(url)
        name, page = url.split("/")
        return json.dumps({"next_collection_link": f"{name}/{int(page) + 1}" if int(page) < 9 else None})

    rows = rest.chains(["x/0", "y/0", "z/0"], fetch, 2)
    next(rows)
    assert len(fetched) == 2
    assert len(list(rows)) == 29


def test_long_field_values_stay_whole(spark):
    name = "n" * 1_100_000
    text = spark.createDataFrame([(f"Package: {name}\n",)], "text string")
    assert P.control_names(text).first().name == name


def test_retries_double_their_pauses():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 4:
            raise OSError
        return "x"

    assert rest.retried(flaky, tries=5, wait=50, sleep=waits.append) == "x" and waits == [50, 100, 120]
    with pytest.raises(OSError):
        rest.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, sleep=waits.append)


def test_sqlite_source(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute("create table daily (item text, day text, n integer)")
        db.executemany("insert into daily values (?, ?, ?)", [(f"i{k}", "2024-01-02", k) for k in range(50)])
    got = sqlite.load(spark, path, "daily", schemas.DAILY)
    assert got.count() == 50 and got.agg(F.sum("n")).first()[0] == 1225 and got.first().day == datetime.date(2024, 1, 2)
    assert sqlite.load(spark, path, "summary", schemas.SUMMARY).count() == 0
    assert sqlite.load(spark, str(tmp_path / "none.db"), "daily", schemas.DAILY).count() == 0


def test_switches_and_channels():
    assert [config.flag(x) for x in ("true", "1", "YES", "no", "", None)] == [True, True, True, False, False, False]
    assert [config.pool_size(x, 6) for x in ("8", "x", "-1", None)] == [8, 6, 6, 6]
    channels = [config.Channel("a", "r"), config.Channel("b", "r", False)]
    assert config.enabled(channels) == channels[:1] and config.channel_by_key(channels, "c") is None
