"""Paged REST listings as a Spark data source.

``spark.read.format("paged_rest").option("urls", "\\n".join(urls)).load()``
follows the chain of every first address and returns one row for each page:
first_url, page_no, text, ok, pass_no. A chain that breaks has a last row with ok false,
and begins anew in a later pass if there is one; ``whole_chains`` keeps the
pages of the passes that came to their end and lists the chains that none did.

However many tasks a job has, all of them together hold at most ``connections``
open: so many tasks at most, each with its share. (Speculative copies of tasks
would come on top; leave ``spark.speculation`` off for these jobs.)
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE_DDL = "first_url string, page_no int, text string, ok boolean, pass_no int"
_PAGE = pa.schema([("first_url", pa.string()), ("page_no", pa.int32()), ("text", pa.string()), ("ok", pa.bool_()), ("pass_no", pa.int32())])
Page = tuple[str, int, str | None, bool]
#: Bytes of pages after which a batch is handed on, and seconds in which pages that arrive together go on together.
BATCH_BYTES, LINGER = 1 << 20, 0.01
#: A chain of more pages than this is taken for a loop.
MAX_PAGES = 100_000


def retried(call: Callable[[], str], tries: int = 9, wait: float = 5.0, most: float = 120.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The result of ``call``, tried again after doubling pauses."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k + 1 == tries:
                raise
            sleep(min(most, wait * 2**k))
    raise ValueError("tries must be positive")


def get(url: str, timeout: float = 60.0) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as response:  # noqa: S310
        return response.read().decode("utf-8")


def chain(first: str, fetch: Callable[[str], str]) -> Iterator[Page]:
    url: str | None = first
    for page in range(MAX_PAGES):
        try:
            text = fetch(url)
            following = json.loads(text).get("next_collection_link")
        except Exception:
            yield first, page, None, False
            return
        yield first, page, text, True
        if not following:
            return
        url = following
    yield first, MAX_PAGES, None, False


def chains(firsts: Iterable[str], fetch: Callable[[str], str], connections: int) -> Iterator[Page]:
    """Rows of many chains, followed side by side: a page of each is held at a time, and no chain as a whole.

    A chain goes on as soon as its page is handed over, whatever the others wait for.
    """
    waiting = iter(firsts)
    with ThreadPoolExecutor(connections) as pool:
        asked = {}

        def ask(open_: Iterable[Iterator[Page]]) -> None:
            asked.update((pool.submit(next, c, None), c) for c in open_)

        ask(chain(u, fetch) for u in islice(waiting, connections))
        while asked:
            done, _ = wait(asked, timeout=LINGER)
            done = done or wait(asked, return_when=FIRST_COMPLETED).done
            pages = [(f.result(), asked.pop(f)) for f in done]
            yield from (p for p, _ in pages if p is not None)
            ask(c for p, c in pages if p is not None)
            ask(chain(u, fetch) for u in islice(waiting, connections - len(asked)))


def passes_over(firsts: Iterable[str], fetch: Callable[[str], str], connections: int, passes: int = 1, pause: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """Rows of ``chains`` with the number of the pass; broken chains begin anew in the next pass, after a longer pause."""
    for k in range(passes):
        broken: list[str] = []
        for page in chains(firsts, fetch, connections):
            if not page[3]:
                broken.append(page[0])
            yield (*page, k)
        if not broken or k + 1 == passes:
            return
        sleep(pause * (k + 1))
        firsts = broken


def shares(connections: int, tasks: int) -> tuple[int, int]:
    """Tasks, and connections of each, so that all tasks together have no more than ``connections``."""
    tasks = max(1, min(tasks, connections))
    return tasks, max(1, connections // tasks)


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or "") + 100
        if size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _PAGE)], schema=_PAGE)


def follow(addresses: DataFrame, connections: int = 16, tries: int = 9, wait: float = 5.0, fetch: Callable[[str], str] = get, passes: int = 1, pause: float = 3.0) -> DataFrame:
    """The rows of ``paged_rest`` for the chains that begin at the distinct addresses (url).

    Addresses stay distributed: each task follows its own, so their number
    is bounded by no driver. ``connections`` is the bound for the whole job.
    Write the result before it is used twice: each use asks the source.
    """
    spark = addresses.sparkSession
    tasks, pool = shares(connections, spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urls = (u for batch in batches for u in batch.column(0).to_pylist())
        return _batches(passes_over(urls, lambda u: retried(lambda: fetch(u), tries, wait), pool, passes, pause))

    return addresses.where("url is not null").select("url").distinct().repartition(tasks).mapInArrow(run, PAGE_DDL)


def follow_texts(addresses: DataFrame, connections: int = 16, tries: int = 9, wait: float = 5.0, fetch: Callable[[str], str] = get) -> DataFrame:
    """url, text and ok of the distinct addresses (url), which are no chains but texts of any kind."""
    tasks, pool = shares(connections, addresses.sparkSession.sparkContext.defaultParallelism)
    schema = pa.schema([("url", pa.string()), ("text", pa.string()), ("ok", pa.bool_())])

    def read(url: str) -> pa.RecordBatch:
        try:
            text, ok = retried(lambda: fetch(url), tries, wait), True
        except Exception:
            text, ok = None, False
        return pa.RecordBatch.from_arrays([pa.array([url]), pa.array([text], pa.string()), pa.array([ok])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urls = (u for batch in batches for u in batch.column(0).to_pylist())
        with ThreadPoolExecutor(pool) as threads:
            while some := list(islice(urls, pool)):  # as many texts are held as are asked for at a time
                yield from threads.map(read, some)

    return addresses.where("url is not null").select("url").distinct().repartition(tasks).mapInArrow(run, "url string, text string, ok boolean")


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(None)
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.connections = max(1, int(options.get("connections", "16")))
        self.tasks, self.pool = shares(self.connections, max(1, int(options.get("partitions", "4"))))
        self.passes, self.pause = int(options.get("passes", "1")), float(options.get("pause", "3"))
        self.tries, self.wait = int(options.get("tries", "9")), float(options.get("wait", "5"))

    def partitions(self) -> list[InputPartition]:
        n = min(self.tasks, max(1, len(self.urls)))
        return [_Urls(self.urls[i::n]) for i in range(n)]

    def read(self, partition: _Urls) -> Iterator[pa.RecordBatch]:
        fetch = lambda url: retried(lambda: get(url), self.tries, self.wait)
        return _batches(passes_over(partition.urls, fetch, self.pool, self.passes, self.pause))


class PagedRest(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return PAGE_DDL

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def whole_chains(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages of the passes that read their chain to its end, and the first addresses of the chains that none did."""
    passes = pages.groupBy("first_url", "pass_no").agg(F.bool_and("ok").alias("whole"))
    good = passes.where("whole").select("first_url", "pass_no")
    bad = passes.groupBy("first_url").agg(F.bool_or("whole").alias("whole")).where("not whole").select("first_url")
    return pages.join(good, ["first_url", "pass_no"], "left_semi").select("first_url", "page_no", "text"), bad


def with_channel(pages: DataFrame, channel: str) -> DataFrame:
    return pages.withColumn("channel", F.lit(channel))
