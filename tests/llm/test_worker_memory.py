"""Python workers outlive their tasks: what a task took goes back when it ends, so that the next stage has the executor's memory."""

import os
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, ngram_join


class Table:
    """Stands for a DataFrame and keeps the function that would run in the workers."""

    def where(self, *_):
        return self

    select = groupBy = distinct = where

    def mapInArrow(self, run, _):
        self.run = run
        return self

    def applyInArrow(self, run, _):
        self.groups = [*getattr(self, "groups", []), run]
        return self


class Task:
    get = staticmethod(lambda: Task)
    partitionId = staticmethod(lambda: 0)


@pytest.fixture
def calls(monkeypatch):
    made = []
    for module in (common, ngram_join):
        monkeypatch.setattr(module, "give_back", lambda: made.append("given back"))
    monkeypatch.setattr(ngram_join, "TaskContext", Task)
    return made


def watched(rows, calls):
    for row in rows:
        calls.append("row")
        yield row


def texts(n=20):
    return pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i % 5}x{j}" for j in range(40)) for i in range(n)]})


def test_screen_gives_back_after_its_last_pack(spark, calls):
    docs = Table()
    ngram_join._screened(docs, 80, 1000)
    assert list(watched(docs.run(iter([texts()])), calls))
    assert calls[-1] == "given back"


def test_groups_of_the_screen_give_back(spark, calls):
    docs = Table()
    ngram_join._screened(docs, 80, 1000)
    packs = pa.Table.from_batches(list(docs.run(iter([texts()]))))
    replies = docs.groups[0](packs)
    calls.clear()
    assert docs.groups[1](replies).column_names == ["k1"]
    assert calls == ["given back"]


def test_probe_gives_back(calls):
    pairs = Table()
    ngram_join._probe(pairs)
    one = pa.array([[1, 2, 3]], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([0]), pa.array([3]), one, one], names=["a", "b", "found", "need", "wanted", "held"])
    assert sum(len(b) for b in watched(pairs.run(iter([batch])), calls)) == 1
    assert calls[-1] == "given back"


def test_memory_goes_back_though_reading_ends_early(calls):
    rows = common.handing_back(lambda parts: (p for p in parts))(iter([1, 2, 3]))
    assert next(rows) == 1 and not calls
    rows.close()
    assert calls == ["given back"]


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="needs Linux")
def test_pages_are_really_returned():
    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) >> 10

    def run(parts):
        for p in parts:
            held = [np.ones(1 << 13) for _ in range(2000)]  # 64 KB each, from the heap
            keep.append(held[-1])
            yield p

    keep = []
    before = anonymous()
    assert list(common.handing_back(run)(iter([1, 2]))) == [1, 2]
    assert anonymous() - before < 60
