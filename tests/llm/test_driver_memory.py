"""The toxicity model is trained in the driver, which has less memory than a task: the training stays near its sample's size and gives back what it took."""

import tracemalloc

import numpy as np
import pytest

from tests.llm import data
from tidemark.llm import pu_toxicity


def sample(n=1200, each=400, words=2000):
    rng = np.random.default_rng(0)
    return [np.sort(rng.choice(words, each, replace=False)).astype(np.uint32) for _ in range(n)]


def test_training_takes_few_bytes_for_each_entry_of_its_sample():
    docs = sample()
    tracemalloc.start()
    model = pu_toxicity.fit(docs[:200], docs[200:], 0.2, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights and peak < 30 * sum(map(len, docs))


def test_what_training_took_goes_back(spark, monkeypatch):
    made = []
    monkeypatch.setattr(pu_toxicity, "give_back", lambda: made.append("given back"), raising=False)
    docs = data.frame(spark, [(i, f"bad word{i % 3}" if i % 4 == 0 else f"fine word{i % 3}") for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    assert pu_toxicity.learn(docs, labels).weights
    assert made == ["given back"]
    pu_toxicity.learn(docs, labels.where("toxic is null"))
    assert len(made) == 2


@pytest.mark.parametrize("entries", [1, 7, 1 << 18])
def test_sums_of_runs_do_not_depend_on_how_many_are_taken_at_a_time(monkeypatch, entries):
    monkeypatch.setattr(pu_toxicity, "ENTRIES", entries)
    rng = np.random.default_rng(1)
    lengths = np.array([0, 3, 0, 20, 1, 7, 0])
    index, values = rng.integers(0, 50, lengths.sum()).astype(np.int32), rng.normal(size=50)
    want = np.bincount(np.repeat(np.arange(7), lengths), weights=values[index], minlength=7)
    assert (pu_toxicity._sums(values, index, np.cumsum(lengths)) == want).all()
