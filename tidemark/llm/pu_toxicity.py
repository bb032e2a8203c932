"""Toxicity scores by non-negative positive-unlabelled learning.

A sparse linear model over the words that a text has, whatever its length, is
trained in numpy from confirmed toxic documents and unlabelled ones. The risk
of the unlabelled part is corrected by the class prior, and where the
correction would make the negative risk less than zero the step goes back up
instead, so the model cannot overfit the positives. Each step shrinks all
weights towards zero, so words that say little have none. Scores are then moved
so that 0.3 is the operating point, which is found on labelled rows of the
learning part by models that have not seen them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import give_back, handing_back

#: Fixed value of the contract: scores from here on count as toxic.
CUTOFF = 0.3
#: Bounds of the training sample: confirmed toxic rows, and unlabelled rows.
MAX_POSITIVE, MAX_UNLABELLED = 2000, 5000
#: Confirmed toxic rows of the sample that must hold a word for it to be a feature.
LEAST_DOCS = 8
#: Letters of a word's beginning that are a feature of their own.
START = 5
#: How much each step of length 1 shrinks a weight, and the folds that the operating point is found in.
SHRINK, FOLDS = 0.1, 3
#: Entries of the sample that are summed at a time: no array of floats is as long as the sample.
ENTRIES = 1 << 18

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(text: str | None) -> set[int]:
    """Checksums of a text's distinct words, and of the beginnings of its longer ones."""
    words = set(_WORD.findall((text or "").lower()))
    words |= {"^" + w[:START] for w in words if len(w) > START}
    return {zlib.crc32(w.encode()) for w in words}


class Model:
    """word checksum to weight, an intercept, and the operating point of the margins."""

    def __init__(self, weights: dict[int, float], bias: float, point: float = 0.0):
        self.weights, self.bias, self.point = weights, bias, point

    def margin(self, found: Iterable[int]) -> float:
        return self.bias + sum(self.weights[k] for k in found if k in self.weights)

    def score(self, text: str | None) -> float:
        """0 to 1; the operating point is at ``CUTOFF``."""
        shift = np.log(CUTOFF / (1 - CUTOFF)) - self.point
        return float(1.0 / (1.0 + np.exp(-np.clip(self.margin(features(text)) + shift, -30, 30))))


Rows = list[np.ndarray]


def risk(z: np.ndarray, n_p: int, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of margins z, the first n_p of them of positive rows, and its gradient.

    Where the corrected negative risk is below zero the gradient is that of its
    opposite alone (Kiryo et al., 2017).
    """
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
    called_positive, called_negative, n_u = np.logaddexp(0, -z), np.logaddexp(0, z), len(z) - n_p
    negative = called_negative[n_p:].mean() - prior * called_negative[:n_p].mean()
    slope = np.concatenate([-prior * p[:n_p] / n_p, p[n_p:] / n_u])
    if negative < 0:
        return prior * called_positive[:n_p].mean(), -slope
    slope[:n_p] += prior * (p[:n_p] - 1) / n_p
    return prior * called_positive[:n_p].mean() + negative, slope


def _sums(values: np.ndarray, index: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values[index]`` over the runs of ``index`` that end at ``ends``, some runs at a time."""
    out, i, at = np.zeros(len(ends)), 0, 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, at + ENTRIES, "right")))
        run = np.repeat(np.arange(j - i), np.diff(ends[i:j], prepend=at))
        out[i:j] = np.bincount(run, weights=values[index[at : ends[j - 1]]], minlength=j - i)
        i, at = j, int(ends[j - 1])
    return out


def _places(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where in the sorted ``keys`` a document's features are; those that are not there are left out."""
    at = np.minimum(np.searchsorted(keys, doc), len(keys) - 1).astype(np.int32)
    return at[keys[at] == doc]


def fit(positive: Rows, unlabelled: Rows, prior: float, rounds: int = 200, rate: float = 0.1) -> Model:
    """Minimise the non-negative risk by Adam over the whole sample, with shrinking weights."""
    keys, seen = np.unique(np.concatenate(positive) if positive else np.zeros(0, np.uint32), return_counts=True)
    keys = keys[seen >= LEAST_DOCS]
    if not len(keys) or not unlabelled:
        return Model({}, -5.0)
    places = [_places(keys, d) for d in [*positive, *unlabelled]]
    lengths, cols = np.array([len(p) for p in places]), np.concatenate(places)
    del places
    n, m = len(lengths), len(keys)
    # The entries by document, and once more by feature; of equal features documents are in order.
    doc_ends, key_ends = np.cumsum(lengths), np.cumsum(np.bincount(cols, minlength=m))
    rows = np.repeat(np.arange(n, dtype=np.int32), lengths)[np.argsort(cols, kind="stable")]
    w, b = np.zeros(m), -2.0
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, rounds + 1):
        _, dz = risk(_sums(w, cols, doc_ends) + b, len(positive), prior)
        g = np.append(_sums(dz, rows, key_ends), dz.sum())
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - SHRINK * rate, 0)
        b -= move[-1]
    return Model({int(k): float(v) for k, v in zip(keys, w) if v}, float(b))


def operating_point(toxic: list[float], clean: list[float], prior: float) -> float:
    """The margin of the best F1 over labelled rows of the learning part, in the middle of its gap.

    The samples of both classes are weighed as the classes stand in all labelled
    rows. Equal margins are never parted, nor are all rows called toxic: where a
    model tells nothing apart, nothing is toxic.
    """
    if not toxic or not clean:
        return 0.0
    ranked = sorted([(z, prior / len(toxic), 1) for z in toxic] + [(z, (1 - prior) / len(clean), 0) for z in clean], reverse=True)
    called, hits, best, at = 0.0, 0.0, -1.0, ranked[0][0] + 1
    for i, (z, weight, y) in enumerate(ranked):
        called += weight
        hits += weight * y
        f1 = 2 * hits / (called + prior)
        if f1 > best and i + 1 < len(ranked) and ranked[i + 1][0] < z:
            best, at = f1, (z + ranked[i + 1][0]) / 2
    return at


def unseen_margins(positive: Rows, clean: Rows, unlabelled: Rows, prior: float) -> tuple[list[float], list[float]]:
    """Margins of labelled rows, each by a model trained without its fold."""
    toxic, fine = [], []
    for fold in range(FOLDS):
        model = fit([r for i, r in enumerate(positive) if i % FOLDS != fold], unlabelled, prior)
        toxic += [model.margin(r.tolist()) for r in positive[fold::FOLDS]]
        fine += [model.margin(r.tolist()) for r in clean[fold::FOLDS]]
    return toxic, fine


_SAMPLE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("k", T.BinaryType())])


def _sampled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"doc_id": frame["doc_id"], "kind": frame["kind"], "k": [np.array(sorted(features(t)), "<u4").tobytes() for t in frame["text"]]})


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Train from the rows of ``docs`` outside the held-out part.

    The samples are the rows of least doc_id hash, up to the stated bounds;
    the class prior is the share of toxic rows among all labelled rows of the
    learning part. Rows with a null doc_id or label teach nothing. What the
    training took of the driver's memory goes back when it has ended.
    """
    try:
        return _learned(docs, labels)
    finally:
        give_back()


def _learned(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    if not counts["p"]:
        return Model({}, -5.0)
    prior = min(0.9, counts["p"] / counts["n"])
    order = F.xxhash64("doc_id")
    marked = known.where("toxic = 1").orderBy(order, "doc_id").limit(MAX_POSITIVE)
    clean = known.where("toxic = 0").orderBy(order, "doc_id").limit(MAX_POSITIVE)
    learnable = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    free = learnable.distinct().join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(MAX_UNLABELLED)
    chosen = marked.select("doc_id", F.lit("p").alias("kind")).unionByName(clean.select("doc_id", F.lit("n").alias("kind"))).unionByName(free.select("doc_id", F.lit("u").alias("kind")))
    # Bounded by the sample sizes, with one text for each id.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "kind").agg(F.min("text").alias("text"))
    rows = texts.mapInPandas(handing_back(_sampled), _SAMPLE).toArrow()
    kinds, keys = rows.column("kind").to_pylist(), rows.column("k")
    sets: dict[str, Rows] = {}
    for i in np.argsort(rows.column("doc_id").to_numpy()).tolist():
        sets.setdefault(kinds[i], []).append(np.frombuffer(keys[i].as_buffer(), "<u4"))
    positive, clean_rows, unlabelled = sets.get("p", []), sets.get("n", []), sets.get("u", [])
    if not unlabelled:  # a wholly labelled table: its own rows, without their labels, are the unlabelled text
        unlabelled = clean_rows + positive
    model = fit(positive, unlabelled, prior)
    model.point = operating_point(*unseen_margins(positive, clean_rows, unlabelled, prior), prior)
    return model


def scorer(docs: DataFrame, labels: DataFrame) -> Callable[[str], Column]:
    """A function from a text column to its score, by a model learned from ``docs``."""
    model = learn(docs, labels)

    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from handing_back(scores)(parts)

    return score


def score_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Null and empty texts get the score of a text without words; a null doc_id
    counts as not held out; repeated rows are scored each.
    """
    score = scorer(docs, labels)
    key = F.col("doc_id").cast("long")
    scored = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= CUTOFF, 1).otherwise(0).cast("int"))
