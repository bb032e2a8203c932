import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import data
from tidemark.llm import flat_graph, pu_toxicity, soft_mixing

VECTORS = "vec_id long, embedding array<float>, label int, shard int, home boolean, v string"


def brute_links(rows, threshold=0.98):
    up, links = {}, {}

    def root(i):
        return i if up[i] == i else root(up[i])

    def ok(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    known = {}
    for i, v, label in rows:
        up[i], links[i] = i, set()
        known.setdefault(i, []).append((v, label))
    for a in known:
        for b in known:
            for v, l in known[a]:
                for w, m in known[b]:
                    if a < b and l is not None and l == m and ok(v) and ok(w) and len(v) == len(w):
                        x, y = np.float64(np.float32(v)), np.float64(np.float32(w))
                        if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                            links[a].add(b)
                            links[b].add(a)
                            p, q = sorted((root(a), root(b)))
                            up[q] = p
    return {i: (len(links[i]), root(i)) for i in up}


def vectors(n=260, dims=16):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(n):
        kind = i % 5
        if kind == 0 or not rows:
            v = rnd.normal(size=dims)
        elif kind == 1:
            v = np.array(rows[-1][1]) + rnd.normal(size=dims) * 0.03
        elif kind == 2:
            v = np.ones(dims) + rnd.normal(size=dims) * 0.02  # one dense group
        elif kind == 3:
            v = np.array(rows[-2][1])
        else:
            v = rnd.normal(size=dims)
        rows.append((i, [float(c) for c in v], i % 2 if kind != 2 else 0))
    rows += [(1000, None, 0), (1001, [0.0] * dims, 0), (1002, [float("nan")] * dims, 0), (1003, [None] + [1.0] * (dims - 1), 0), (1004, rows[0][1], None), (1005, [1.0, 2.0], 0), (1006, [float("inf")] + [1.0] * (dims - 1), 0), (1007, [], 0), (0, *rows[0][1:])]
    return rows


@pytest.mark.parametrize("shard_rows, block_rows", [(30, 8000), (2500, 8000), (2500, 25)])
def test_links_of_vectors(spark, monkeypatch, shard_rows, block_rows):
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(flat_graph, "BLOCK_ROWS", block_rows)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, True, "x") for r in rows], VECTORS)
    got = flat_graph.near_duplicates(df).collect()
    want = brute_links(rows)
    assert len(got) == len(rows)
    true = sum(n for n, _ in want.values())
    found = sum(min(r.n_links, want[r.vec_id][0]) for r in {r.vec_id: r for r in got}.values())
    assert found >= 0.95 * true and all(r.n_links <= want[r.vec_id][0] for r in got)
    if shard_rows > len(rows) and block_rows > len(rows):
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def dense_and_pairs(seed, dense, pairs, cosine, ids):
    """A dense group, and planted pairs of the given cosine that link with nothing else; ids of all, and of the pairs."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    centre, a = unit(rng.normal(size=64)), unit(rng.normal(size=(pairs, 64)))
    ball = unit(centre + 0.05 * unit(rng.normal(size=(dense, 64))))
    off = rng.normal(size=(pairs, 64))
    off = unit(off - (off * a).sum(axis=1, keepdims=True) * a)
    x = np.concatenate([ball, a, cosine * a + np.sqrt(1 - cosine**2) * off])
    ids = [ids(int(i)) for i in rng.permutation(len(x))]
    return [(i, v, 1) for i, v in zip(ids, x.tolist())], list(zip(ids[dense : dense + pairs], ids[dense + pairs :]))


def test_links_across_blocks_beside_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", 100_000)
    monkeypatch.setattr(flat_graph, "BLOCK_ROWS", 700)
    rows, planted = dense_and_pairs(3, 1500, 250, 0.995, lambda i: i)
    df = spark.createDataFrame([(*r, 1, True, "x") for r in rows], VECTORS)
    got = {r.vec_id: r for r in flat_graph.near_duplicates(df).collect()}
    found = sum(got[a].n_links == got[b].n_links == 1 and got[a].component_id == got[b].component_id for a, b in planted)
    assert found == len(planted)


def test_audit_sees_what_a_dense_group_hides(spark, monkeypatch):
    """Shards that hardly overlap tear partners apart, and no vec_id is divisible by 100."""
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", 50)
    monkeypatch.setattr(flat_graph, "MARGIN", 0.0)
    monkeypatch.setattr(flat_graph, "WIDER", 0)
    rows, planted = dense_and_pairs(5, 200, 300, 0.75, lambda i: 100 * i + 1)
    df = spark.createDataFrame([(*r, 1, True, "x") for r in rows], VECTORS)
    got = {r.vec_id: r for r in flat_graph.near_duplicates(df, 0.7).collect()}
    x = np.array([v for _, v, _ in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert sum(got[a].n_links > 0 for a, _ in planted) == len(planted)
    assert [got[i].n_links for i, _, _ in rows] == ((x @ x.T >= 0.7).sum(axis=1) - 1).tolist()
    assert all(got[a].component_id == got[b].component_id for a, b in planted)
    assert {r.audit_recall for r in got.values()} == {1.0}


def test_a_vec_id_with_several_vectors_counts_its_partners_once(spark):
    rnd = np.random.default_rng(2)
    a, b, far = rnd.normal(size=16), rnd.normal(size=16), rnd.normal(size=16)
    near = lambda v: [float(c) for c in v + rnd.normal(size=16) * 0.01]
    rows = [(7, near(a), 0), (7, near(a), 0), (9, near(a), 0), (3, near(b), 0), (7, near(b), 0), (20, near(b), 0), (20, near(b), 1), (30, near(far), 1), (None, near(a), 0), (40, near(b), 1)]
    rows.append((50, *rows[0][1:]))  # the same vector as one of 7
    df = spark.createDataFrame([(*r, 1, True, "x") for r in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id) for r in flat_graph.near_duplicates(df).collect()}
    assert got.pop(None) == (0, None)
    assert got == brute_links([r for r in rows if r[0] is not None]) and got[9] == (2, 3)


def test_vectors_without_rows(spark):
    assert flat_graph.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def corpus(n=1200):
    rnd = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        words = data.prose(rnd, rnd.randint(20, 200), 300).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(["vile", "nasty", "awful"])
        docs.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_is_learned_without_held_out_labels(spark):
    docs, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = data.frame(spark, docs + [(5000, None), (5001, ""), (5001, "")])
    got = {r.doc_id: r for r in pu_toxicity.score_table(df, lab).collect()}
    assert len(got) == 1202 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [r for r in got.values() if r.held_out and r.doc_id < 5000]
    right = sum(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held) and got[5000].score == got[5001].score and got[5000].predicted == 0
    # Labels of the held-out part, and rows that teach nothing, change no score.
    flipped = lab.withColumn("toxic", F.when(pu_toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    odd = flipped.unionByName(spark.createDataFrame([(None, 1, 1), (7, 1, None)], lab.schema))
    again = {r.doc_id: r.score for r in pu_toxicity.score_table(df, odd).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def test_operating_point_parts_no_ties():
    assert pu_toxicity.operating_point([-5.0, -5.0], [-5.0], 0.5) > -5
    assert pu_toxicity.operating_point([2.0, 1.0, -5.0], [-5.0, -5.0], 0.3) == -2.0


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in pu_toxicity.score_table(data.frame(spark, [(1, "a b")]), none).collect()} == {0}
    assert pu_toxicity.score_table(data.frame(spark, []), none).count() == 0


def domains(spark):
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        kind = ("clean", "junk", "toxic")[0 if i % 4 < 2 else i % 4 - 1]
        docs.append((i, " ".join(f"{kind[0]}{rnd.randrange(40)}" if rnd.random() < 0.6 else f"w{rnd.randrange(200)}" for _ in range(rnd.randint(10, 150)))))
        if i % 3 == 0:
            labels.append((i, kind))
    return docs, spark.createDataFrame(labels + [(None, "junk"), (1, "unheard-of")], "doc_id long, domain string")


def test_mixing_meets_its_targets(spark):
    docs, labels = domains(spark)
    targets = {"clean": 0.7, "junk": 0.1, "toxic": 0.2}
    rows = soft_mixing.mix(data.frame(spark, docs + [(1000, None), (1001, ""), (5, docs[5][1])]), labels, targets).collect()
    assert len(rows) == 602  # one for each distinct document
    totals = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in targets}
    whole = sum(r.n_tokens for r in rows)
    for d, share in targets.items():
        assert totals[d] == pytest.approx(share * whole, rel=1e-5)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert all(r.p_clean + r.p_junk + r.p_toxic == pytest.approx(1) for r in rows)
    right = sum(max(targets, key=lambda d: r[f"p_{d}"]) == ("clean", "junk", "toxic")[0 if r.doc_id % 4 < 2 else r.doc_id % 4 - 1] for r in rows if r.doc_id < 600)
    assert right >= 0.97 * 600


def test_kept_domain_is_not_thinned(spark):
    docs, labels = domains(spark)
    df = data.frame(spark, docs)
    rates = soft_mixing.mix(df, labels, {"clean": 0.94, "junk": 0.03, "toxic": 0.03}, keep="clean")
    out = soft_mixing.resample(df, rates)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    clean = {i for i, _ in docs if i % 4 < 2}
    assert len(clean - kept) <= 0.03 * len(clean) and len(kept - clean) < 0.5 * (600 - len(clean))


def test_mixing_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = soft_mixing.mix(data.frame(spark, [(1, "a b"), (2, None)]), none, {"a": 1.0, "b": 1.0}).collect()
    assert all(r.p_a == pytest.approx(0.5) for r in rows)
    assert soft_mixing.mix(data.frame(spark, []), none, {"a": 1.0, "b": 1.0}).count() == 0
    assert soft_mixing.label_domains(spark.createDataFrame([(1, 0, 1), (2, 1, 1), (3, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")).collect() == [(1, "junk"), (2, "toxic"), (3, "clean")]
