import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_text_operators import brute_join, brute_secrets
from tidemark.llm import bpe_tree, pu_toxicity, soft_mixing
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage gets and gives, written and read again."""
    docs, out = table(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"stage{k}") / "out")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def masked(text):
    out, at = [], 0
    for a, _, b in brute_secrets(text):
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_stage_names_and_columns(spark, steps):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    columns = table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, after in steps[:-1])


def test_toxic_documents_go(spark, steps):
    before, after = steps[0]
    score = {r.doc_id: r.predicted for r in pu_toxicity.score_table(before, table(spark, SF, "labels")).collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if not score[i]}


def test_one_of_each_group_stays(steps):
    before, after = steps[1]
    component, _ = brute_join(list(texts(before).items()))
    assert texts(after) == {i: t for i, t in texts(before).items() if component[i] == i}


def test_secrets_are_masked(steps):
    before, after = steps[2]
    assert texts(after) == {i: masked(t) for i, t in texts(before).items()}
    assert not any(re.search(r"[0-9a-f]{24}", t) for t in texts(after).values())


def test_mixing_takes_effect(spark, steps):
    before, after = steps[3]
    rates = soft_mixing.mix(before, soft_mixing.label_domains(table(spark, SF, "labels")), corpus_pipeline.TARGETS, keep="clean")
    want = {r.doc_id: r.copies for r in rates.collect() if r.copies}
    assert Counter(r.doc_id for r in after.collect()) == Counter(want)


def test_text_is_encoded(steps):
    before, after = steps[4]
    ranks = bpe_tree.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known = texts(before)
    assert before.count() == after.count()
    for r in after.collect():
        ids = lib.encode_ordinary(known[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_ids_come_out(steps):
    before, after = steps[4]
    bpe = bpe_tree.TreeBpe(bpe_tree.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    known, rows = texts(before), after.collect()
    assert rows
    for r in rows:
        ids = [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)]
        assert len(ids) == r.n_tokens and bpe.decode(ids) == (known[r.doc_id] or "").encode()
        assert hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() == r.ids_sha256
