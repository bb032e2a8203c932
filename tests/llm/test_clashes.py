"""Columns of a user that are named like those an operator makes, null ids, and repeated rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secret_ledger, soft_mixing

DDL = "doc_id long, text string, n_chars long, _secret_blob string, _secret_spans string, _secret_text string, _mix_id long, _mix_hash long, _mix_own long, _mix_own_hash long, _mix_copies long, _mix_turn long, _text string, _blob string, _id long, _hash long"


def clashing(spark, texts):
    return spark.createDataFrame([(i, t, None if t is None else len(t), "b", "s", "t", *range(1, 7), "x", "y", 8, 9) for i, t in texts], DDL)


def test_masking_keeps_columns_of_any_name(spark):
    docs = clashing(spark, [(1, "password: hunter2hunter2 end"), (2, "plain"), (None, "token=abcdefgh"), (3, None)])
    got = secret_ledger.redact(docs)
    assert got.columns == docs.columns
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert set(rows) == {(1, "[secret] end"), (2, "plain"), (None, "[secret]"), (3, None)}
    assert all(tuple(r)[3:] == ("b", "s", "t", *range(1, 7), "x", "y", 8, 9) for r in rows.values())


def labels(spark):
    return spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(40)], "doc_id long, domain string")


def texts():
    return [(i, ("red green blue " if i % 2 else "one two three ") * 5) for i in range(40)]


def test_resampling_keeps_columns_of_any_name_and_draws_by_text(spark):
    docs = clashing(spark, texts() + [(None, f"red one {i}") for i in range(200)])
    rates = soft_mixing.mix(docs, labels(spark), {"a": 0.5, "b": 0.5})
    out = soft_mixing.resample(docs, rates)
    assert out.columns == docs.columns and all(tuple(r)[3:] == ("b", "s", "t", *range(1, 7), "x", "y", 8, 9) for r in out.collect())
    half = rates.selectExpr("doc_id", "text_hash", "0.5D as rate").select("doc_id", "text_hash", soft_mixing.copies(F.col("rate"), F.col("doc_id"), F.col("text_hash")).alias("copies"))
    kept = soft_mixing.resample(docs, half).where("doc_id is null").count()
    assert 60 < kept < 140  # not all, and not none


def test_repeated_rows_are_no_further_evidence(spark):
    once = {r.doc_id: r for r in soft_mixing.mix(clashing(spark, texts() + [(99, "red two three")]), labels(spark), {"a": 0.5, "b": 0.5}).collect()}
    docs = clashing(spark, texts() + [(99, "red two three")] * 3)
    thrice = {r.doc_id: r for r in soft_mixing.mix(docs, labels(spark), {"a": 0.5, "b": 0.5}).collect()}
    assert (thrice[99].n_tokens, thrice[99].n_rows, once[99].n_tokens, once[99].n_rows) == (9, 3, 3, 1) and thrice[99].p_a == pytest.approx(once[99].p_a, abs=1e-12)
    for rows in (once, thrice):
        totals = [sum(r.rate * r.n_tokens * r[p] for r in rows.values()) for p in ("p_a", "p_b")]
        assert totals[0] == pytest.approx(totals[1], rel=1e-5) and all(r.missed < 1e-5 for r in rows.values())


def test_targets_that_cannot_be_met_are_told(spark):
    docs, none = clashing(spark, [(1, "x y"), (2, "z")]), labels(spark).where("false")
    rows = soft_mixing.mix(docs, none, {"a": 0.1, "b": 0.9}).collect()
    assert all(r.missed > 0.3 for r in rows)
    with pytest.raises(soft_mixing.TargetsMissed, match="targets"):
        soft_mixing.mix(docs, none, {"a": 0.1, "b": 0.9}, tolerance=0.05)
