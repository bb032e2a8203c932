import datetime

import pytest

from tidemark import schemas
from tidemark.config import Windows
from tidemark.operators import summary as S

A = datetime.date(2024, 12, 31)


def ago(n):
    return A - datetime.timedelta(days=n)


def daily(spark, *rows):
    return spark.createDataFrame([(i, ago(d), n) for i, d, n in rows], schemas.DAILY)


def nobody(spark):
    return spark.createDataFrame([], schemas.IDENTITY)


def test_window_edges(spark):
    df = daily(spark, ("a", 0, 1), ("a", 30, 2), ("a", 31, 4), ("a", 59, 8), ("a", 60, 16), ("a", 90, 32), ("a", 91, 64), ("a", 365, 128), ("a", 366, 256))
    r = S.window_totals(df, A).first()
    assert (r.total_30d, r.prev_30d, r.total_90d, r.total_365d, r.n_total) == (3, 12, 63, 255, 511)
    assert (r.first_day, r.last_day) == (ago(366), A)


def test_average_and_trend_round_half_even(spark):
    r = S.build(daily(spark, ("a", 0, 33), ("a", 40, 32), ("b", 0, 5)), nobody(spark), A).collect()
    a, b = r
    assert (a.item, a.avg_daily_30d, a.trend) == ("a", 1.1, 3.12)  # 3.125
    assert b.trend is None and b.namespace == "other" and b.display_name == "b"


def test_ranks_share_the_least_and_order_is_by_rank_then_name(spark):
    r = S.build(daily(spark, ("b", 0, 5), ("a", 0, 5), ("c", 0, 1), ("d", 200, 9)), nobody(spark), A).collect()
    assert [(x.item, x.rank_30d, x.rank_365d) for x in r] == [("a", 1, 2), ("b", 1, 2), ("c", 3, 4), ("d", 4, 1)]


def test_items_are_carried_forward(spark):
    prior = S.build(daily(spark, ("gone", 300, 7), ("a", 400, 1)), nobody(spark), ago(200))
    r = {x.item: x for x in S.build(daily(spark, ("a", 1, 2)), nobody(spark), A, prior).collect()}
    assert (r["a"].first_day, r["a"].n_total, r["a"].rank_30d) == (ago(400), 2, 1)
    assert (r["gone"].total_30d, r["gone"].avg_daily_30d, r["gone"].trend, r["gone"].n_total, r["gone"].rank_30d) == (0, 0.0, None, 7, 2)


def test_identity_does_not_multiply_rows(spark):
    twice = spark.createDataFrame([("r-cran-a", "a", "cran", "A", "live"), ("r-bioc-a", "a", "bioc", "AA", None)], schemas.IDENTITY)
    r = S.build(daily(spark, ("a", 0, 1)), twice, A).collect()
    assert len(r) == 1 and r[0].namespace == "bioc"


def test_empty(spark):
    out = S.build(spark.createDataFrame([], schemas.DAILY), nobody(spark), A)
    assert out.collect() == [] and out.schema.names == schemas.SUMMARY.names


def test_top(spark):
    s = S.build(daily(spark, ("a", 0, 1), ("b", 0, 2), ("c", 0, 2)), nobody(spark), A)
    assert [r.item for r in S.top(s, 2).collect()] == ["b", "c"] == [r.item for r in S.top(s, 2, "total_30d").collect()]


def test_windows_invariant():
    with pytest.raises(ValueError):
        Windows(recent=270)
