import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import daily as D

D1, D2, D3 = (datetime.date(2024, 1, i) for i in (1, 2, 3))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_aggregate_sums_versions_and_countries_and_counts_what_it_drops(spark):
    raw = spark.createDataFrame([("m", "r-cran-a", "1", D1, 2), ("m", "r-cran-a", "2", D1, 3), ("m", "r-cran-a", "2", D1, 4), ("m", "x", "1", D1, 9), ("m", "r-cran-a", "1", None, 5), ("m", "r-cran-a", "1", D2, None)], schemas.RAW_COUNTS)
    identity = spark.createDataFrame([("r-cran-a", "a"), ("r-cran-a", "a")], "artifact string, item string")
    seen = Observation("raw")
    assert rows(D.aggregate_counts(raw, identity, seen).select("item", "day", "n")) == [("a", D1, 9)]
    assert seen.get["dropped"] == 2


@pytest.mark.parametrize("n", range(1, 9))
def test_partials_add_up_however_they_are_split(spark, n):
    whole = spark.createDataFrame([(f"i{k % 5}", D1 if k % 2 else D2, k) for k in range(40)], schemas.DAILY)
    parts = [whole.where(F.col("n") % n == i).groupBy("item", "day").agg(F.sum("n").alias("n")) for i in range(n)]
    assert rows(D.sum_partials(*parts)) == rows(whole.groupBy("item", "day").agg(F.sum("n").alias("n")))


def test_upsert_new_wins_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", D1, 1), ("a", D2, 2)], schemas.DAILY)
    new = spark.createDataFrame([("a", D2, 5), ("b", D3, 7)], schemas.DAILY)
    once = D.upsert(old, new)
    assert rows(once) == [("a", D1, 1), ("a", D2, 5), ("b", D3, 7)] == rows(D.upsert(once, new))


def test_keep_first_takes_the_first_source(spark):
    one = spark.createDataFrame([("a", D1, 1)], schemas.DAILY)
    two = spark.createDataFrame([("a", D1, 9), ("b", D1, 2)], schemas.DAILY)
    assert rows(D.keep_first(one, two)) == [("a", D1, 1), ("b", D1, 2)]


def test_year_and_recent_extracts_include_their_edges(spark):
    days = [datetime.date(2023, 12, 31), D1, datetime.date(2024, 12, 31), datetime.date(2025, 1, 1)]
    df = spark.createDataFrame([("a", d, 1) for d in days], schemas.DAILY)
    assert [r[1] for r in rows(D.year_extract(df, 2024))] == days[1:3]
    assert [r[1] for r in rows(D.recent_extract(df, F.lit(datetime.date(2024, 1, 11)), 10))] == days[1:]


def test_coverage_counts_null_days_but_ranges_ignore_them(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", D2, 1), ("b", None, 1)], "item string, day date, n long")
    assert rows(D.coverage(df, "item")) == [("a", 2, D2, D2), ("b", 1, None, None)]
    assert D.anchor_day(df) == D2 and D.anchor_day(df.where("false")) is None


@pytest.mark.parametrize("n", [1, 3, 7])
def test_shards_are_disjoint_complete_and_balanced(spark, n):
    df = spark.range(20).select(F.col("id").alias("k"))
    out = D.shard_rows(df, ["k"], n).collect()
    sizes = [sum(r.shard == i for r in out) for i in range(n)]
    assert sorted(r.k for r in out) == list(range(20)) and max(sizes) - min(sizes) <= 1
    assert D.shard_rows(df, ["k"], 0).count() == 0


def test_letters(spark):
    df = spark.createDataFrame([("Abc",), ("zoo",), ("9x",), ("",), ("émile",), (None,)], "item string")
    assert [r.letter for r in D.by_letter(df).collect()] == ["a", "z", "0", "0", "0", "0"]


def test_plan_prunes_and_pushes(spark, tmp_path):
    spark.createDataFrame([("a", D1, 1)], schemas.DAILY).write.parquet(str(tmp_path / "d"))
    plan = D.year_extract(spark.read.parquet(str(tmp_path / "d")), 2024).select("item")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,2024-01-01)" in plan and "n:bigint" not in plan
