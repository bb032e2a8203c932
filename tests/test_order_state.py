import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import order as O
from tidemark.operators import summary as S

D = datetime.date


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("ranges", [1024, 1])
def test_ranks_equal_the_window_function(spark, monkeypatch, ranges):
    monkeypatch.setattr(O, "RANGES", ranges)  # with 1, many values share a range
    rnd = random.Random(4)
    values = [rnd.choice([0, 0, 0, rnd.randrange(50), rnd.randrange(10**9), rnd.randrange(10**6), -rnd.randrange(100), 2**62, None]) for _ in range(800)]
    df = spark.createDataFrame([(i, v, None if v is None else v % 7, 5) for i, v in enumerate(values)], "id long, a long, b long, c long").repartition(7)
    with monkeypatch.context() as m:  # the whole plan, with the parts that are written in between
        m.setattr(O, "frozen", lambda df: df)
        assert "SinglePartition" not in plan_of(O.ranks(df, {"a": "ra", "b": "rb", "c": "rc"}))
    got = O.ranks(df, {"a": "ra", "b": "rb", "c": "rc"})
    want = df.select("*", *(F.rank().over(Window.orderBy(F.desc(c))).cast("long").alias(f"r{c}") for c in "abc"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert O.ranks(df.where("false"), {"a": "ra"}).collect() == []


def test_ranges_rise_with_the_value_and_are_few(spark):
    values = [v for k in range(63) for v in (2**k - 2, 2**k - 1, 2**k, 2**k + 1)] + [-5, -1, 0, -(2**63), 2**63 - 1]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in sorted(values)], "v long").orderBy("v").select(O.value_range(F.col("v"))).collect()]
    assert got == sorted(got) and got[-1] - got[0] <= 2 * 64 * O.RANGES


def test_row_numbers_follow_a_total_order(spark):
    df = spark.createDataFrame([(f"k{i % 13}", i) for i in range(1000)], "a string, b long").repartition(6)
    got = O.numbered(df, ["a", "b"], "place")
    assert "SinglePartition" not in plan_of(got)
    want = {(r.a, r.b): k for k, r in enumerate(sorted(df.collect()))}
    assert {(r.a, r.b): r.place for r in got.collect()} == want
    assert O.numbered(df.where("false"), ["a"], "place").collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_summary_from_states_equals_summary_of_all_days(spark, seed):
    rnd = random.Random(seed)
    days = {}
    for _ in range(500):
        days[f"i{rnd.randrange(12)}", D(2020, 1, 1) + datetime.timedelta(days=rnd.randrange(1600))] = rnd.randrange(1, 9)
    daily = spark.createDataFrame([(i, d, n) for (i, d), n in days.items()], schemas.DAILY)
    identity = spark.createDataFrame([(f"r-cran-i{k}", f"i{k}", "cran", f"I{k}", "live") for k in range(6)], schemas.IDENTITY)
    anchor = max(d for _, d in days) - datetime.timedelta(days=rnd.choice([0, 20]))
    prior = S.build(daily.where("item < 'i5'"), identity, D(2022, 1, 1))
    current = daily.where("item > 'i2'")
    # States of years in any number of pieces; windows see days from the first open one on.
    states = S.item_state(current, F.year("day").alias("year")).drop("year").repartition(3)
    late = current.where(F.col("day") >= F.lit(S.open_days(anchor)))
    assert S.build_from_state(states, late, identity, anchor, prior).collect() == S.build(current, identity, anchor, prior).collect()
