import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import Floors
from tidemark.operators import identity as I
from tidemark.operators import names as N
from tidemark.operators import releases as R

D1, D2 = datetime.date(2024, 1, 1), datetime.date(2024, 6, 1)


def artifacts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "artifact string")


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.LEDGER)


def test_prefix_routing_is_case_sensitive_and_tokens_are_lower(spark):
    got = {tuple(r) for r in I.route(artifacts(spark, "r-cran-Abc", "R-CRAN-x", "r-bioc-y", "r-other-z", "lib", "r-cran-Abc")).collect()}
    assert got == {("r-cran-Abc", "cran", "abc"), ("r-bioc-y", "bioc", "y"), ("r-other-z", "other", "z")}


def test_lookup_falls_back_to_the_token_and_skips_other(spark):
    book = ledger(spark, ("abc", "ABC", "live"), ("z", "Z", "live"))
    got = {r.artifact: (r.display_name, r.lifecycle) for r in I.resolve(artifacts(spark, "r-cran-abc", "r-bioc-new", "r-other-z"), book).collect()}
    assert got == {"r-cran-abc": ("ABC", "live"), "r-bioc-new": ("new", None), "r-other-z": ("z", None)}


def test_one_namespace_wins_a_token(spark):
    got = I.resolve(artifacts(spark, "r-other-a", "r-bioc-a", "r-cran-a", "r-bioc-b", "r-other-b"), I.empty_ledger(spark)).collect()
    assert {(r.item, r.artifact) for r in got} == {("a", "r-cran-a"), ("b", "r-bioc-b")}


def test_ledgers_merge_with_precedence_and_gate(spark):
    cran, bioc = ledger(spark, ("a", "A", "live")), ledger(spark, ("a", "aa", "archived"), ("b", "B", None))
    assert {tuple(r) for r in I.gated_ledger(cran, bioc, Floors(1, 2)).collect()} == {("a", "A", "live"), ("b", "B", None)}
    with pytest.raises(I.LedgerGate, match="bioc"):
        I.gated_ledger(cran, bioc, Floors(1, 3))


def entry(channel, name, release, arch, sid):
    return (channel, sid, name, release, arch, "Published", None)


def test_roster_prefers_an_architecture_and_starts_unfetched(spark):
    rows = [entry("m", "r-cran-a", "1", "arm64", 1), entry("m", "r-cran-a", "1", "amd64", 9), entry("m", "r-cran-a", "2", "i386", 4), entry("m", "r-cran-a", "2", "arm64", 3), entry("m", "zzz", "1", "amd64", 5)]
    got = R.build_roster(spark.createDataFrame(rows, schemas.ENTRIES), I.empty_ledger(spark))
    assert got.schema.names == schemas.RELEASES.names
    assert sorted((r.release, r.source_id, r.last_day, r.done) for r in got.collect()) == [("1", 9, None, False), ("2", 3, None, False)]


def roster(spark, *rows):
    full = [(c, a, v, 1, i, "cran", "old", None, None, d, done) for c, a, v, i, d, done in rows]
    return spark.createDataFrame(full, schemas.RELEASES)


def test_append_keeps_known_rows_and_enrich_changes_only_matched_ones(spark):
    old = roster(spark, ("m", "r-cran-a", "1", "a", D1, True))
    found = roster(spark, ("m", "r-cran-a", "1", "a", None, False), ("m", "r-cran-b", "1", "b", None, False))
    both = R.append_missing(old, found)
    assert sorted((r.artifact, r.last_day) for r in both.collect()) == [("r-cran-a", D1), ("r-cran-b", None)]
    new = spark.createDataFrame([("r-cran-b", "b", "cran", "B", "live")], schemas.IDENTITY)
    assert {r.artifact: (r.display_name, r.lifecycle) for r in R.enrich(both, new).collect()} == {"r-cran-a": ("old", None), "r-cran-b": ("B", "live")}


def test_active_tail_and_bounds(spark):
    df = roster(spark, ("m", "a", "1", "a", None, True), ("m", "b", "1", "b", D2, True), ("m", "c", "1", "c", D1, True), ("m", "d", "1", "d", D1, False), ("m", "e", "1", "e", D1, None))
    today = F.lit(D2 + datetime.timedelta(days=180))
    assert {r.artifact for r in R.active_tail(df, today).collect()} == {"a", "b", "d", "e"}
    assert R.active_tail(df, today, force=True).count() == 5
    assert {r[0] for r in df.select(R.lower_bound()).collect()} == {None, D1 - datetime.timedelta(days=90), D2 - datetime.timedelta(days=90)}


def test_fetches_are_recorded_and_last_days_never_go_back(spark):
    df = roster(spark, ("m", "a", "1", "a", D2, False), ("m", "b", "1", "b", None, False), ("m", "c", "1", "c", D1, False))
    fetched = spark.createDataFrame([("m", "a", "1", D1), ("m", "b", "1", None)], "channel string, artifact string, release string, day date")
    got = {r.artifact: (r.last_day, r.done) for r in R.record_fetch(df, fetched).collect()}
    assert got == {"a": (D2, True), "b": (None, True), "c": (D1, False)}
    assert [r.artifact for r in R.never_counted(R.record_fetch(df, fetched)).collect()] == ["b"]


def test_candidate_names(spark):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    got = N.candidates(names("A", None, "", "b"), names("b", "c"), names("A"), ("r-extra",))
    assert {r.name for r in got.collect()} == {"r-cran-a", "r-cran-b", "r-cran-c", "r-bioc-a", "r-extra"}
    assert N.limited(got, 0).count() == 5 and [r.name for r in N.limited(got, 2).collect()] == ["r-bioc-a", "r-cran-a"]
    assert {r.name for r in N.remaining(names("x", "x", "y"), names("y")).collect()} == {"x"}
    assert {r.name for r in N.already(names("x", "y"), names("y")).collect()} == {"y"}
    assert N.united(names("x", "y"), names("y")).count() == 2


def test_key_checks(spark):
    df = spark.createDataFrame([("a", D1, 1), ("a", D1, 2)], schemas.DAILY)
    with pytest.raises(schemas.KeyViolation, match="repeated"):
        schemas.require_key(df, "item", "day")
    with pytest.raises(schemas.KeyViolation, match="null"):
        schemas.require_key(df.withColumn("x", F.lit(None)), "x")


def test_older_tables_gain_missing_columns_even_without_rows(spark):
    old = spark.createDataFrame([], "item string, namespace string")
    assert schemas.conform(old, schemas.SUMMARY).schema.names == schemas.SUMMARY.names
