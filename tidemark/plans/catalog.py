"""The registered queries of the analytics engine, each with its SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import daily as D
from tidemark.operators import identity as I
from tidemark.operators import names as N
from tidemark.operators import releases as R
from tidemark.operators import summary as S
from tidemark.operators.facts import facts_of, replace_intervals
from tidemark.operators.order import numbered, ranks
from tidemark.plans import adapter as A
from tidemark.schemas import RELEASES, SUMMARY, conform, empty
from tidemark.sinks.publish import merge_coverage, year_coverage
from tidemark.sources import pages as P
from tidemark.sources import urls as U
from tidemark.sources.universes import field, stanzas

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Where the data are split for upserts and carrying forward, and the day of the active tail.
SPLIT = datetime.date(2000, 1, 1)
TODAY = datetime.date(1998, 9, 1)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _identity(spark: SparkSession, sf: str) -> DataFrame:
    ledger = I.merge_ledgers(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc"))
    # Artifacts come from the parts, not from every line: the roster of names is small.
    return I.resolve(A.parts(spark, sf).select("artifact"), ledger)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return D.aggregate_counts(A.raw_counts(spark, sf), _identity(spark, sf))


def _item_days(spark: SparkSession, sf: str) -> DataFrame:
    return D.sum_partials(A.item_counts(spark, sf).select("item", "day", "n"))


def _anchor(spark: SparkSession, sf: str) -> datetime.date:
    """One value, so that it reaches the scan as a literal."""
    return A.table(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]


_ITEM_DAYS = "days AS (SELECT item, day, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY item, day)"
_WINDOWS = """a AS (SELECT max(CAST(l_shipdate AS DATE)) AS d FROM lineitem),
totals AS (SELECT item, min(day) AS first_day, max(day) AS last_day, CAST(sum(n) AS BIGINT) AS n_total,
  CAST(sum(CASE WHEN day >= d - 30 THEN n ELSE 0 END) AS BIGINT) AS total_30d, CAST(sum(CASE WHEN day >= d - 90 THEN n ELSE 0 END) AS BIGINT) AS total_90d,
  CAST(sum(CASE WHEN day >= d - 365 THEN n ELSE 0 END) AS BIGINT) AS total_365d, CAST(sum(CASE WHEN day > d - 60 AND day < d - 30 THEN n ELSE 0 END) AS BIGINT) AS prev_30d
  FROM {source} CROSS JOIN a GROUP BY item)"""
_AVG = "round_even(total_30d / 30.0, 2) AS avg_daily_30d, CASE WHEN prev_30d > 0 THEN round_even((total_30d / CAST(prev_30d AS DOUBLE) - 1) * 100, 2) END AS trend"
_DAYS_WINDOWS = f"WITH {A.RAW}, {_ITEM_DAYS}, {_WINDOWS.format(source='days')}"
_AVG = _AVG.replace("total_30d / 30.0", "CAST(total_30d AS DOUBLE) / 30")


# -- daily counts -----------------------------------------------------------


@query(f"WITH {A.RESOLVED}, {A.DAILY} SELECT item, day, n FROM daily")
def daily_counts(spark, sf):
    return _daily(spark, sf)


@query(f"WITH {A.RAW}, {_ITEM_DAYS} SELECT item, day, n FROM days")
def daily_merge_partials(spark, sf):
    """Four partial tables, by release, added up again; one scan makes all four."""
    partial = A.item_counts(spark, sf).groupBy((F.col("p_partkey") % 4).alias("part"), "item", "day").agg(F.sum("n").cast("long").alias("n"))
    return D.sum_partials(partial.select("item", "day", "n"))


@query(f"WITH {A.RAW}, old AS (SELECT item, day, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE day < DATE '2000-07-01' GROUP BY item, day), new AS (SELECT item, day, CAST(sum(n) AS BIGINT) + 1 AS n FROM counts WHERE day >= DATE '2000-01-01' GROUP BY item, day) SELECT item, day, n FROM new UNION ALL SELECT item, day, n FROM old ANTI JOIN new USING (item, day)")
def daily_upsert_new_wins(spark, sf):
    raw = A.item_counts(spark, sf)
    old = raw.where(F.col("day") < F.lit(datetime.date(2000, 7, 1))).groupBy("item", "day").agg(F.sum("n").cast("long").alias("n"))
    new = raw.where(F.col("day") >= F.lit(SPLIT)).groupBy("item", "day").agg((F.sum("n") + 1).cast("long").alias("n"))
    return D.upsert(old, new)


@query(f"WITH {A.RAW}, p AS (SELECT p_partkey % 4 AS s, item, day, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL) SELECT item, day, n FROM (SELECT *, row_number() OVER (PARTITION BY item, day ORDER BY s) AS pos FROM p) WHERE pos = 1")
def daily_keep_first(spark, sf):
    """Four sources, tagged in one scan."""
    tagged = A.item_counts(spark, sf).groupBy((F.col("p_partkey") % 4).alias("source"), "item", "day").agg(F.sum("n").cast("long").alias("n"))
    return D.keep_least_source(tagged)


@query(f"WITH {A.RAW}, {_ITEM_DAYS} SELECT item, day, n FROM days WHERE year(day) = 1998")
def year_extract(spark, sf):
    return D.year_extract(_item_days(spark, sf), 1998)


@query(f"WITH {A.RAW}, {_ITEM_DAYS} SELECT item, day, n FROM days WHERE day >= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 400")
def recent_extract(spark, sf):
    return D.recent_extract(_item_days(spark, sf), F.lit(_anchor(spark, sf)), 400)


@query("SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE l_shipdate IS NOT NULL")
def year_partitions(spark, sf):
    return D.years(A.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")))


@query("WITH x AS (SELECT CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_shipdate AS DATE) END AS day, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem) SELECT year, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM x GROUP BY year")
def coverage_by_year(spark, sf):
    """Rows without a day count as rows and not for the range."""
    day = F.col("l_shipdate").cast("date")
    rows = A.table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 11 != 0, day).alias("day"), F.year("l_shipdate").alias("year"))
    return D.coverage(rows, "year")


@query("SELECT max(CAST(l_shipdate AS DATE)) AS anchor FROM lineitem")
def anchor_day(spark, sf):
    return A.table(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date").alias("anchor"))


@query("WITH x AS (SELECT CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END AS day, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_quantity AS BIGINT) END AS n FROM lineitem) SELECT day, CAST(sum(n) AS BIGINT) AS n FROM x WHERE day IS NOT NULL AND n IS NOT NULL GROUP BY day")
def null_day_filter(spark, sf):
    rows = A.table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_shipdate").cast("date")).alias("day"), F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity").cast("long")).alias("n"))
    return D.usable(rows).groupBy("day").agg(F.sum("n").cast("long").alias("n"))


@query("SELECT CAST((row_number() OVER (ORDER BY p_partkey) - 1) % 12 AS INTEGER) AS shard, p_partkey FROM part")
def shard_mod_n(spark, sf):
    return D.shard_rows(A.table(spark, sf, "part").select("p_partkey"), ["p_partkey"], 12).select("shard", "p_partkey")


@query("SELECT p_partkey, CASE WHEN regexp_matches(lower(substr(p_name, 1, 1)), '^[a-z]$') THEN lower(substr(p_name, 1, 1)) ELSE '0' END AS letter FROM part")
def shard_letter(spark, sf):
    return A.table(spark, sf, "part").select("p_partkey", X.shard_letter("p_name").alias("letter"))


# -- summary ----------------------------------------------------------------


@query(f"{_DAYS_WINDOWS} SELECT item, first_day, last_day, n_total, total_30d, total_90d, total_365d, prev_30d FROM totals")
def summary_windows(spark, sf):
    return S.window_totals(_item_days(spark, sf), _anchor(spark, sf))


@query(f"{_DAYS_WINDOWS} SELECT item, {_AVG} FROM totals")
def summary_avg_trend(spark, sf):
    return S.averages(S.window_totals(_item_days(spark, sf), _anchor(spark, sf))).select("item", "avg_daily_30d", "trend")


@query(f"{_DAYS_WINDOWS} SELECT item, rank() OVER (ORDER BY total_30d DESC) AS rank_30d, rank() OVER (ORDER BY total_90d DESC) AS rank_90d, rank() OVER (ORDER BY total_365d DESC) AS rank_365d FROM totals")
def summary_ranks(spark, sf):
    return S.ranked(S.window_totals(_item_days(spark, sf), _anchor(spark, sf))).select("item", "rank_30d", "rank_90d", "rank_365d")


_FULL = f"""WITH {A.RESOLVED}, {A.DAILY}, {_WINDOWS.format(source='daily')},
full_ AS (SELECT item, lower(item) AS item_lower, coalesce(namespace, 'other') AS namespace, coalesce(display_name, item) AS display_name, total_30d, total_90d, total_365d,
  rank() OVER (ORDER BY total_30d DESC) AS rank_30d, rank() OVER (ORDER BY total_90d DESC) AS rank_90d, rank() OVER (ORDER BY total_365d DESC) AS rank_365d,
  {_AVG}, first_day, last_day, n_total, lifecycle FROM totals LEFT JOIN identity USING (item))"""


@query(f"{_FULL} SELECT * FROM full_")
def summary_full(spark, sf):
    """The flagship: identity, daily counts and the ranked summary."""
    return S.build(_daily(spark, sf), _identity(spark, sf), _anchor(spark, sf))


_CARRY = f"""WITH {A.RAW}, cur AS (SELECT item, day, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE day >= DATE '2000-01-01' AND p_partkey % 3 = 0 GROUP BY ALL),
old AS (SELECT item, day, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE day < DATE '2000-01-01' GROUP BY ALL), {_WINDOWS.format(source='cur')},
prior AS (SELECT item, min(day) AS first_day, max(day) AS last_day, CAST(sum(n) AS BIGINT) AS n_total FROM old GROUP BY item),
every AS (SELECT t.item, least(t.first_day, p.first_day) AS first_day, t.last_day, t.n_total, total_30d, total_90d, total_365d, {_AVG} FROM totals t LEFT JOIN prior p USING (item)
  UNION ALL SELECT p.item, p.first_day, p.last_day, p.n_total, 0, 0, 0, 0.0, NULL FROM prior p ANTI JOIN totals USING (item))
SELECT *, rank() OVER (ORDER BY total_30d DESC) AS rank_30d FROM every"""


@query(_CARRY)
def summary_carry_forward(spark, sf):
    """A later part of the data for some items, over a summary of an earlier part."""
    raw = A.item_counts(spark, sf)
    identity = _identity(spark, sf).where(F.lit(False))
    sums = lambda df: df.groupBy("item", "day").agg(F.sum("n").cast("long").alias("n"))
    prior = S.build(sums(raw.where(F.col("day") < F.lit(SPLIT))), identity, SPLIT)
    out = S.build(sums(raw.where((F.col("day") >= F.lit(SPLIT)) & (F.col("p_partkey") % 3 == 0))), identity, _anchor(spark, sf), prior)
    return out.select("item", "first_day", "last_day", "n_total", "total_30d", "total_90d", "total_365d", "avg_daily_30d", "trend", "rank_30d")


@query(f"{_FULL} SELECT item, total_30d, rank_30d FROM full_ ORDER BY rank_30d, item LIMIT 20")
def top20_by_rank(spark, sf):
    return S.top(summary_full(spark, sf), 20).select("item", "total_30d", "rank_30d")


@query(f"{_FULL} SELECT item, total_30d FROM full_ ORDER BY total_30d DESC, item LIMIT 15")
def top15_by_total(spark, sf):
    return S.top(summary_full(spark, sf), 15, "total_30d").select("item", "total_30d")


@query(f"{_FULL} SELECT item, namespace, lifecycle, n_total FROM full_ WHERE rank_30d <= 20")
def summary_sql_view(spark, sf):
    """What a reader asks of the published summary, in SQL."""
    summary_full(spark, sf).createOrReplaceTempView("item_summary")
    return spark.sql("select item, namespace, lifecycle, n_total from item_summary where rank_30d <= 20")


@query(f"{_DAYS_WINDOWS} SELECT item, first_day, last_day, n_total, total_30d, total_90d, total_365d, prev_30d FROM totals")
def summary_from_state(spark, sf):
    """The windows from states of items by year and the days that a window can see, as a refresh makes them."""
    days, anchor = _item_days(spark, sf), _anchor(spark, sf)
    states = S.item_state(days, F.year("day").alias("year")).drop("year")
    return S.totals_from_state(states, days.where(F.col("day") >= F.lit(S.open_days(anchor))), anchor)


@query(f"WITH {A.RAW}, t AS (SELECT channel, artifact, release, CAST(sum(n) AS BIGINT) AS n_total, count(*) AS lines FROM raw GROUP BY ALL) SELECT *, rank() OVER (ORDER BY n_total DESC) AS rank_total, rank() OVER (ORDER BY lines DESC) AS rank_lines FROM t")
def release_ranks(spark, sf):
    """All releases ranked by their totals and by their lines, which many share."""
    totals = A.raw_counts(spark, sf).groupBy(*R.KEY).agg(F.sum("n").cast("long").alias("n_total"), F.count(F.lit(1)).alias("lines"))
    return ranks(totals, {"n_total": "rank_total", "lines": "rank_lines"})


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS place FROM lineitem")
def line_numbers(spark, sf):
    """Every line's place in the order of shipping."""
    lines = A.table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    return numbered(lines, ["l_shipdate", "l_orderkey", "l_linenumber"], "place").drop("l_shipdate")


# -- identity and roster ----------------------------------------------------


@query(f"WITH {A.RAW}, {A.ROUTED} SELECT artifact, namespace, item FROM routed")
def identity_prefix_route(spark, sf):
    return I.route(A.raw_counts(spark, sf))


@query(f"WITH {A.RESOLVED} SELECT artifact, item, namespace, display_name, lifecycle FROM found")
def identity_ledger_lookup(spark, sf):
    ledger = I.merge_ledgers(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc"))
    return I.look_up(I.route(A.raw_counts(spark, sf)), ledger)


@query(f"WITH {A.RESOLVED} SELECT artifact, item, namespace, display_name, lifecycle FROM identity")
def identity_precedence(spark, sf):
    ledger = I.merge_ledgers(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc"))
    return I.resolve(A.raw_counts(spark, sf), ledger)


@query(f"WITH {A.PARTS}, {A.LEDGERS} SELECT name_lower, display_name, lifecycle FROM ledger")
def ledger_merge(spark, sf):
    return I.merge_ledgers(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc"))


@query(f"WITH {A.PARTS}, {A.LEDGERS} SELECT CASE p WHEN 0 THEN 'cran' ELSE 'bioc' END AS ledger, count(*) AS names, count(*) >= CASE p WHEN 0 THEN 15000 ELSE 1500 END AS enough FROM ledgers WHERE f = 1 GROUP BY p")
def ledger_size_gate(spark, sf):
    return I.ledger_sizes(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc"))


@query(f"WITH {A.PARTS}, {A.ENTRIES}, x AS (SELECT *, row_number() OVER (PARTITION BY channel, artifact, release ORDER BY CASE WHEN arch = 'amd64' THEN 0 ELSE 1 END, source_id, arch) AS pos FROM entries) SELECT channel, artifact, release, source_id, arch FROM x WHERE pos = 1")
def release_dedup_prefer_arch(spark, sf):
    return R.dedup(A.entries(spark, sf)).select("channel", "artifact", "release", "source_id", "arch")


def _roster(spark: SparkSession, sf: str) -> DataFrame:
    return R.build_roster(A.entries(spark, sf), I.merge_ledgers(A.ledger(spark, sf, "cran"), A.ledger(spark, sf, "bioc")))


_ROSTER = f"WITH {A.RESOLVED}, {A.ENTRIES}, {A.ROSTER}"


@query(f"{_ROSTER} SELECT *, false AS done FROM roster")
def roster_build(spark, sf):
    return _roster(spark, sf).drop("n_total", "last_day")


@query(f"{_ROSTER} SELECT channel, artifact, release, CASE WHEN channel = 'main' THEN -1 ELSE source_id END AS source_id FROM roster")
def roster_append_missing(spark, sf):
    """A roster of one channel and everything found: what it has stays as it is."""
    found = _roster(spark, sf)
    old = conform(found.where("channel = 'main'").withColumn("source_id", F.lit(-1)), RELEASES)
    return R.append_missing(old, found).select("channel", "artifact", "release", "source_id")


@query(f"{_ROSTER} SELECT channel, artifact, release, item, CASE WHEN channel = 'main' OR item < 'm' THEN display_name ELSE 'old' END AS display_name, CASE WHEN channel = 'main' OR item < 'm' THEN lifecycle END AS lifecycle FROM roster")
def roster_enrich_matched(spark, sf):
    """Only rows whose artifact is resolved anew change."""
    roster = _roster(spark, sf)
    stale = roster.withColumns({"display_name": F.when(F.col("channel") == "main", F.col("display_name")).otherwise(F.lit("old")), "lifecycle": F.when(F.col("channel") == "main", F.col("lifecycle"))})
    return R.enrich(stale, _identity(spark, sf).where("item < 'm'")).select("channel", "artifact", "release", "item", "display_name", "lifecycle")


_STATE = "state AS (SELECT o_orderkey AS id, o_orderstatus <> 'O' AS done, CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS last_day FROM orders)"


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") != "O").alias("done"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderdate").cast("date")).alias("last_day"))


@query(f"WITH {_STATE} SELECT id FROM state WHERE NOT done OR last_day IS NULL OR last_day >= DATE '1998-09-01' - 180")
def active_tail(spark, sf):
    return R.active_tail(_state(spark, sf), F.lit(TODAY)).select("id")


@query(f"WITH {_STATE} SELECT id, last_day - 90 AS since FROM state")
def incremental_bound(spark, sf):
    return _state(spark, sf).select("id", R.lower_bound().alias("since"))


@query(f"{_ROSTER}, seen AS (SELECT channel, artifact, release, max(day) AS d FROM raw WHERE p_partkey % 3 = 0 GROUP BY ALL) SELECT r.channel, r.artifact, r.release, seen.d AS last_day, seen.d IS NOT NULL AS done FROM roster r LEFT JOIN seen ON r.channel = seen.channel AND r.artifact = seen.artifact AND r.release = seen.release")
def roster_state_update(spark, sf):
    fetched = A.raw_counts(spark, sf).where("p_partkey % 3 = 0").select(*R.KEY, "day")
    return R.record_fetch(_roster(spark, sf), fetched).select(*R.KEY, "last_day", "done")


@query(f"{_ROSTER}, t AS (SELECT channel, artifact, release, CAST(sum(n) AS BIGINT) AS n FROM raw GROUP BY ALL) SELECT r.channel, r.artifact, r.release, t.n AS n_total FROM roster r LEFT JOIN t ON r.channel = t.channel AND r.artifact = t.artifact AND r.release = t.release")
def release_totals(spark, sf):
    return R.fill_totals(_roster(spark, sf), A.raw_counts(spark, sf)).select(*R.KEY, "n_total")


@query(f"WITH {A.RAW} SELECT p_partkey % 4 AS shard, item, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL")
def shard_item_totals(spark, sf):
    """The totals of every shard's items."""
    return A.item_counts(spark, sf).groupBy((F.col("p_partkey") % 4).alias("shard"), "item").agg(F.sum("n").cast("long").alias("n"))


_REPLACED = f"""WITH {A.RAW}, old AS (SELECT channel, artifact, release, day, CAST(sum(n) AS BIGINT) AS n FROM raw WHERE l_orderkey % 2 = 0 GROUP BY ALL),
new AS (SELECT channel, artifact, release, day, CAST(sum(n) AS BIGINT) AS n FROM raw WHERE l_orderkey % 3 = 0 AND channel <> 'old' AND day >= DATE '2000-01-01' GROUP BY ALL),
read AS (SELECT DISTINCT channel, artifact, release, CASE WHEN channel = 'main' THEN DATE '2000-01-01' END AS since FROM raw WHERE channel <> 'old'),
kept AS (SELECT old.* FROM old LEFT JOIN read USING (channel, artifact, release) WHERE channel = 'old' OR old.day < read.since)
SELECT channel, artifact, release, day, n FROM new UNION ALL SELECT channel, artifact, release, day, n FROM kept"""


@query(_REPLACED)
def facts_replaced(spark, sf):
    """Facts of which a later read replaces those of two channels, of one from a day on, of one whole; withdrawn days go."""
    raw = A.raw_counts(spark, sf)
    old = facts_of(raw.where("l_orderkey % 2 = 0"))
    new = facts_of(raw.where((F.col("l_orderkey") % 3 == 0) & (F.col("channel") != "old") & (F.col("day") >= F.lit(SPLIT))))
    read = raw.where("channel <> 'old'").select(*R.KEY, F.when(F.col("channel") == "main", F.lit(SPLIT)).alias("since")).distinct()
    return replace_intervals(old, new, read)


# -- sets of names ----------------------------------------------------------


def _names(spark: SparkSession, sf: str, table: str, column: str) -> DataFrame:
    return A.table(spark, sf, table).select(F.col(column).alias("name"))


_CANDIDATES = """SELECT 'r-cran-' || lower(trim(p_name)) AS name FROM part UNION SELECT 'r-cran-' || lower(trim(s_name)) FROM supplier UNION SELECT 'r-bioc-' || lower(trim(c_name)) FROM customer UNION SELECT 'r-base-extra'"""


@query(_CANDIDATES)
def candidates_union(spark, sf):
    return N.candidates(_names(spark, sf, "part", "p_name"), _names(spark, sf, "supplier", "s_name"), _names(spark, sf, "customer", "c_name"), ("r-base-extra",))


@query(f"SELECT name FROM ({_CANDIDATES}) ORDER BY name LIMIT 25")
def candidates_limited(spark, sf):
    return N.limited(candidates_union(spark, sf), 25)


def _custkeys(spark: SparkSession, sf: str, status: str) -> DataFrame:
    return A.table(spark, sf, "orders").where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("name"))


@query("SELECT o_custkey AS name FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def remaining_except(spark, sf):
    return N.remaining(_custkeys(spark, sf, "O"), _custkeys(spark, sf, "F"))


@query("SELECT o_custkey AS name FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def seen_intersect(spark, sf):
    return N.already(_custkeys(spark, sf, "O"), _custkeys(spark, sf, "F"))


@query("SELECT o_custkey AS name FROM orders WHERE o_orderstatus = 'O' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def done_union(spark, sf):
    return N.united(_custkeys(spark, sf, "O"), _custkeys(spark, sf, "F"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def not_done_anti(spark, sf):
    done = A.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return N.not_done(A.table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey")


@query("SELECT event_type, count(DISTINCT user_id) AS users, CAST(count(*) FILTER (WHERE value > 50) AS BIGINT) AS large FROM events GROUP BY event_type")
def distinct_counts(spark, sf):
    return A.table(spark, sf, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("large"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in _TABLES))
def table_row_counts(spark, sf):
    """Rows of every table; Parquet answers from its footers."""
    counts = [A.table(spark, sf, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("name"), "rows") for t in _TABLES]
    return reduce(DataFrame.unionByName, counts)


# -- pages, names and times -------------------------------------------------


@query("SELECT event_id, 'main' AS channel, 'a' || user_id AS artifact, event_type AS release, CAST(ts AS DATE) AS day, CAST(floor(value) AS BIGINT) AS n FROM events")
def json_page_parse(spark, sf):
    """Every event as a page of one row, written and parsed again."""
    entry = F.struct(F.concat(F.lit("a"), F.col("user_id")).alias("binary_package_name"), F.col("event_type").alias("binary_package_version"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.floor("value").cast("long").alias("count"), F.lit("x").alias("country_link"))
    pages = A.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("channel"), F.to_json(F.struct(F.array(entry).alias("entries"))).alias("text"))
    return P.count_rows(pages).withColumns({"event_id": F.col("channel").cast("long"), "channel": F.lit("main")})


@query("SELECT event_id, json_extract_string(props, '$.k') AS v FROM events")
def json_field(spark, sf):
    return A.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("v"))


@query("SELECT page_id, split_part(url, '/', -1) AS last FROM pages")
def url_last_segment(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", X.last_segment("url").alias("last"))


@query("SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS id FROM pages")
def url_id(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", X.trailing_id("url", "/").alias("id"))


@query("SELECT p_partkey, 'https://api.example.org/' || replace(replace(p_name, ' ', '%20'), '+', '%2B') || '/+binarypub/' || p_partkey || '?ws.op=getDownloadCounts&ws.size=300' AS url FROM part")
def counts_urls(spark, sf):
    return A.table(spark, sf, "part").select("p_partkey", U.counts_url("https://api.example.org", F.col("p_name"), F.col("p_partkey")).alias("url"))


@query("SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages")
def href_extract_all(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", F.explode(P.hrefs(F.col("html"))).alias("href")).distinct()


@query("SELECT name FROM (SELECT unnest(regexp_extract_all('<a href=\"' || lower(p_brand) || p_partkey || '/\">x</a> <a href=\"../\">up</a> <a href=\"f.txt\">f</a>', 'href=\"([^\"/]+)/\"', 1)) AS name FROM part) WHERE name NOT IN ('.', '..')")
def directory_index(spark, sf):
    html = F.concat(F.lit('<a href="'), F.lower("p_brand"), F.col("p_partkey"), F.lit('/">x</a> <a href="../">up</a> <a href="f.txt">f</a>'))
    return P.directory_names(A.table(spark, sf, "part").select(html.alias("html")))


@query("SELECT p_partkey AS id, trim(p_name) AS name FROM part")
def control_text_parse(spark, sf):
    """Stanzas of a control file, one for each part."""
    text = F.concat(F.lit("Package:  "), F.col("p_partkey"), F.lit("="), F.col("p_name"), F.lit(" \nVersion: 1\nDepends: R\n"))
    names = P.control_names(A.table(spark, sf, "part").select(text.alias("text")))
    return names.select(F.substring_index("name", "=", 1).cast("long").alias("id"), F.substring_index("name", "=", -1).alias("name"))


@query("SELECT p_partkey AS id, trim(p_name) AS name, trim(p_brand) || ' ' || trim(p_type) AS depends FROM part")
def stanza_fields(spark, sf):
    """Control stanzas, one for each part, with a field that goes on in a second line."""
    parts = A.table(spark, sf, "part")
    text = F.concat(F.lit("Package:  "), F.col("p_name"), F.lit("\nDepends: "), F.col("p_brand"), F.lit("\n  "), F.col("p_type"), F.lit("\nId: "), F.col("p_partkey"), F.lit("\n\n"))
    rows = stanzas(parts.select(text.alias("text")))
    return rows.select(field("text", "Id").cast("long").alias("id"), field("text", "Package").alias("name"), field("text", "Depends").alias("depends"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, 'v%Y%m%d-%H%M%S') AS tag, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS shown FROM events")
def iso_timestamp(spark, sf):
    iso = X.iso_time("ts")
    return A.table(spark, sf, "events").select("event_id", iso.alias("iso"), X.run_tag("ts").alias("tag"), X.shown_time(iso).alias("shown"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def sha256_text(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT page_id, url_encode(url) AS ref FROM pages")
def url_encode_ref(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", X.encode_ref("url").alias("ref"))


@query("SELECT DISTINCT format('daily-{:04d}.parquet', year(l_shipdate)) AS file FROM lineitem")
def shard_file_names(spark, sf):
    return A.table(spark, sf, "lineitem").select(X.shard_file("daily", F.year("l_shipdate")).alias("file")).distinct()


@query(f"""WITH {A.RAW}, old AS (SELECT year(day) AS year, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM counts WHERE day < DATE '2000-07-01' GROUP BY 1),
new AS (SELECT year(day) AS year, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM counts WHERE day >= DATE '2000-01-01' GROUP BY 1)
SELECT CAST(year AS INTEGER) AS year, rows, CAST(first_day AS VARCHAR) AS first_day, CAST(last_day AS VARCHAR) AS last_day FROM (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (year))""")
def coverage_overlay(spark, sf):
    """The coverage of an earlier part of the counts, with that of a later part over it."""
    counts = A.item_counts(spark, sf)
    old, new = counts.where(F.col("day") < F.lit(datetime.date(2000, 7, 1))), counts.where(F.col("day") >= F.lit(SPLIT))
    merged = merge_coverage(year_coverage(old), year_coverage(new))
    rows = [(int(year), c["rows"], c["first_day"], c["last_day"]) for year, c in merged.items()]
    return spark.createDataFrame(rows, "year int, rows long, first_day string, last_day string")


# -- addresses, listing pages and runs --------------------------------------

_API = "https://api.example.org"


@query(f"SELECT p_partkey, '{_API}/' || replace(replace(p_name, ' ', '%20'), '+', '%2B') || '?ws.op=getPublishedBinaries&ordered=false&ws.size=300&ws.start=0&status=Published' AS url FROM part")
def listing_urls(spark, sf):
    return A.table(spark, sf, "part").select("p_partkey", U.listing_url(_API, F.col("p_name"), status="Published").alias("url"))


@query(f"SELECT p_partkey, '{_API}/main?ws.op=getPublishedBinaries&ordered=false&exact_match=true&ws.size=300&binary_name=' || replace(replace(p_name, ' ', '%20'), '+', '%2B') AS url FROM part")
def name_urls(spark, sf):
    return A.table(spark, sf, "part").select("p_partkey", U.name_url(_API, F.lit("main"), F.col("p_name")).alias("url"))


@query(f"WITH {A.PARTS}, {A.ENTRIES} SELECT channel, source_id, artifact, release, arch, 'Published' AS status, CAST(NULL AS VARCHAR) AS published FROM entries")
def published_page_parse(spark, sf):
    """Every listing entry as a page of one entry, written and parsed again."""
    e = {"self_link": F.concat(F.lit("https://x/+binarypub/"), F.col("source_id")), "binary_package_name": F.col("artifact"), "binary_package_version": F.col("release"), "distro_arch_series_link": F.concat(F.lit("https://x/series/"), F.col("arch")), "status": F.col("status"), "date_published": F.col("published")}
    text = F.to_json(F.struct(F.array(F.struct(*(c.alias(n) for n, c in e.items()))).alias("entries")))
    return P.published_entries(A.entries(spark, sf).select("channel", text.alias("text")))


@query(f"WITH {A.RAW}, {_ITEM_DAYS} SELECT item, day, n, row_number() OVER (ORDER BY item, day) AS place FROM days")
def daily_sorted(spark, sf):
    """The places of daily rows in the order in which they are published: by item and day, as UTF-8 bytes order."""
    return numbered(_item_days(spark, sf), ["item", "day"], "_row").select("item", "day", "n", (F.col("_row") + 1).alias("place"))


@query("SELECT '' AS item, '' AS item_lower, '' AS namespace, '' AS display_name, CAST(0 AS BIGINT) AS total_30d, CAST(0 AS BIGINT) AS total_90d, CAST(0 AS BIGINT) AS total_365d, CAST(0 AS BIGINT) AS rank_30d, CAST(0 AS BIGINT) AS rank_90d, CAST(0 AS BIGINT) AS rank_365d, CAST(0 AS DOUBLE) AS avg_daily_30d, CAST(0 AS DOUBLE) AS trend, DATE '2000-01-01' AS first_day, DATE '2000-01-01' AS last_day, CAST(0 AS BIGINT) AS n_total, '' AS lifecycle WHERE false")
def empty_summary(spark, sf):
    """The typed summary without rows."""
    return empty(spark, SUMMARY)
