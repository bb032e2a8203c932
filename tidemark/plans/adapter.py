"""The engine's inputs, derived from the driver's tables: as DataFrames, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import item_token, namespace_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(number, *values):
    out = F.lit(values[-1])
    for i, v in reversed(list(enumerate(values[:-1]))):
        out = F.when(number == i, F.lit(v)).otherwise(out)
    return out


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the artifact that each stands for."""
    token = F.lower(F.replace("p_name", F.lit(" "), F.lit(".")))
    prefix = _choice(F.col("p_partkey") % 4, "r-cran-", "r-bioc-", "r-other-", "lib")
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", token.alias("token"), F.concat(prefix, token).alias("artifact"))


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw count for each line: channel, artifact, release, day, n, and the token."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("day"), F.col("l_quantity").cast("long").alias("n"))
    p = parts(spark, sf_dir).select("p_partkey", "token", "artifact", F.col("p_brand").alias("release"))
    joined = lines.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(_choice(F.col("l_suppkey") % 3, "main", "extra", "old").alias("channel"), "artifact", "release", "day", "n", "token", "l_orderkey", "l_suppkey", "p_partkey")


def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts by token, without regard to namespaces: item, day, n, and what a line was split by."""
    return raw_counts(spark, sf_dir).select(F.col("token").alias("item"), "day", "n", "p_partkey", "l_orderkey")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing entries: every (line's part, supplier) as a release of some architecture."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag")
    p = parts(spark, sf_dir).select("p_partkey", "artifact", F.col("p_brand").alias("release"))
    joined = lines.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        _choice(F.col("l_suppkey") % 3, "main", "extra", "old").alias("channel"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_id"), "artifact", "release",
        F.when(F.col("l_returnflag") == "A", "amd64").when(F.col("l_returnflag") == "R", "arm64").otherwise("i386").alias("arch"), F.lit("Published").alias("status"), F.lit(None).cast("string").alias("published"),
    )


def ledger(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """One name ledger, of the parts of its namespace but every fifth: the first part of a name counts."""
    p = parts(spark, sf_dir).withColumn("ns", namespace_of("artifact")).where((F.col("ns") == which) & (F.col("p_partkey") % 5 != 0)).withColumn("name_lower", item_token("artifact"))
    first = p.groupBy("name_lower").agg(F.min(F.struct("p_partkey", "p_name", "p_size")).alias("f"))
    return first.select("name_lower", F.replace("f.p_name", F.lit(" "), F.lit(".")).alias("display_name"), F.when(F.col("f.p_size") > 25, "live").otherwise("archived").alias("lifecycle"))


# The same relations in SQL, as common table expressions.

PARTS = """parts AS (SELECT p_partkey, p_name, p_brand, p_size, lower(replace(p_name, ' ', '.')) AS token,
  CASE p_partkey % 4 WHEN 0 THEN 'r-cran-' WHEN 1 THEN 'r-bioc-' WHEN 2 THEN 'r-other-' ELSE 'lib' END || lower(replace(p_name, ' ', '.')) AS artifact FROM part)"""

RAW = (
    PARTS
    + """, raw AS (SELECT CASE l_suppkey % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'extra' ELSE 'old' END AS channel, artifact, p_brand AS release,
  CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS n, token, l_orderkey, l_suppkey, p_partkey FROM lineitem JOIN parts ON l_partkey = p_partkey),
counts AS (SELECT token AS item, day, n, p_partkey, l_orderkey FROM raw)"""
)

ROUTED = """routed AS (SELECT artifact, CASE WHEN artifact LIKE 'r-cran-%' THEN 'cran' WHEN artifact LIKE 'r-bioc-%' THEN 'bioc' WHEN artifact LIKE 'r-other-%' THEN 'other' END AS namespace,
  lower(regexp_replace(artifact, '^(r-cran-|r-bioc-|r-other-)', '')) AS item FROM (SELECT DISTINCT artifact FROM raw) WHERE artifact LIKE 'r-cran-%' OR artifact LIKE 'r-bioc-%' OR artifact LIKE 'r-other-%')"""

LEDGERS = """ledgers AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 0 ELSE 1 END AS p, token AS name_lower, replace(p_name, ' ', '.') AS display_name, CASE WHEN p_size > 25 THEN 'live' ELSE 'archived' END AS lifecycle,
  row_number() OVER (PARTITION BY p_partkey % 4, token ORDER BY p_partkey) AS f FROM parts WHERE p_partkey % 4 IN (0, 1) AND p_partkey % 5 <> 0),
ledger AS (SELECT name_lower, display_name, lifecycle FROM (SELECT *, row_number() OVER (PARTITION BY name_lower ORDER BY p) AS pos FROM ledgers WHERE f = 1) WHERE pos = 1)"""

FOUND = """found AS (SELECT artifact, item, namespace, coalesce(display_name, item) AS display_name, lifecycle FROM routed LEFT JOIN ledger ON item = name_lower AND namespace IN ('cran', 'bioc'))"""

IDENTITY = """identity AS (SELECT artifact, item, namespace, display_name, lifecycle FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY CASE namespace WHEN 'cran' THEN 0 WHEN 'bioc' THEN 1 ELSE 2 END, artifact) AS pos FROM found) WHERE pos = 1)"""

RESOLVED = f"{RAW}, {ROUTED}, {LEDGERS}, {FOUND}, {IDENTITY}"

DAILY = """daily AS (SELECT item, day, CAST(sum(n) AS BIGINT) AS n FROM raw JOIN identity USING (artifact) GROUP BY item, day)"""

ENTRIES = """entries AS (SELECT CASE l_suppkey % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'extra' ELSE 'old' END AS channel, l_orderkey * 10 + l_linenumber AS source_id, artifact, p_brand AS release,
  CASE l_returnflag WHEN 'A' THEN 'amd64' WHEN 'R' THEN 'arm64' ELSE 'i386' END AS arch FROM lineitem JOIN parts ON l_partkey = p_partkey)"""

ROSTER = """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel, artifact, release ORDER BY CASE WHEN arch = 'amd64' THEN 0 ELSE 1 END, source_id, arch) AS pos FROM entries) WHERE pos = 1),
roster AS (SELECT channel, artifact, release, source_id, item, namespace, display_name, lifecycle FROM best JOIN identity USING (artifact))"""
