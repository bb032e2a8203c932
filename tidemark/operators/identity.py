"""Identity: which item an artifact's name stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FLOORS, Floors
from tidemark.functions.text import item_token, namespace_of, preference
from tidemark.schemas import LEDGER, empty


class LedgerGate(RuntimeError):
    """A ledger is too small to be trusted."""


def merge_ledgers(cran: DataFrame, bioc: DataFrame) -> DataFrame:
    """One row for each name of two ledgers; the first ledger wins."""
    both = cran.select("name_lower", "display_name", "lifecycle", F.lit(0).alias("_p")).unionByName(bioc.select("name_lower", "display_name", "lifecycle", F.lit(1).alias("_p")))
    first = both.groupBy("name_lower").agg(F.min(F.struct("_p", "display_name", "lifecycle")).alias("first"))
    return first.select("name_lower", "first.display_name", "first.lifecycle")


def ledger_sizes(cran: DataFrame, bioc: DataFrame, floors: Floors = FLOORS) -> DataFrame:
    """Names of each ledger, and whether they reach its floor."""
    rows = [df.agg(F.count(F.lit(1)).alias("names")).select(F.lit(name).alias("ledger"), "names", (F.col("names") >= floor).alias("enough")) for name, df, floor in (("cran", cran, floors.cran), ("bioc", bioc, floors.bioc))]
    return rows[0].unionByName(rows[1])


def gated_ledger(cran: DataFrame, bioc: DataFrame, floors: Floors = FLOORS) -> DataFrame:
    """The merged ledger, if both are large enough; else an error."""
    small = [r["ledger"] for r in ledger_sizes(cran, bioc, floors).collect() if not r["enough"]]
    if small:
        raise LedgerGate(f"too few names in: {', '.join(small)}")
    return merge_ledgers(cran, bioc)


def empty_ledger(spark: SparkSession) -> DataFrame:
    """The ledger of a run that goes on without one."""
    return empty(spark, LEDGER)


def route(artifacts: DataFrame) -> DataFrame:
    """Distinct artifacts of a known namespace, with namespace and token."""
    return artifacts.select("artifact").distinct().withColumn("namespace", namespace_of("artifact")).where("namespace is not null").withColumn("item", item_token("artifact"))


def look_up(routed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Display name (the token where none is known) and lifecycle, for the namespaces that ledgers cover."""
    names = ledger.select(F.col("name_lower").alias("_name"), F.col("display_name").alias("_display"), F.col("lifecycle").alias("_lifecycle"))
    hit = (F.col("item") == F.col("_name")) & F.col("namespace").isin("cran", "bioc")
    return routed.join(names, hit, "left").select("artifact", "item", "namespace", F.coalesce("_display", "item").alias("display_name"), F.col("_lifecycle").alias("lifecycle"))


def prefer(found: DataFrame) -> DataFrame:
    """One artifact for each item: that of the preferred namespace, then the first by name."""
    rest = [c for c in found.columns if c != "item"]
    best = found.groupBy("item").agg(F.min_by(F.struct(*rest), F.struct(preference("namespace").alias("rank"), "artifact")).alias("best"))
    return best.select(*(F.col(c) if c == "item" else F.col("best")[c].alias(c) for c in found.columns))


def resolve(artifacts: DataFrame, ledger: DataFrame) -> DataFrame:
    """The identity of every artifact that has one."""
    return prefer(look_up(route(artifacts), ledger))
