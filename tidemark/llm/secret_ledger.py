"""Secret scans over a content-addressed ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. A scan
looks only at (blob, rule version) pairs that the ledger does not hold yet,
appends what it finds, also that it found nothing, and findings go back to all
paths by a join on the blob. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, free_name, new_path


@dataclass(frozen=True)
class Rule:
    """A pattern (Java syntax); the text of ``group`` must have ``least`` characters."""

    kind: str
    version: str
    pattern: str
    group: int
    least: int

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the contract.
RULES = (
    Rule("assign", "1", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "1", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "1", r"[0-9a-f]+", 0, 24),
)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())])
LEDGER = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rule", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of a rule in code points: the text between matches and the matches, added up in turn."""
    pattern = rule.pattern
    if rule.kind == "hex":  # runs are maximal, so shorter ones can be passed over by the pattern itself
        pattern = rf"[0-9a-f]{{{rule.least},}}"
    between, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.zip_with(F.transform(between, F.length), F.zip_with(F.transform(whole, F.length), F.transform(value, F.length), lambda n, v: F.struct(n.alias("n"), v.alias("v"))), lambda gap, m: F.struct(F.coalesce(gap, F.lit(0)).alias("gap"), m["n"].alias("n"), m["v"].alias("v")))
    empty = F.array().cast(T.ArrayType(SPAN))
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + step["gap"]
        end = begin + F.coalesce(step["n"], F.lit(0))
        span = F.struct(begin.cast("long").alias("start"), F.lit(number).alias("kind"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"), F.when(step["v"] >= rule.least, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    found = F.aggregate(steps, start, add, lambda s: s["out"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            return None
        raise


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger has not seen of ``versions`` (a column ``text``; null is empty), and append it.

    Returns the number of (blob, rule version) pairs that were new. Equal texts
    are one blob, gathered before they are shuffled, so copies cost one scan.
    """
    spark = versions.sparkSession
    blobs = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", blob_id(F.col("text"))).groupBy("blob").agg(F.first("text").alias("text"))
    every = F.array(*(F.lit(r.id) for r in rules))
    known = _ledger(spark, ledger_path)
    if known is None:
        todo = blobs.withColumn("rules", every)
    else:
        seen = known.where(F.col("rule").isin([r.id for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("rules", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("rules") > 0)
    text = F.col("text")
    checked = [F.when(F.array_contains("rules", r.id), F.struct(F.lit(r.id).alias("rule"), _spans(text, r, i).alias("spans"))) for i, r in enumerate(rules)]
    fresh = todo.select("blob", F.explode(F.array(*checked)).alias("r")).where(F.col("r").isNotNull()).select("blob", "r.rule", "r.spans")
    path = new_path(spark, "secret-scan")
    fresh.write.parquet(path)  # the findings are made once, and appended as a whole
    fresh = spark.read.schema(LEDGER).parquet(path)
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(ledger_path)
    return n


def findings(spark: SparkSession, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans under these rule versions, by start, then rule; blobs without any are absent."""
    known = spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("rule").isin([r.id for r in rules]) & (F.size("spans") > 0))
    # Two writers may have scanned one blob at the same time: one row for each rule.
    once = known.groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
    return cut(once.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "secret-findings")


def joined(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def secret_table(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, a count for each rule, base_sha256 and spans of every row of ``docs``.

    Repeated rows and equal texts have equal findings; null and empty texts
    have none; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ledger_path = ledger_path or new_path(spark, "secret-ledger")
    scan(docs, ledger_path, rules)
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_id(F.col("text")).alias("blob"))
    if _ledger(spark, ledger_path) is None:
        found = spark.createDataFrame([], T.StructType([LEDGER["blob"], LEDGER["spans"]]))
    else:
        found = findings(spark, ledger_path, rules)
    spans = F.coalesce("spans", F.array().cast(T.ArrayType(SPAN)))
    rows = paths.join(found, "blob", "left").withColumn("spans", spans)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(rules)]
    text = joined(F.col("spans"), rules)
    return rows.select("doc_id", *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def redact(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans become one.

    Columns stay as they are; n_chars, if there, follows the new text.
    """
    spark = docs.sparkSession
    ledger_path = ledger_path or new_path(spark, "secret-ledger")
    scan(docs, ledger_path, rules)
    if _ledger(spark, ledger_path) is None:
        return docs
    blob, spans, new = (free_name(docs, f"_secret_{n}") for n in ("blob", "spans", "text"))
    found = findings(spark, ledger_path, rules).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    rows = docs.withColumn(blob, blob_id(F.col("text"))).join(found, blob, "left")
    text = F.col("text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def put(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"))

    masked = F.aggregate(spans, start, put, lambda st: F.concat(st["out"], F.substring(text, (st["at"] + 1).cast("int"), F.length(text))))
    clean = F.col(spans).isNull()
    rows = rows.withColumn(new, F.when(clean, text).otherwise(masked))
    changed = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(clean, F.col("n_chars")).otherwise(F.length(new).cast("long"))
    return rows.withColumns(changed).select(*docs.columns)


def history_findings(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, version, blob (hex), kind, start and end of every secret in every version of every path.

    ``versions`` has path, version and text. The ledger stays between calls, so a
    call scans the blobs that no earlier one has seen, and those that a changed
    rule has not; what is known goes back to all paths that ever had the blob. A
    null text is empty; equal rows have their findings once.
    """
    spark = versions.sparkSession
    scan(versions, ledger_path, rules)
    ids = versions.select("path", "version", blob_id(F.col("text")).alias("blob")).distinct()
    if _ledger(spark, ledger_path) is None:
        found = spark.createDataFrame([], T.StructType([LEDGER["blob"], LEDGER["spans"]]))
    else:
        found = findings(spark, ledger_path, rules)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    rows = ids.join(found, "blob").select("path", "version", F.lower(F.hex("blob")).alias("blob"), F.explode("spans").alias("s"))
    return rows.select("path", "version", "blob", F.element_at(kinds, F.col("s.kind") + 1).alias("kind"), "s.start", "s.end")
