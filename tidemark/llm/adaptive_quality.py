"""Quality rules with thresholds that follow each language and source.

Every document gets a handful of measures. For each (lang, source) group a
mergeable quantile sketch of every measure is kept over the documents that pass
the base rule; sketches of groups are merged into those of their language, and
these into one of the whole table. Junk shows as a cluster that a wide gap in
the upper quantiles parts from the bulk: the threshold lies in the widest gap,
or beyond the last quantile where no gap is wide. Gaps are measured in odds (what
is counted over what is not), so that a threshold never passes the whole of a
text. A group's threshold is drawn
towards its language's by its number of documents, and may exceed it only as
far as the group's median does, so a group full of junk cannot switch a rule
off; a language's follows the table's likewise. The thresholds reach the
documents by a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_columns

#: The symbols of the contract, and ASCII white space.
SYMBOLS, BLANKS, CAPITALS = b"#*$%&|<>", (" ", "\t", "\n", "\x0b", "\x0c", "\r"), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ!"

#: Measures: what is counted, in what, and how much a single event counts (a repeated window is six words at least;
#: repeated lines count by their words, as texts have few lines).
MEASURES = {"symbols": ("n_symbols", "word_chars", 1), "repeats": ("n_repeat_words", "n_words", 6), "shouting": ("n_capitals", "word_chars", 1), "dup_lines": ("n_dup_words", "n_words", 6)}
#: Ranks between which gaps are looked for.
RANKS = (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.925, 0.95, 0.97, 0.98, 0.99, 0.995)
#: A gap is wide if the odds, with one event in a text of median size added to both sides, grow this many times over it.
WIDE = 4.0
#: Documents at which a group's own threshold and its parent's weigh alike.
ALIKE = 50
#: Size parameter of the sketches.
SKETCH_K = 400


def measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, n_dup_words of a text (null: empty)."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes split at exactly \x20 and \x09-\x0D
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(data) - len(data.translate(None, CAPITALS)),
        duplicate_words(lines),
    )


def duplicate_words(lines: list[bytes]) -> int:
    """Words of the lines that equal an earlier line."""
    seen: set[bytes] = set()
    return sum(len(x.split()) for x in lines if x in seen or seen.add(x))


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    n = len(number)
    if n < 1 << 20:
        codes = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        _, pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
        codes = pairs * n + ids[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0
    marked = np.zeros(len(words), dtype=bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for i in range(3):
        marked[starts + i] = True
    return int(marked.sum())


def measure_table(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_dup_words"]
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *((n, pa.int64()) for n in names)])

    def rows(keys: list, langs: list, sources: list, texts: list) -> list:
        counts = list(zip(*map(measures, texts))) or [()] * 7
        return [keys, langs, sources, *counts]

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")
    return map_columns(narrow, narrow.columns, schema, "doc_id long, lang string, source string, " + ", ".join(f"{n} long" for n in names), rows)


def _ratio(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def _with_ratios(counted: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *(_ratio(top, bottom).alias(m) for m, (top, bottom, _) in MEASURES.items()))


def _limit(m: str, own: str, parent: Column | None) -> Column:
    """Threshold of measure ``m`` from the sketches in columns that begin with ``own``."""
    _, size, event = MEASURES[m]
    raised = event / F.greatest(F.kll_sketch_get_quantile_bigint(F.col(f"{own}{size}"), F.lit(0.5)), F.lit(1))
    odds = lambda v: (v + raised) / (1 - v + raised)
    values = F.transform(F.kll_sketch_get_quantile_double(F.col(f"{own}{m}"), F.array(*map(F.lit, RANKS))), odds)
    gaps = F.zip_with(F.slice(values, 1, len(RANKS) - 1), F.slice(values, 2, len(RANKS) - 1), lambda low, high: F.struct((high / low).alias("wide"), F.sqrt(low * high).alias("middle")))
    widest = F.array_max(gaps)
    free = F.when(widest["wide"] >= WIDE, widest["middle"]).otherwise(F.element_at(values, -1) * WIDE)
    if parent is not None:
        n, above = F.col(f"{own}n"), odds(parent)
        drawn = F.exp((n * F.log(free) + ALIKE * F.log(above)) / (n + ALIKE))
        free = F.least(drawn, F.greatest(above, F.element_at(values, 1) * WIDE))
    # Back from odds, and below a text of median size that is all but one event.
    return F.least((free * (1 + raised) - raised) / (1 + free), 1 / (1 + raised))


def thresholds(measured: DataFrame) -> DataFrame:
    """One row for each (lang, source) with documents that pass the base rule: the threshold of every measure."""
    sizes = sorted({size for _, size, _ in MEASURES.values()})
    sketched = [F.count(F.lit(1)).alias("own_n"), *(F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(f"own_{m}") for m in MEASURES), *(F.kll_sketch_agg_bigint(c, F.lit(SKETCH_K)).alias(f"own_{c}") for c in sizes)]
    groups = cut(measured.where(~F.col("base_failed")).groupBy("lang", "source").agg(*sketched), "quality-sketches")

    def merged(name: str) -> list[Column]:
        return [F.sum("own_n").alias(f"{name}_n"), *(F.kll_merge_agg_double(f"own_{m}").alias(f"{name}_{m}") for m in MEASURES), *(F.kll_merge_agg_bigint(f"own_{c}").alias(f"{name}_{c}") for c in sizes)]

    # One row, or none where no document passes.
    whole = groups.agg(*merged("all")).where("all_n > 0").select(*(_limit(m, "all_", None).alias(m) for m in MEASURES)).first()
    above = {m: F.lit(whole[m] if whole else None).cast("double") for m in MEASURES}
    langs = groups.groupBy(F.col("lang").alias("_lang")).agg(*merged("lang")).select("_lang", *(_limit(m, "lang_", above[m]).alias(f"lang_max_{m}") for m in MEASURES))
    joined = groups.join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    return joined.select("lang", "source", *(_limit(m, "own_", F.col(f"lang_max_{m}")).alias(f"max_{m}") for m in MEASURES))


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed and kept. Null texts count as empty and fail;
    null lang or source is a group like any other; repeated rows are judged
    each; an empty table gives no rows. Thresholds of groups over ``SKETCH_K``
    rows are quantiles within the sketch's rank error (about 1 %).
    """
    measured = _with_ratios(cut(measure_table(docs), "quality-measures"))
    limits = cut(thresholds(measured), "quality-limits")
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *(f"max_{m}" for m in MEASURES))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    within = F.lit(True)
    for m in MEASURES:
        within = within & (F.col(m) <= F.col(f"max_{m}"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(True))
    return measured.join(limits, same, "left").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
