"""Mixing documents to target weights by soft domain membership.

A naive Bayes model over hashed words, trained from a labelled table, gives
every document a posterior for each domain. Document rates r >= 0 are then
fitted by projected-gradient least squares, so that the expected tokens of
each domain, sum of r * tokens * posterior, match their targets. A step needs
only sums over the documents; they are made by Spark, and the direction is
scaled by the inverse of the domains' small Gram matrix. DataFrame functions
only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name, sized

#: Hash buckets of words, and words added to each bucket of each domain.
BUCKETS, SMOOTHING = 1 << 16, 2.0
#: Rounds of the fit at most, and the relative error that ends it.
ROUNDS, ERROR = 30, 1e-7

_WORDS = r"[\x20\x09-\x0D]+"


def _bucketed(docs: DataFrame, *keep: str) -> DataFrame:
    """The bucket of every word; a text without words has one row without a bucket. ``first`` marks one row of each text."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), _WORDS), lambda w: w != "")
    rows = docs.select(*keep, F.posexplode_outer(words).alias("place", "word"))
    return rows.select(*keep, F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")).alias("bucket"), (F.coalesce("place", F.lit(0)) == 0).alias("first"))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[DataFrame, list[float]]:
    """Log-likelihoods by bucket (at most ``BUCKETS`` rows) and the log-priors.

    ``labelled`` has doc_id and domain; other domains and null ids teach
    nothing, and of several labels of one document the least counts.
    """
    known = cut(labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain")), "mix-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sized(known), "doc_id")
    is_of = [F.when(F.col("domain") == d, 1).otherwise(0) for d in domains]
    counts = cut(_bucketed(rows, "domain").where("bucket is not null").groupBy("bucket").agg(*(F.sum(c).alias(f"c{i}") for i, c in enumerate(is_of))), "mix-counts")
    totals = counts.agg(*(F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(domains)))).first()
    sizes = known.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(f"c{i}") for i, c in enumerate(is_of))).first()
    everything = sum(sizes) + len(domains)
    logs = [F.log((F.col(f"c{i}") + SMOOTHING) / (totals[i] + SMOOTHING * BUCKETS)).alias(f"l{i}") for i in range(len(domains))]
    unseen = [math.log(SMOOTHING / (totals[i] + SMOOTHING * BUCKETS)) for i in range(len(domains))]
    # Relative to an unseen word, so that words without a row add nothing but the same for all.
    weights = counts.select("bucket", *((log - u).alias(f"l{i}") for i, (log, u) in enumerate(zip(logs, unseen))), *(F.lit(u).alias(f"u{i}") for i, u in enumerate(unseen)))
    return cut(weights, "mix-weights"), [math.log((n + 1) / everything) for n in sizes]


def posteriors(docs: DataFrame, weights: DataFrame, priors: list[float]) -> DataFrame:
    """doc_id, text_hash, n_tokens (words of all its rows), n_rows and a posterior p0, p1, ... for each domain.

    Evidence is damped by the root of the number of words. One row for each
    distinct (doc_id, text); its rows count for its tokens, and once as
    evidence. A text without words has the priors.
    """
    k = len(priors)
    unseen = [F.first(F.col(f"u{i}"), ignorenulls=True) for i in range(k)]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    words = _bucketed(keyed, "doc_id", "text_hash").join(F.broadcast(weights.drop(*(f"u{i}" for i in range(k)))), "bucket", "left")
    sums = words.groupBy("doc_id", "text_hash").agg(F.count_if("first").alias("n_rows"), F.count("bucket").alias("all"), *(F.coalesce(F.sum(f"l{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)))
    sums = sums.select("doc_id", "text_hash", "n_rows", "all", (F.col("all") / F.col("n_rows")).cast("long").alias("n"), *((F.col(f"s{i}") / F.col("n_rows")).alias(f"s{i}") for i in range(k)))
    base = weights.agg(*(u.alias(f"b{i}") for i, u in enumerate(unseen))).first()
    base = [b or 0.0 for b in base]
    damp = F.sqrt(F.greatest("n", F.lit(1)))
    score = [F.lit(priors[i]) + (F.col(f"s{i}") + F.col("n") * base[i]) / damp for i in range(k)]
    rows = sums.select("doc_id", "text_hash", F.col("all").alias("n_tokens"), "n_rows", *(s.alias(f"z{i}") for i, s in enumerate(score)))
    top = F.greatest(*(F.col(f"z{i}") for i in range(k))) if k > 1 else F.col("z0")
    rows = rows.select("doc_id", "text_hash", "n_tokens", "n_rows", *(F.exp(F.col(f"z{i}") - top).alias(f"e{i}") for i in range(k)))
    total = reduce(Column.__add__, (F.col(f"e{i}") for i in range(k)))
    return rows.select("doc_id", "text_hash", "n_tokens", "n_rows", *((F.col(f"e{i}") / total).alias(f"p{i}") for i in range(k)))


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """A small symmetric system by elimination; directions without weight stay put."""
    n = len(right)
    ridge = 1e-9 * (sum(matrix[i][i] for i in range(n)) or 1.0)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        rows[i][i] += ridge
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        if abs(rows[i][i]) < 1e-300:
            continue
        for r in range(n):
            if r != i:
                f = rows[r][i] / rows[i][i]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[i])]
    return [rows[i][n] / rows[i][i] if abs(rows[i][i]) >= 1e-300 else 0.0 for i in range(n)]


def fit_rates(members: DataFrame, shares: list[float], keep: int | None = None, slack: float = 1.02) -> tuple[Column, list[float], list[float]]:
    """The rate of a row of ``members`` (written), and the domains' totals at these rates and targets.

    Totals of all tokens stay what they are, or with ``keep`` grow or shrink so
    that the kept domain's target is ``slack`` times what it has.
    """
    k = len(shares)
    p = [F.col(f"p{i}") for i in range(k)]
    tokens = F.col("n_tokens").cast("double")
    now = list(members.agg(*(F.coalesce(F.sum(tokens * q), F.lit(0.0)).alias(f"t{i}") for i, q in enumerate(p))).first())
    whole = sum(now) if keep is None or shares[keep] <= 0 else slack * now[keep] / shares[keep]
    target = [whole * s / sum(shares) for s in shares]
    rate, totals = F.lit(1.0), now
    for left in range(ROUNDS, -1, -1):
        live = F.when(rate > 0, tokens).otherwise(0.0)
        sums = members.withColumn("r", rate).agg(
            *(F.coalesce(F.sum(F.col("r") * tokens * q), F.lit(0.0)).alias(f"t{i}") for i, q in enumerate(p)),
            *(F.coalesce(F.sum(live * p[i] * p[j]), F.lit(0.0)).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)),
        ).first()
        totals = [sums[f"t{i}"] for i in range(k)]
        if left == 0 or max(abs(a - b) for a, b in zip(totals, target)) <= ERROR * max(whole, 1.0):
            break
        gram = [[sums[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]
        step = _solve(gram, [a - b for a, b in zip(totals, target)])
        move = reduce(Column.__add__, (q * F.lit(s) for q, s in zip(p, step)))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate, totals, target


def copies(rate: Column, *key: Column) -> Column:
    """A whole number of copies whose expectation is the rate, decided by a hash of the key."""
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + chance).cast("long")


class TargetsMissed(ValueError):
    """No rates give the domains their targets."""


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], keep: str | None = None, tolerance: float | None = None) -> DataFrame:
    """Rates of all documents: doc_id, text_hash, n_tokens, n_rows, p_<domain>, rate, copies and missed.

    ``targets`` are shares by domain. ``missed`` (one value) is the largest
    difference of a domain's expected tokens from its target, as a share of all
    tokens; more than ``tolerance`` is an error, if one is given. One row for each distinct (doc_id, text);
    null or empty texts have no tokens and the priors as posteriors; without
    labelled rows posteriors are equal; an empty table gives no rows.
    """
    domains = list(targets)
    weights, priors = train(docs, labelled, domains)
    members = cut(posteriors(docs, weights, priors), "mix-members")
    rate, totals, wanted = fit_rates(members, list(targets.values()), domains.index(keep) if keep else None)
    missed = max(abs(a - b) for a, b in zip(totals, wanted)) / max(sum(wanted), 1.0)
    if tolerance is not None and missed > tolerance:
        raise TargetsMissed(f"expected tokens {dict(zip(domains, totals))} for targets {dict(zip(domains, wanted))}")
    named = [F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)]
    out = members.withColumn("rate", rate)
    return out.select("doc_id", "text_hash", "n_tokens", "n_rows", *named, "rate", copies(F.col("rate"), F.col("doc_id"), F.col("text_hash")).alias("copies"), F.lit(missed).alias("missed"))


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain: junk (low quality), toxic, or clean; rows with a null label are left out."""
    domain = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").otherwise("clean")
    return labels.where(F.col("quality").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", domain.alias("domain"))


def resample(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with every row as often as ``rates`` says; columns stay as they are."""
    key, text_hash, own, own_hash, times, turn = (free_name(docs, f"_mix_{n}") for n in ("id", "hash", "own", "own_hash", "copies", "turn"))
    keys = rates.groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash)).agg(F.max("copies").alias(times))
    rows = docs.withColumns({own: F.col("doc_id").cast("long"), own_hash: F.xxhash64("text")})
    rows = rows.join(keys, F.col(own).eqNullSafe(F.col(key)) & (F.col(own_hash) == F.col(text_hash)))
    return rows.where(F.col(times) > 0).withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
