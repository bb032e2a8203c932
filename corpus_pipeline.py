"""From raw documents to encoded text, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and is written as Parquet and read again before the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_tree, ngram_join, pu_toxicity, secret_ledger, soft_mixing
from tidemark.llm.common import cut, free_name, sized, table

#: Shares of tokens by domain; toxic documents have gone by then.
TARGETS = {"clean": 0.97, "junk": 0.03}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model calls toxic go; null and empty texts are scored like texts without words."""
    score = pu_toxicity.scorer(docs, table(spark, sf_dir, "labels"))
    return docs.where(score("text") < pu_toxicity.CUTOFF)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that of the smallest doc_id.

    Repeated rows are one; different texts of one doc_id are one document and
    stay together. Rows without an id, and texts without words, all stay.
    """
    joined = ngram_join.similarity_join(docs, 80)
    key = free_name(docs, "gone")
    gone = cut(joined.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "pipeline-gone")
    kept = docs.join(sized(gone), F.col("doc_id") == F.col(key), "left_anti")
    if not _repeated(joined):
        return kept
    named = kept.where("doc_id is not null")
    return kept.where("doc_id is null").unionByName(named.dropDuplicates(["doc_id", "text"]))


def _repeated(joined: DataFrame) -> bool:
    """Whether some doc_id has several rows."""
    return not joined.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes, and a null text stays null."""
    return secret_ledger.redact(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that domains have their target shares. Clean text as a whole is not thinned: its expected tokens stay, though a text that is partly like junk may go."""
    labelled = soft_mixing.label_domains(table(spark, sf_dir, "labels"))
    rates = soft_mixing.mix(docs, labelled, TARGETS, keep="clean")
    return soft_mixing.resample(docs, rates)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of them and of their bytes that a reader can check."""
    return bpe_tree.encode_table(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("mixing", mix_domains),
    ("byte_bpe", encode),
]

#: The first stage is a trained model, so there is no SQL for the whole.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{name}")
    return docs
