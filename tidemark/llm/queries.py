"""The registered queries of this folder: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import adaptive_quality, bpe_tree, dac_codes, flat_graph, hilbert_shards, ngram_join, packing, pii_crf, pu_toxicity, secret_ledger, soft_mixing, turns, whitening
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(table(spark, sf_dir, "documents"), 80)


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shards(table(spark, sf_dir, "documents"), 40)


def op3_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_quality.judge(table(spark, sf_dir, "documents"))


def op4_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op5_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_toxicity.score_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Shares of tokens by domain.
TARGETS = {"clean": 0.94, "junk": 0.03, "toxic": 0.03}


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = soft_mixing.label_domains(table(spark, sf_dir, "labels"))
    return soft_mixing.mix(table(spark, sf_dir, "documents"), labelled, TARGETS, keep="clean")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.secret_table(table(spark, sf_dir, "documents"))


def op8_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac_codes.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_table(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op10_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.pii_table(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), top=4)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turns.digests(turns.damage(conversations), conversations)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_ngram_jaccard, op2_hilbert_shards, op3_adaptive_quality, op4_flat_graph, op5_pu_toxicity, op6_soft_mixing, op7_secret_ledger, op8_dac_tokens, op9_tree_bpe, op10_pii_crf, op11_packing, op12_whitening, op13_turn_repair)}

ORACLE_SQL: dict[str, str] = {}
