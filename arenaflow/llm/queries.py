"""One query per operator, over the whole tables it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arenaflow.llm.common import documents, fold
from arenaflow.llm.op1_quality import quality_rules
from arenaflow.llm.op2_tokens import token_counts
from arenaflow.llm.op3_decontamination import contaminated
from arenaflow.llm.op4_bpe import bpe_digests
from arenaflow.llm.op5_licenses import license_scan
from arenaflow.llm.op6_neardup import near_duplicates
from arenaflow.llm.op7_toxicity import ToxicityModel, score_toxicity, train_toxicity
from arenaflow.llm.op8_language import identify_language
from arenaflow.llm.op9_secrets import secret_scan
from arenaflow.llm.op10_lines import line_dedup
from arenaflow.llm.op11_alignment import token_alignment
from arenaflow.llm.op12_boosted_quality import score_quality, train_quality
from arenaflow.llm.op13_phrases import collocations
from arenaflow.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "toxicity_model"]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def toxicity_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Learned from the documents and labels whose fold of five is not 0."""
    return train_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), fold(5) != 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(documents(spark, sf_dir), fold(4) != 2)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold(3) != 1)
    return score_quality(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_tokens": op2_tokens,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_licenses": op5_licenses,
    "op6_neardup": op6_neardup,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_secrets": op9_secrets,
    "op10_lines": op10_lines,
    "op11_alignment": op11_alignment,
    "op12_boosted_quality": op12_boosted_quality,
    "op13_phrases": op13_phrases,
}
