"""A training-corpus pipeline over ``documents``: toxicity, line dedup, near-dedup,
benchmark decontamination, BPE encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Defined cases are those of the operators: a NULL text is not toxic, has no
lines and no near duplicate, and encodes to no ids; an empty table gives empty
stages; further columns of ``documents`` go along unread.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arenaflow.llm.common import documents, materialize
from arenaflow.llm.op3_decontamination import decontaminated
from arenaflow.llm.op4_bpe import bpe_digests
from arenaflow.llm.op6_neardup import without_near_duplicates
from arenaflow.llm.op7_toxicity import without_toxic
from arenaflow.llm.op10_lines import without_recurring_lines
from arenaflow.llm.queries import toxicity_model


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return without_toxic(docs, toxicity_model(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; no document goes.  ``n_chars`` follows the text."""
    return without_recurring_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (similarity of 0.8 or more) stays."""
    return without_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text."""
    return bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# The stages train classifiers and merge byte pairs, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
