"""The corpus pipeline: toxicity, near duplicates, personal data, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read as the next one's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bourse.llm import bpe, mixing, order_minhash, pii, toxicity
from bourse.llm.common import stage, table, unstage
from bourse.llm.queries import MIX_ALPHA, MIX_SEED, MIX_WEIGHTS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled
    rows among the corpus's documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the least id."""
    return order_minhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the sources' target shares, shuffled."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_ALPHA, 1.0, MIX_SEED).select("row.*")


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, and the digest of what they decode to."""
    return bpe.bpe_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_and_decode),
]

#: SQL expresses neither the classifier nor the tokenizer: the stages are
#: tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage
    read goes when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        done = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        unstage(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
