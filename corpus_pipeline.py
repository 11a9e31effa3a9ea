"""Corpus pipeline: toxic documents go, then copies, then near copies; what
stays is mixed to target weights and encoded.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, exact_dedup, mixing, near_dup, toxicity
from plumbline.llm.common import read, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below one half; trained on ``labels``."""
    machine = toxicity.train(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    name = max(docs.columns, key=len) + "_score"  # a new name, whatever the columns
    return toxicity.scores(docs, machine, name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each text."""
    return exact_dedup.kept(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each class of near copies."""
    return near_dup.kept(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix: sources weigh by the root of their size."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as counts and digests, and its place in the
    mix: ``mix_slot`` and ``mix_row``.

    The place depends on doc_id and source alone, so it is that of the mix
    stage. It is worked out for the encoded rows, which hold no text.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    shares = mixing.tempered_shares(docs)
    encoded = saved(byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep=("source",)), "pipeline-byte_bpe")
    placed = mixing.schedule(encoded, shares)
    return placed.drop("source", "mix_block", "mix_release", "mix_deadline")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix),
    ("byte_bpe", encode),
]

# A trained machine and a tokenizer are beyond SQL; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
