"""The training-data pipeline: documents in, encoded token blocks out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from haulframe.llm import decontaminate, minhash, mixing, token_files, toxicity
from haulframe.llm.landed import landed
from haulframe.llm.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is scored toxic go."""
    return toxicity.acceptable(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; five-word shingles."""
    return minhash.one_of_each(docs, size=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quote a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights; some come more than once, some not at all."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", near_dedup),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token files", encode),
]

ORACLE_SQL = None  # SQL has no trained scores, sampled hashes, edit matching or tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
