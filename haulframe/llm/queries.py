"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from haulframe.llm import cover_tree, decontaminate, filter_audit, html_slots, minhash, mixing, passages, piece_table, pii, token_files, toxicity, url_templates, vector_codes
from haulframe.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


#: The given rules of the url filter.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query("op1_mix_sources", mixing.drawn_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.drawn(table(spark, sf_dir, "documents"))
    return drawn.select("row.doc_id", "domain", "lang", "source", "n_tokens", "epochs", "take")


@query("op2_repeated_passages")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op3_url_filter", url_templates.judged_sql(URL_RULES))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(table(spark, sf_dir, "pages"), URL_RULES)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


@query("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_decontaminate")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.quoted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_embedding_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query("op9_main_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_slots.main_texts(table(spark, sf_dir, "pages"))


@query("op10_minhash_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_vector_codes", vector_codes.coded_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


@query("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_filter_audit", filter_audit.audit_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
