"""Queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import centroids, conversation_repair, exact_dedup, host_rules, html_text, mixing, multiset_hash, packing, piece_bpe, secrets, simhash, toxicity, url_filter
from cohortlens.llm.common import table


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents")).drop("host_rate")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(table(spark, sf_dir, "documents"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.compare(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def queries() -> dict:
    return {"op1_secrets": op1_secrets, "op2_toxicity": op2_toxicity, "op10_packing": op10_packing,
            "op3_html_text": op3_html_text, "op6_mixing": op6_mixing, "op9_url_filter": op9_url_filter,
            "op4_host_rules": op4_host_rules, "op5_exact_dedup": op5_exact_dedup, "op7_simhash": op7_simhash,
            "op8_piece_bpe": op8_piece_bpe, "op11_centroids": op11_centroids, "op12_multiset_hash": op12_multiset_hash,
            "op13_conversation_repair": op13_conversation_repair}


def oracle_sql() -> dict[str, str]:
    return {"op4_host_rules": host_rules.SQL, "op5_exact_dedup": exact_dedup.SQL, "op11_centroids": centroids.SQL}
