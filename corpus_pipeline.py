"""Corpus pipeline over ``documents``: quality rules, exact de-duplication,
SimHash near-duplicates, mixing to target weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame: the first four the columns of ``documents``,
the last one row of ids per document of the mix. ``STAGES`` can be run with a
written table between the stages; ``run`` applies them in one go, each result
written to the checkpoint folder so that the next stage doesn't repeat it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import exact_dedup, host_rules, mixing, piece_bpe, simhash
from cohortlens.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the rules nor their host's verdict reject."""
    return host_rules.filter_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    return piece_bpe.encode_documents(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies),
          ("mixing", mix_sources), ("SentencePiece", encode)]

#: The fingerprints (XXH64), the solver and the encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
