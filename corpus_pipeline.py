"""A corpus from raw documents: quality rules, near-duplicates, personal data, mix, token ids.

Every stage takes documents with any further columns and returns them with the same columns (the last one its own). An empty table
gives an empty table. A null text is a text without words, and so is an empty one; a null in another column is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import bytebpe, mixing, pii, quality, simhash
from tidelog.llm.common import new_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules. Those without text or of fewer than 20 words go; repeated rows are judged each, alike."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id, once. Texts without words are one group.

    Different texts of that one doc_id all stay; a group without any doc_id keeps the text of the smallest hash.
    """
    return simhash.one_of_each(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, personal data replaced, n_chars following the text. Null texts stay null; repeated rows are changed alike."""
    return pii.replaced_documents(docs, pii.session_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as its source's budget takes it whole, the last one of a source cut at its budget.

    Each row counts, whatever its doc_id; a null source is a source of its own; documents without words are not in the mix.
    """
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes, a row for each document."""
    return bytebpe.byte_bpe(docs)


STAGES = [
    ("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup), ("pii_surrogates", pii_surrogates),
    ("mix_sources", mix_sources), ("byte_bpe", byte_bpe),
]
#: The fingerprints and token ids have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
