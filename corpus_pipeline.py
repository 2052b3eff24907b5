"""From raw documents to token records, in five stages.

Every stage is a function of a session, the documents its predecessor kept and the folder
of the other tables. Each result is stored as Parquet and read again by the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfrank.llm import decontamination, mixing, near_dedup, quality
from shelfrank.llm.queries import bounded_batches, table, token_digests
from shelfrank.llm.spark_io import delete, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; null and empty texts are judged as empty ones."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted_documents(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, that with the smallest id.

    Of copies without an id one stays; rows that repeat an id count as one document.
    """
    bounded_batches(spark)
    return near_dedup.distinct_documents(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; every row is judged by its own text."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it takes them."""
    return mixing.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, digested from what the files hold."""
    bounded_batches(spark)
    return token_digests(spark, docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("decontamination", keep_clean),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

# Trees, weighted draws and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = written(stage(spark, docs, sf_dir), name)
        if number:
            delete(spark, docs)
        docs = result
    return docs
