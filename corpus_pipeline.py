"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, encoding.

Every stage reads what its predecessor wrote and returns the columns of
documents, but for the last, which returns the encoded corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelflow.llm import bpe, decontaminate, lines, simhash, toxicity
from panelflow.llm.common import table
from panelflow.session import staging_path


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that match an earlier one."""
    return lines.drop_later_matches(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids, each row decoded again and digested."""
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", toxic_filter),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

ORACLE_SQL = None   # byte-level BPE cannot be written in SQL; tests/llm checks every stage by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
