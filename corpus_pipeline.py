"""The corpus pipeline: documents in, tokens of the documents kept out.

Each stage treats odd rows as its operator states: a document with a null or empty text has too few words for the quality rules and goes there;
rows repeated under one id stay or go together in the near-duplicate stage; documents of any length are worked on whole. Columns besides those
the stages name pass through to the last one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelweave.llm import prefixjoin, raking, ranks, repetition, skipchain
from panelweave.llm.queries import KEEP, MIX, SWEEPS, TOLERANCE, vocabulary_path
from panelweave.workspace import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return repetition.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return prefixjoin.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return skipchain.mask(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of source, language and topic."""
    return raking.draw(docs, MIX, SWEEPS, keep=KEEP, tolerance=TOLERANCE)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    return ranks.encode(docs, ranks.read_vocabulary(vocabulary_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: No SQL tells the belief propagation of the third stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
