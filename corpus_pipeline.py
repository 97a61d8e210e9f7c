"""The corpus pipeline: from raw documents to token files.

Each stage takes what the one before it kept, and is written as Parquet in the
shared folder and read again. All but the last return the columns of
``documents``.

1. ``quality``: documents that the classifier rejects go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``decontaminate``: documents that hold a benchmark window go.
4. ``mix``: sources are repeated to their target weights, in shuffled order.
5. ``tokens``: token files are written and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.llm.common import materialize, read
from pressroom.llm.decontaminate import clean_documents
from pressroom.llm.jaccard_join import one_of_each_group
from pressroom.llm.mixing import mix_sources
from pressroom.llm.quality import THRESHOLD, document_stats, fit_quality, score_column
from pressroom.llm.token_files import token_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(document_stats(docs), read(spark, sf_dir, "labels"))
    return docs.where(score_column(model, F.col("text")) >= THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_table(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

#: The classifier and the coder can't be expressed in SQL; tests/llm holds the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
