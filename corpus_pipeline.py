"""The corpus pipeline: raw documents to packed training sequences.

1. ``language_id``: documents without a language go; ``lang`` becomes the predicted one.
2. ``line_dedup``: lines repeated over a source's pages go from the texts.
3. ``near_duplicates``: one document of each SimHash component stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``packing``: the texts that are left become token sequences.

Each stage takes what its predecessor kept, written as Parquet and read again.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.llm import decontaminate, language, line_dedup, packing, simhash
from telemetra.llm.common import DOCUMENT_COLUMNS, cut, is_remainder, table
from telemetra.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs.filter(~is_remainder("doc_id", 4, 2)))
    found = docs.select("doc_id", "text", language.identify(spark, model, F.col("text"))["lang_pred"].alias("lang"),
                        "source", "n_chars")
    return found.filter(F.col("lang") != language.UNDETERMINED)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(docs.select(*DOCUMENT_COLUMNS))
    return cleaned.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs.select(*DOCUMENT_COLUMNS))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]
#: language ID, SimHash and tokenising have no SQL form; tests hold the run against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
