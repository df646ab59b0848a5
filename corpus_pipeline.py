"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it to the shared folder as
Parquet and reads it again for the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm.exact_dedup import without_duplicates
from basketry.llm.language_id import in_known_language
from basketry.llm.mixing import mix
from basketry.llm.ngram_join import one_of_each_class
from basketry.llm.packing import packed
from basketry.llm.shared import staged, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those far from every known language."""
    return in_known_language(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of equal texts."""
    return without_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return one_of_each_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts documents so that sources reach their target weights."""
    return mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("source_mixing", mixing_stage),
    ("mixture_packing", packing_stage),
]

#: SQL has no counterpart of the classifier and the tokenizer; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
