"""The registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.collocations import collocations
from basketry.llm.exact_dedup import exact_duplicates
from basketry.llm.language_id import languages
from basketry.llm.mixing import mixed
from basketry.llm.ngram_join import joined
from basketry.llm.packing import packed
from basketry.llm.permutation_index import neighbours
from basketry.llm.shared import table
from basketry.llm.substring_dedup import without_repeats
from basketry.llm.token_files import token_digests
from basketry.llm.topk import top_k
from basketry.llm.url_rules import judged
from basketry.llm.vector_codes import vector_codes
from basketry.llm.warc import archived_pages


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "class_size", "stays")


def op6_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op3_url_rules": op3_url_rules,
    "op4_source_mixing": op4_source_mixing,
    "op2_warc_revisits": op2_warc_revisits,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_mixture_packing": op6_mixture_packing,
    "op7_token_files": op7_token_files,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_permutation_index": op13_permutation_index,
}
