"""Exact deduplication by content-defined chunk recipes (operator 10), with SQL functions only.

A text is read once. White space is collapsed, the text is cut where its own content says so, and
each chunk is named by a 64-bit hash. The names are verified: a name that stands for two contents
(seen by 120 bits of SHA-256 and the length) is replaced by one that tells them apart. A document is
then its recipe, the ordered list of chunk names, and rows with equal recipes are one group.
The SHA-256 of the whole text decides nothing; should it differ within a group, the query fails.

Long texts stay where they are: what moves is about 32 bytes per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import SPACES, split_join, staged, staying

#: A chunk ends after a punctuation mark and a space (or a full-width mark), 256 characters after
#: its start at the earliest and 4,096 at the latest.
CHUNK = r"(?s).{256,4096}?(?:[.!?;:,|)] |[。！？])|.{1,4096}"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _chunk(part: Column) -> Column:
    digest = F.sha2(part, 256)
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return F.struct(F.xxhash64(part).alias("name"), number(1).alias("high"),
                    number(16).alias("low"), F.length(part).alias("length"))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, text_sha256, recipe) of each row; ``row`` numbers the rows of this reading."""
    read = staged(
        docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("whole"))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id",
                F.sha2("whole", 256).alias("text_sha256"),
                F.transform(F.regexp_extract_all("whole", F.lit(CHUNK), F.lit(0)), _chunk).alias("chunks")),
        "recipes",
    )
    chunks = read.select("row", F.posexplode("chunks").alias("place", "chunk")).select(
        "row", "place", "chunk.*")
    spans = [(F.min(c).alias(f"{c}_0"), F.max(c).alias(f"{c}_1")) for c in ("high", "low", "length")]
    shared_names = staged(
        chunks.groupBy("name").agg(*[x for pair in spans for x in pair])
        .filter("high_0 <> high_1 or low_0 <> low_1 or length_0 <> length_1").select("name"), "shared-names")
    if shared_names.isEmpty():
        return read.select("row", "doc_id", "text_sha256", F.col("chunks.name").alias("recipe"))
    renamed = (
        split_join(chunks, shared_names, ["name"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct(
            "place", F.xxhash64("name", "high", "low", "length")))).alias("other"))
    )
    return read.join(renamed, "row", "left").select(
        "row", "doc_id", "text_sha256",
        F.transform("chunks", lambda c, i: F.coalesce(F.col("other")[i], c["name"])).alias("recipe"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays; a NULL id comes last; of rows that agree in
    id and text one stays. NULL and empty texts are equal. Texts that differ only in the kind or
    length of their white space are equal; white space at an end is not dropped. An empty table
    gives an empty result. Other columns of ``docs`` are ignored.
    """
    listed = recipes(docs, id_col, text_col)
    groups = listed.groupBy("recipe").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("group_size"), F.min("text_sha256").alias("digest"))
    mixed = F.raise_error(F.lit("texts that differ have the same recipe")).cast("string")
    return split_join(listed, groups, ["recipe"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.when(F.col("text_sha256") == F.col("digest"), F.col("text_sha256")).otherwise(mixed).alias("text_sha256"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    found = exact_duplicates(docs, id_col, text_col).select(
        "doc_id", F.col("text_sha256").alias("text_key"), F.col("kept").alias("stays"))
    return staying(docs, found, F.col(id_col), F.sha2(normalised(F.col(text_col)), 256))
