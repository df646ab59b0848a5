"""Small tables with the cases every operator has to stand: nulls, empty and long texts, ties,
repeated rows, extra columns whose names operators use themselves."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = [a + b for a in ("al", "be", "co", "du", "er", "fa") for b in ("n", "rt", "sil", "mo", "x", "")]
CLASHING = ["row", "rank", "size", "key", "spread", "shard", "slice", "node", "kept", "copy", "name",
            "text_key", "class", "count", "ids", "tokens", "place", "score", "rejected"]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(("", "", "", ".", ",")) for _ in range(n))


def changed(text: str, *places: int) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = "changed"
    return " ".join(words)


def document_rows() -> list[tuple]:
    base, passage, long = prose(1, 120), prose(2, 70), prose(3, 20_000)
    texts = [
        base, base, changed(base, 60), changed(base, 10, 20, 30, 40, 50, 60, 70, 80), f"{prose(4, 30)} {passage} {prose(5, 30)}",
        f"{passage}\n{prose(6, 15)}", None, None, "", " \t\n", "one", "one", "two words", "two  words", "two\twords",
        long, long, changed(long, 5000), "12345 678 !!", prose(7, 50), prose(7, 50) + " more", prose(8, 49),
        "the same " * 60, "the same " * 90, "é" * 3000, "日本語。" * 800, base.upper(),
    ]
    rows = [(i * 3 + 1, t, ("en", "de", None)[i % 3], ("a", "b", None, "Z")[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], rows[6], (None, base, "en", "a"), (None, prose(9, 80), "de", "b"), (None, None, None, None)]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def documents(spark: SparkSession, rows: list[tuple] | None = None, clashing: bool = True) -> DataFrame:
    docs = spark.createDataFrame(document_rows() if rows is None else rows, SCHEMA)
    return docs.withColumns({c: F.lit(f"mine {c}") for c in CLASHING}) if clashing else docs


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
