"""Language identification by nearest centroid (operator 1).

A text becomes counts of its character 2- and 3-grams (lower case, anything but letters as one
space), hashed to a fixed number of features, weighted by TF-IDF and normalised. Each language has
several centroids, found by spherical k-means among its training texts, since one language holds
several kinds of text. A text gets the language of the centroid with the greatest cosine; it is
rejected if it is farther from it than the training texts of the language warrant.

The classifier is fitted on at most ``TRAINING_TEXTS`` whole texts of each language, chosen by a
hash. Prediction is one pass over all texts without a shuffle; each task receives the model, whose
size is languages x centroids x features and is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import staged
from basketry.llm.words import slices

#: Bound of the training sample: texts of a language.
TRAINING_TEXTS = 512
CENTROIDS = 4
#: Ids of training texts that may be broadcast (some tens of megabytes).
BROADCAST_IDS = 1_000_000
FEATURE_BITS = 14
ROUNDS = 8
#: Most the model may hold, in bytes; beyond it, fewer features or centroids have to be chosen.
MODEL_BYTES = 512 << 20
#: Parameter of the classifier: a cluster with less than this share of a language's texts makes no centroid.
SMALLEST = 0.02
#: A text is rejected below this share of the 1st percentile of its language's training cosines. A
#: text of few letters has few n-grams and is far from everything, so the bound falls with
#: the square root of its letters up to ``FULL_LETTERS``.
SLACK = 0.5
FULL_LETTERS = 400
UNDETERMINED = "und"

U32 = np.uint32
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str, bits: int = FEATURE_BITS) -> tuple[np.ndarray, int]:
    """(hashed 2- and 3-grams of a text, number of its letters)."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), U32)
    real = letters()[codes]
    kept = real.copy()
    kept[1:] |= real[:-1]  # of what stands between letters, the first is kept, as a space
    kept[0] = True
    c = np.where(real, codes, U32(32))[kept]
    pairs = c[:-1] * U32(0x9E3779B1) + c[1:] * U32(0x85EBCA77)
    triples = pairs[:-1] * U32(0xC2B2AE3D) + c[2:] * U32(0x27D4EB2F)
    grams = np.concatenate([pairs, triples])
    grams ^= grams >> U32(15)
    return (grams * U32(0x2C1B3C6D)) >> U32(32 - bits), int(real.sum())


def features(text: str, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray, int]:
    """(features, 1 + log count of each, letters)."""
    grams, n = ngrams(text, bits)
    counts = np.bincount(grams, minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, 1 + np.log(counts[at]), n


@dataclass
class Model:
    """labels: language of each centroid; far: cosine below which a long text is rejected."""

    labels: list[str]
    centroids: np.ndarray  # features x centroids
    far: np.ndarray
    idf: np.ndarray

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """(language, cosine, whether the text is rejected)."""
        at, weights, n = features(text, int(np.log2(len(self.idf))))
        weights = weights * self.idf[at]
        if not n:
            return UNDETERMINED, 0.0, True
        length = np.linalg.norm(weights)
        cosines = weights @ self.centroids[at] / length
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.labels[best], score, score < self.far[best] * min(1.0, (n / FULL_LETTERS) ** 0.5)


def clustered(vectors: np.ndarray, k: int, rounds: int, smallest: float = SMALLEST) -> np.ndarray:
    """Centroids by spherical k-means, from seeds drawn by their distance from the earlier ones.

    Clusters of less than ``smallest`` of the texts are oddities, not kinds of text, and are left out.
    """
    draw = np.random.default_rng(1)
    seeds = [int(np.argmax(vectors @ vectors.mean(0)))]
    while len(seeds) < min(k, len(vectors)):
        gap = np.clip(1 - (vectors @ vectors[seeds].T).max(1), 0, None) ** 2
        if not gap.sum() > 1e-9:
            break
        seeds.append(int(draw.choice(len(vectors), p=gap / gap.sum())))
    centroids = vectors[seeds]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == c].sum(0) for c in range(len(centroids))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-12), centroids)
    held = np.bincount(np.argmax(vectors @ centroids.T, axis=1), minlength=len(centroids))
    return centroids[held >= max(1, smallest * len(vectors))]


def training_ids(labelled: DataFrame, texts: int) -> DataFrame:
    """(id, lang): of each language, the ``texts`` ids with the smallest hashes, of rows (id, lang).

    Ids are counted first; then only those whose hash lies in the lowest part of its range, which
    holds about four times as many as are wanted, are numbered. So what one task numbers does not grow
    with the table, and an id that many rows repeat counts once.
    """
    hashed = labelled.withColumn("hash", F.xxhash64("id", "lang", F.lit(7)))
    known = staged(labelled.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids")), "languages")
    if known.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    order = Window.partitionBy("lang").orderBy("hash", "id")
    return (
        hashed.join(known, "lang").filter(F.col("hash") / F.lit(2.0**64) + 0.5 <= F.lit(4.0 * texts) / F.col("ids"))
        .select("id", "lang", "hash").distinct()
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= texts).select("id", "lang")
    )


def fit(docs: DataFrame, trains: Column, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id", texts: int = TRAINING_TEXTS, k: int = CENTROIDS) -> Model | None:
    """The model of the rows where ``trains`` holds, or None if no such row has a language and text.

    Texts are reduced to features in tasks; each language is clustered in one, on at most ``texts``
    texts. The driver receives centroids and document frequencies, both of fixed size.
    """
    bits, width = FEATURE_BITS, 1 << FEATURE_BITS
    labelled = docs.filter(trains & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    chosen = staged(training_ids(labelled, texts), "chosen")
    # A few hundred ids per language, so few that they go to every task; with very many languages, not.
    if chosen.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [features(t, bits) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "at": [m[0].astype(np.int32) for m in made],
                                "weights": [m[1].astype(np.float32) for m in made]})

    # Rows that repeat a chosen id come back all; numbered again, they are no more than ``texts``.
    again = Window.partitionBy("lang").orderBy(F.xxhash64("id", "text"), "id", "text")
    sample = staged(
        docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .join(chosen, ["id", "lang"]).filter(F.col("text").rlike(r"\p{L}"))
        .withColumn("place", F.row_number().over(again)).filter(F.col("place") <= texts).select("lang", "text")
        .mapInPandas(reduce, "lang string, at array<int>, weights array<float>"),
        "language-sample",
    )
    seen = sample.select(F.explode("at").alias("feature")).groupBy("feature").count().toPandas()
    if seen.empty:
        return None
    frequency = np.zeros(width)
    frequency[seen["feature"].to_numpy()] = seen["count"].to_numpy()
    idf = np.log((1 + sample.count()) / (1 + frequency)) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        vectors = np.zeros((len(group), width), np.float32)
        for row, (at, weights) in enumerate(zip(group["at"], group["weights"], strict=True)):
            vectors[row, at] = weights * idf[at]
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        # The rows' order differs by run; sorted, the same sample gives the same centroids.
        vectors = vectors[np.lexsort(vectors[:, :64].T)]
        centroids = clustered(vectors, k, ROUNDS)
        far = float(np.quantile((vectors @ centroids.T).max(1), 0.01))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "far": far,
                             "centroid": [c.astype("<f4").tobytes() for c in centroids]})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, far double, centroid binary")
    rows = found.orderBy("lang", "centroid").toPandas()
    if len(rows) * width * 4 > MODEL_BYTES:
        raise ValueError(f"{len(rows)} centroids of {width} features exceed MODEL_BYTES")
    return Model(list(rows["lang"]), np.stack([np.frombuffer(c, "<f4") for c in rows["centroid"]]).T.copy(),
                 rows["far"].to_numpy() * SLACK, idf)


def identified(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with lang_pred, score and rejected for each row."""
    schema = docs.select(keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sent = docs.select(*keep, *([] if text_col in keep else [text_col]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole, text_col):
                found = [(UNDETERMINED, 0.0, not any(map(str.isalpha, text or "")))
                         if text is None or model is None else model.nearest(text)
                         for text in batch.column(text_col).to_pylist()]
                lang, score, rejected = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(lang, pa.string()),
                     pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    [*keep, "lang_pred", "score", "rejected"])

    return sent.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: every fifth, by the CRC-32 of its id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (cosine, 0 to 1), rejected.

    lang_pred is a language seen in training, or ``und`` with score 0 where the text is NULL, empty
    or without a letter, or nothing could be learned. Texts without a letter are rejected, as are those
    too far from every centroid, though lang_pred names the nearest. Without a model no other is.
    Equal cosines go to the first language by name. Rows that repeat are predicted alike; those without id or language don't train.
    """
    model = fit(docs, ~held_out(id_col), text_col, lang_col, id_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return identified(rows, model, ["doc_id", "held_out"])


def in_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    model = fit(docs, ~held_out(id_col), text_col, lang_col, id_col)
    plain = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes with a result
    found = identified(docs.toDF(*plain), model, plain, plain[docs.columns.index(text_col)])
    return found.filter("not rejected").select(plain).toDF(*docs.columns)
