"""Phrase collocations by SON partitioning (operator 12).

Documents are dealt into shards by hash. A phrase that occurs ``support`` times in all has, in at least one
shard, its share of them: ``support`` times the shard's share of all words. So every shard is mined completely
at this lower support, in levels: words and pairs first, then the three and four words whose pairs are all
frequent in the shard. The phrases frequent in any shard are the candidates, and a last pass counts each of
them in all texts, exactly.

A shard is a group of rows, not a task: tasks count in batches, and Spark adds up by shard and hash. Two phrases
that share a 64-bit hash only make a candidate more. Tasks look candidates up in a bit set of fixed size, whatever
the input; chance hits are counted like candidates and fall to the final filter, on counts of the phrases themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import split_join, staged
from basketry.llm.words import U64, hashed, mixed, slices

LENGTH, SUPPORT, TOP = 4, 30, 2000
#: Parts of a candidate's count, in hundredths, that a longer one must reach to drop it.
COVER = 80
SHARDS = 8
#: Bits of the set of candidates: 8 MiB.
BITS = 1 << 26
#: Groups by which a language is ranked before all of it is.
SALTS = 64
BASE = U64(0x9E3779B97F4A7C15)

#: What ends a piece: fixed values.
BREAKS = r"[.,;:!?\x0A-\x0D]"
#: A word, counted where no phrase is needed.
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"

#: Text bytes counted at once; the numbers a task keeps for them take about forty times as much.
SLICE_BYTES = 2 << 20
#: A shard and the hash of a phrase in one number: the shard above this many bits of the hash.
HASH_BITS = U64(56)
LOW = (1 << 56) - 1
#: What tells the same phrase of two shards apart in one bit set.
SPREAD = 0x9E3779B97F4B

COUNTS = "h long, n long"
PHRASES = "lang string, phrase string, words int, n long"


class Batch:
    """The words of a batch of texts: ``codes`` of ``vocabulary``, the piece and the text each stands in."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        text = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
        # A line feed of its own marks the end of a piece: no word can hold one.
        text = pc.replace_substring_regex(text, BREAKS, " \n ")
        lists = pc.split_pattern(pc.replace_substring(text, "\t", " "), " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.vocabulary = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), sizes)
        end = np.zeros(len(codes), bool)
        end[(np.cumsum(sizes) - sizes)[sizes > 0]] = True  # a text begins
        for mark in ("\n", ""):
            at = pc.index(self.vocabulary, pa.scalar(mark, self.vocabulary.type)).as_py()
            if mark:
                end |= codes == at
                skip = codes == at
            else:
                skip |= codes == at
        self.piece, self.row, self.codes = np.cumsum(end)[~skip], row[~skip], codes[~skip]
        langs = batch.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        word, lang = (hashed(d.to_pylist(), seed) for seed, d in enumerate((self.vocabulary, self.langs)))
        self.word = word[self.codes]
        self.own = lang[self.lang[self.row]]

    def whole(self, length: int) -> np.ndarray:
        """Whether ``length`` words from each place on stand in one piece; shorter by ``length`` - 1."""
        return self.piece[:len(self.piece) - length + 1] == self.piece[length - 1:]

    def hashes(self, longest: int = LENGTH) -> list[np.ndarray]:
        """Hashes of language and words of the phrases of 1, 2, ... words from each place on."""
        out, held = [], mixed(self.word ^ self.own)
        for length in range(1, longest + 1):
            if length > 1:
                held = mixed(held[:-1] * BASE + self.word[length - 1:]) if len(held) else held
            out.append(held & U64(LOW))
        return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Batch]]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            words = Batch(batch)
            if len(words.codes):
                yield batch, words


def _counted(shard: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    number, distinct = pd.factorize(h | shard << HASH_BITS)
    return pa.RecordBatch.from_arrays(
        [pa.array(distinct.view(np.int64)), pa.array(np.bincount(number, minlength=len(distinct)))], ["h", "n"])


def _bit(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = h & U64(64 * len(bits) - 1)
    return (bits[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) == 1


def _members(hashes: DataFrame, value: Column) -> np.ndarray:
    """The bit set of a column of hashes: ``BITS`` / 64 rows reach the driver at most."""
    place = value.bitwiseAND(F.lit(BITS - 1))
    words = hashes.select(place.alias("place")).groupBy(F.expr("cast(place div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, U64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(U64)
    return out


def words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, words in _batches(batches):
        shard = batch.column("shard").to_numpy().astype(U64)[words.row]
        h = words.hashes(2)
        for length in (1, 2):
            real = words.whole(length)
            yield _counted(shard[:len(real)][real], h[length - 1][real])


def longer(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases of three words and more whose pairs are all frequent in the shard."""
    for batch, words in _batches(batches):
        shard = batch.column("shard").to_numpy().astype(U64)[words.row]
        h = words.hashes()
        pair = _bit(h[1] + shard[:len(h[1])] * U64(SPREAD), bits)
        held = pair
        for length in range(3, LENGTH + 1):
            held = held[:-1] & pair[length - 2:]
            real = held & words.whole(length)
            yield _counted(shard[:len(real)][real], h[length - 1][real])


def exactly(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases in ``bits``, told apart by their words, not by hashes."""
    for _, words in _batches(batches):
        many, n = len(words.vocabulary), len(words.codes)
        number, _ = pd.factorize(words.lang[words.row] * many + words.codes)
        number, before = number.astype(np.int64), np.ones(n, bool)
        for length, h in enumerate(words.hashes(), 1):
            chosen = words.whole(length) & _bit(h, bits)
            if length > 1:  # of a candidate, the shorter phrases in it are candidates too
                chosen &= before[:len(chosen)] & before[1:len(chosen) + 1]
            at = np.flatnonzero(chosen)
            before = np.zeros(n, bool)
            before[at] = True
            if not len(at):
                break
            key = number[at] if length == 1 else number[at] * many + words.codes[at + length - 1]
            ids, _ = pd.factorize(key)
            number = np.zeros(n, np.int64)
            number[at] = ids
            first = np.empty(ids.max() + 1, np.int64)
            first[ids[::-1]] = at[::-1]
            parts = [words.vocabulary.take(pa.array(words.codes[first + k])) for k in range(length)]
            yield pa.RecordBatch.from_arrays([
                words.langs.take(pa.array(words.lang[words.row[first]])),
                pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0],
                pa.array(np.full(len(first), length, np.int32)), pa.array(np.bincount(ids))],
                ["lang", "phrase", "words", "n"])


def frequent(rows: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of the phrases of 1 to ``LENGTH`` words that occur ``support`` times, (lang, n) of all words)."""
    if not 0 < shards <= 256:
        raise ValueError("between 1 and 256 shards")
    context = rows.sparkSession.sparkContext
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    sizes = staged(dealt.groupBy("lang", "shard").agg(
        F.sum(F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))).alias("n")), "words")
    of_shard = {r["shard"]: r["n"] for r in sizes.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    total = max(1, sum(of_shard.values()))
    # The least whole number that reaches support * share, of each shard.
    local = F.array(*(F.lit(max(1, -(-support * of_shard.get(s, 0) // total))) for s in range(shards)))

    def enough(counts: DataFrame, label: str) -> DataFrame:
        # Most hashes are new to their task: they are added up behind the shuffle only.
        shard = F.shiftrightunsigned("h", int(HASH_BITS)).cast("int")
        return staged(counts.repartition("h").groupBy("h").agg(F.sum("n").alias("n"))
                      .filter(F.col("n") >= F.element_at(local, shard + 1))
                      .select(shard.alias("shard"), F.col("h").bitwiseAND(F.lit(LOW)).alias("h")), label)

    texts = dealt.select("shard", "lang", "text")
    short = enough(texts.mapInArrow(words_and_pairs, COUNTS), "short")
    in_shard = context.broadcast(_members(short, F.col("h") + F.col("shard") * F.lit(SPREAD)))
    long = enough(texts.mapInArrow(lambda b: longer(b, in_shard.value), COUNTS), "long")
    anywhere = context.broadcast(_members(short.unionByName(long), F.col("h")))
    counts = staged(
        texts.mapInArrow(lambda b: exactly(b, anywhere.value), PHRASES)
        .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= support), "phrases")
    return counts, sizes.groupBy("lang").agg(F.sum("n").alias("n"))


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): each phrase of two words and more with its lowest-scoring cut."""
    cuts = (
        counts.filter("words > 1")
        .select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
        .withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "tail": F.expr("substring_index(phrase, ' ', k - words)")})
    )
    head, tail = (counts.select("lang", F.col("phrase").alias(c), F.col("n").alias(n)) for c, n in (("head", "l"), ("tail", "r")))
    points = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    both = split_join(split_join(cuts, head, ["lang", "head"]), tail, ["lang", "tail"]).withColumn("score", points)
    return both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame, cover: int = COVER) -> DataFrame:
    """(lang, phrase, most): phrases of two words and more that stand in longer ones, with the longer ones' highest count."""
    return (
        counts.filter("words > 2")
        .withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("start", F.explode(F.expr("sequence(1, words - size + 1)")))
        .select("lang", F.expr("array_join(slice(split(phrase, ' '), start, size), ' ')").alias("phrase"), "n")
        .groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    )


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, cover: int = COVER, shards: int = SHARDS,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A to Z are lower-cased; texts are cut into pieces at . , ; : ! ? and the control characters 10 to 13, pieces into
    words at spaces and tabs. Phrases are 2 to 4 words that occur ``support`` times or more in a language, overlapping
    occurrences included. ``score`` is floor(2000000 a / (l + r)) for the cut that makes it lowest, at the smallest
    place; a phrase that lies in a longer one with ``cover`` hundredths of its count or more is left out. NULL
    texts are empty; a NULL language is ``und``, as is one of that name. Repeated rows count each. Ties in score go to
    the higher ``a``, then to the smaller phrase in bytes. Texts without phrases and empty tables give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    counts, sizes = frequent(rows, support, shards)
    inside = F.coalesce(F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * cover, F.lit(False))
    found = scored(counts).join(covered(counts), ["lang", "phrase"], "left").filter(~inside)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # In two steps, so that a language with very many phrases is not ranked by one task alone.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = (
        found.withColumn("salt", salt)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    )
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")
