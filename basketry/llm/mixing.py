"""Mixing sources to target weights by Sainte-Lague apportionment (operator 4).

Targets: all words are shared among the sources by weight; a target stops at a number of times its
source's size, and the excess is shared again. The mix is made of blocks of equal length, given to
the sources by highest quotients (target / 1, 3, 5, ...), which yields integer quotas; a source at its
limit is taken whole. Documents are dealt by hash into shards of bounded size. The documents of a source
form one line through all shards, in seeded order, cut into blocks; every block is taken equally often,
and some once more. A block belongs to the shard it begins in. The quota of a shard is what the seats of
its source between the blocks up to its end and those after gain over the same at its start, so quotas are
integers that add up to the source's seats, however short the texts. The seed picks that many of a shard's blocks.

One shuffle of small rows, and one of the words of each source in each shard, whose running sum says
where in the line a shard begins. No task holds more than a shard, whatever the size of a source.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import dealt_by_hash, slice_count, staged, words_in

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source (and so a document) is taken this often at most.
MOST = 3
BLOCK_WORDS = 16
ROWS_PER_SHARD = 2048
SEED = 20240607


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row per source.

    A source is capped once its share exceeds ``most`` times its size; the rest is shared anew among
    the others until none is above. Every round is one aggregation that returns two numbers.
    """
    cycle = F.array(*map(F.lit, weights))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    rows = staged(sizes.select("source", "source_size", cycle[place % len(weights)].alias("weight"),
                               (F.col("source_size") * most).alias("cap")), "sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    capped, level = -1, 0.0
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        n, left, weight = rows.agg(
            F.count_if(over), F.lit(total) - F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not weight:
            break
        capped, level = n, left / weight
    share = F.when(over, F.col("cap")).otherwise(F.col("weight") * F.lit(float(level)))
    return rows.select("source", "source_size", F.least(share.cast("double"), F.col("cap").cast("double")).alias("target"))


def apportioned(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by Sainte-Lague: each goes to the highest votes / (2 * seats so far + 1); ties to the first."""
    total = votes.sum()
    if not total:
        return np.zeros(len(votes), np.int64)
    # Rounding at a common divisor allots all but a few seats as the quotients would.
    given = np.floor(votes * seats / total + 0.5).astype(np.int64)
    short = seats - int(given.sum())
    if short > 0:
        queue = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, given, strict=True))]
        heapq.heapify(queue)
        for _ in range(short):
            _, i = queue[0]
            given[i] += 1
            heapq.heapreplace(queue, (-votes[i] / (2 * given[i] + 1), i))
    elif short < 0:
        queue = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, given, strict=True)) if g]
        heapq.heapify(queue)
        for _ in range(-short):
            i = -queue[0][1]
            given[i] -= 1
            if given[i]:
                heapq.heapreplace(queue, (votes[i] / (2 * given[i] - 1), -i))
            else:
                heapq.heappop(queue)
    return given


def quotas(sources: pd.DataFrame, block: int, most: int) -> pd.DataFrame:
    """(place, base, extra) of all sources: how often all their words are taken, and how many blocks once more."""
    sources = sources.sort_values("place")
    seats = apportioned(sources["target"].to_numpy(), round(sources["target"].sum() / block))
    out = []
    for place, size, target, n in zip(sources["place"], sources["source_size"], sources["target"], seats, strict=True):
        size, n = int(size), int(n)
        base = most if target >= most * size else min(most, n * block // size)
        extra = 0 if base == most else min(-(-size // block), round((n * block - base * size) / block))
        out.append((place, base if size else 0, extra))
    return pd.DataFrame(out, columns=["place", "base", "extra"])


def shard_quotas(dealt: DataFrame, block: int) -> DataFrame:
    """(shard, place, before, first, last, quota, owner_*): the blocks [first, last) that begin in a shard,
    and how many of them are taken once more; ``before`` counts the words of the shards before.

    ``owner_*`` is the same of the nearest shard before in which a block begins: its last may reach into this one.
    """
    earlier = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    held = dealt.groupBy("shard", "place").agg(
        F.sum("size").alias("held"), F.max("extra").alias("extra"),
        F.max("source_size").alias("size")
    ).withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    begun = lambda words: F.expr(f"cast(({words} + {block - 1}) div {block} as long)")
    cut = held.select("shard", "place", "before", "extra", begun("size").alias("blocks"),
                      begun("before").alias("first"), begun("before + held").alias("last"))
    # Sainte-Lague between two parts of a line: the nearest integer.
    seats = "cast((2 * cast(extra as decimal(18,0)) * {0} + blocks) div (2 * blocks) as long)"
    given = cut.withColumn("quota", F.when(F.col("blocks") > 0, F.expr(seats.format("last")) - F.expr(seats.format("first")))
                           .otherwise(F.lit(0)))
    own = F.when(F.col("last") > F.col("first"), F.struct("shard", "first", "last", "quota"))
    return given.withColumn("owner", F.last(own, ignorenulls=True).over(earlier)).select(
        "shard", "place", "before", "first", "last", "quota",
        *[F.coalesce(f"owner.{c}", F.lit(0)).alias(f"owner_{c}") for c in ("shard", "first", "last", "quota")])


def taken_again(place: int, shard: int, first: int, last: int, quota: int, seed: int) -> np.ndarray:
    """The blocks among [first, last) of a shard that are taken once more; whoever asks gets the same."""
    drawn = np.random.default_rng([seed, place, shard]).choice(last - first, quota, replace=False, shuffle=False)
    return first + np.sort(drawn)


def mixed_shard(shard: pd.DataFrame, starts: pd.DataFrame, block: int, seed: int) -> pd.DataFrame:
    """Adds to the rows of one shard: taken, copies and the ranges of words taken once more.

    ``starts`` has the rows of ``shard_quotas`` for the shard.
    """
    shard = shard.sort_values(["place", "spread", "doc_id", "size"], na_position="last").reset_index(drop=True)
    size = shard["size"].to_numpy()
    ends = np.cumsum(size)
    place, first = np.unique(shard["place"].to_numpy(), return_index=True)
    held = np.add.reduceat(size, first)
    known = {int(start.place): start for start in starts.itertuples()}
    copies = np.where(size > 0, shard["base"].to_numpy(), 0)
    ranges: list[list[dict]] = [[] for _ in range(len(shard))]
    for c, start in enumerate(first):
        stop = first[c + 1] if c + 1 < len(first) else len(shard)
        own, words = known[int(place[c])], int(held[c])
        if not words or not shard["extra"].iloc[start]:
            continue
        begin = int(own.before)
        once = taken_again(own.place, own.shard, own.first, own.last, own.quota, seed)
        if begin % block and own.owner_quota:
            reaching = taken_again(own.place, own.owner_shard, own.owner_first, own.owner_last, own.owner_quota, seed)[-1:]
            once = np.concatenate([reaching[reaching == own.first - 1], once])
        before = ends[start] - size[start]
        # Neighbouring blocks make one run of words; a document takes what of it lies within.
        cut = np.flatnonzero(np.diff(once) > 1) + 1
        for run in np.split(once, cut) if len(once) else ():
            left, right = max(0, int(run[0]) * block - begin), min((int(run[-1]) + 1) * block - begin, words)
            row = start + int(np.searchsorted(ends[start:stop] - before, left, side="right"))
            while row < stop and ends[row] - size[row] - before < right:
                from_, to = (max(left, int(ends[row] - size[row] - before)), min(right, int(ends[row] - before)))
                if to > from_:
                    offset = int(ends[row] - size[row] - before)
                    ranges[row].append({"first": from_ - offset, "last": to - offset})
                row += 1
    extra = np.array([sum(r["last"] - r["first"] for r in rs) for rs in ranges], np.int64)
    taken = copies * size + extra
    return shard.assign(taken=taken, copies=copies, ranges=ranges)[
        ["row", "doc_id", "spread", "size", "source_size", "target", "taken", "copies", "ranges"]]


MIXED = ("row long, doc_id string, spread long, size long, source_size long, target double, taken long, copies long, "
         "ranges array<struct<first long, last long>>")


def _spread(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), id_col, text_col)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK_WORDS,
          rows_per_shard: int = ROWS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """What the mix takes of each row: row, doc_id, spread, size, source_size, target, taken, copies, ranges.

    ``size`` is the number of words; ``taken`` counts repeats, as ``copies`` times the whole text plus
    the word ranges [first, last) in ``ranges``. NULL is a source of its own, after all others. A
    NULL or empty text has size 0 and is not taken. Rows that repeat an id are rows of their own
    and may be taken differently. An empty table gives an empty result. The same table gives
    the same mix, however it is partitioned, unless more rows than a shard holds agree in id and text.
    """
    rows = staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                    F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
                    _spread(id_col, text_col, seed).alias("spread")), "sizes")
    shares = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    shares = staged(shares.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))),
                    "targets")
    given = shares.select("place", "source_size", "target").groupBy().applyInPandas(
        lambda sources: quotas(sources, block, most), "place int, base long, extra long")
    shares = staged(shares.join(given, "place"), "quotas")
    shards = slice_count(rows.count(), rows_per_shard)
    rows = dealt_by_hash(rows, "shard", shards, rows_per_shard)
    dealt = (
        rows.join(shares, rows["source"].eqNullSafe(shares["source"]))
        # As text: a NULL among numbers would make pandas round them.
        .select("row", F.col("doc_id").cast("string").alias("doc_id"), "size", "spread", "place",
                "source_size", "target", "base", "extra", "shard")
    )
    starts = staged(shard_quotas(dealt, block), "shard-quotas")
    return dealt.groupBy("shard").cogroup(starts.groupBy("shard")).applyInPandas(
        lambda shard, starts: mixed_shard(shard, starts, block, seed), MIXED,
    ).withColumn("doc_id", F.col("doc_id").cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        length_col: str | None = "n_chars", seed: int = SEED, **options: int) -> DataFrame:
    """The mix itself, with the columns of ``docs``.

    A document appears once per whole copy, and once more with the words of its ranges, joined by
    one space, where a part of it is taken; ``length_col``, if there is one, is set for that part.
    """
    key = ["__none", "__known", "__spread"]
    taken = (
        mixed(docs, id_col, text_col, source_col, seed=seed, **options).filter("taken > 0")
        .groupBy(F.isnull("doc_id").alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__known"),
                 F.col("spread").alias("__spread"))
        .agg(F.array_sort(F.collect_list(F.struct("copies", "ranges", "row"))).alias("__taken"))
    )
    rows = (
        docs.withColumns({"__none": F.isnull(id_col), "__known": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
                          "__spread": _spread(id_col, text_col, seed)})
        .join(taken, key)
        # Rows that agree in id and text share a list of decisions, and each takes its own.
        .withColumn("__own", F.get("__taken", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1))) - 1))
        .filter("__own is not null")
    )
    words = F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.flatten(F.transform(
        "__own.ranges", lambda r: F.slice(F.col("__words"), (r["first"] + 1).cast("int"),
                                          (r["last"] - r["first"]).cast("int")))), " ")
    some = F.size("__own.ranges") > 0
    out = (
        # Behind a generator the words stay a column: the text is not split again for each of its ranges.
        rows.withColumn("__words", F.explode(F.array(F.when(some, words)))).withColumn("__part", F.when(some, part))
        .withColumn("__text", F.explode(F.concat(
            F.array_repeat(F.struct(F.lit(False).alias("cut"), F.col(text_col).alias("text")), F.col("__own.copies").cast("int")),
            F.when(some, F.array(F.struct(F.lit(True).alias("cut"), F.col("__part").alias("text")))).otherwise(F.array()))))
        .withColumn(text_col, F.col("__text.text"))
    )
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col("__text.cut"), F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(docs.columns)
