"""Vector codes, phrase collocations and the permutation index against brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, inf, isqrt, nan

import numpy as np
import pytest
from conftest import SF_MEDIUM
from pyspark.sql import functions as F
from tables import CLASHING, document_rows, documents, no_documents, prose

from basketry.llm import collocations, permutation_index, vector_codes
from basketry.llm.shared import table

VECTORS = "vec_id long, embedding array<double>, label int"


def vectors_of(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema).withColumns(
        {c: F.lit(f"mine {c}") for c in ("vector", "part", "entry", "sums", "n", "error", "prefix", "asked", "asks", "block", *CLASHING)})


# --- codes ---

def plain_nearest(entries, asked):
    out = []
    for q in asked:
        away = [sum((int(a) - int(b)) ** 2 for a, b in zip(q, e)) for e in entries]
        out.append((away.index(min(away)), min(away)))
    return out


@pytest.mark.parametrize("size,spread", [(1, 5), (3, 5), (16, 3), (16, 4000), (97, 6), (256, 100), (40, 10**12)])
def test_tree_finds_the_nearest_entry(size, spread):
    draw = np.random.default_rng(size)
    kind = object if spread > vector_codes.SMALL else np.int64
    entries, asked = (draw.integers(-spread, spread + 1, (n, 8)).astype(kind) for n in (size, 300))
    entries[size // 2] = entries[0]  # a tie
    asked[:size] = entries[:300]
    place, reach = vector_codes.nearest(vector_codes.gnat(entries), entries, asked)
    assert list(zip(place.tolist(), reach.tolist())) == plain_nearest(entries, asked)


def test_tree_leaves_out_subtrees(monkeypatch):
    draw = np.random.default_rng(3)
    entries = (draw.integers(0, 4, (256, 1)) * 10_000 + draw.integers(-50, 50, (256, 8))).astype(np.int64)
    tree, compared = vector_codes.gnat(entries), []
    plain = vector_codes.squared
    monkeypatch.setattr(vector_codes, "squared", lambda a, b: (compared.append(len(a) * len(b)), plain(a, b))[1])
    place, reach = vector_codes.nearest(tree, entries, entries + 1)
    assert sum(compared) < 256 * 256 / 2
    assert list(zip(place.tolist(), reach.tolist())) == plain_nearest(entries, entries + 1)


def test_roots_are_rounded_outwards():
    squares = np.array([x * x + d for x in (1, 2, 3, 94_906_267, 3_000_000_000) for d in (-1, 0, 1)])
    assert vector_codes._root(squares).tolist() == [isqrt(s) for s in squares.tolist()]
    up = vector_codes._root_up(squares).tolist()
    assert all(u * u >= s > (u - 1) ** 2 for u, s in zip(up, squares.tolist()) if s)


def plain_codes(rows, entries=16, parts=8, rounds=6):
    kept = [(i, [floor(Fraction(x) * 4096) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and abs(x) < inf for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(kept[0][1]) // parts
    cut = [[v[p * step:(p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c, (e, _) in zip(cut, plain_nearest(books[p], [c[p] for c in cut])):
                own[e].append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*own[e])] if e in own else old for e, old in enumerate(books[p])]
    found = [plain_nearest(books[p], [c[p] for c in cut]) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(kept[k][0], "".join(f"{f[k][0]:02x}" for f in found), sum(f[k][1] for f in found)) for k in range(len(kept))]
    totals = Counter()
    for (_, _, error), (_, _, label) in zip(out, kept):
        totals[label] += error
    longs = lambda n: n if n < 2**63 else None
    return sorted(((*row[:2], longs(row[2]), longs(totals[r[2]]) if all(o[2] < 2**63 for o, s in zip(out, kept) if s[2] == r[2]) else None, digest)
                   for row, r in zip(out, kept)), key=str)


@pytest.mark.parametrize("case", ["plain", "few", "ties", "large", "hot"])
def test_codes_equal_brute_force(spark, case):
    draw = np.random.default_rng(11)
    rows = [(i, [float(x) for x in draw.normal(0, 1, 16)], (0, 1, None)[i % 3]) for i in range(120)]
    rows += [(500, None, 0), (501, [1.0] * 15 + [None], 1), (502, [nan] * 16, 1), (503, [inf] * 16, None), (None, [0.5] * 16, None)]
    rows += [rows[0], rows[7], (7, [0.25] * 16, 2)]  # repeated rows, a repeated id
    if case == "few":
        rows = rows[:5]
    if case == "ties":
        rows = [(i, [float(x) for x in draw.choice([-0.5, 0.0, 0.5], 8)], 0) for i in range(80)]
    if case == "large":
        rows += [(600, [1e6] * 16, 0), (601, [1e30] * 16, 5), (602, [-3e8] * 16, 6)]
    if case == "hot":
        rows += [(1000 + i, [0.125] * 16, 0) for i in range(200)]
    found = vector_codes.vector_codes(vectors_of(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == plain_codes(rows)


def test_codes_of_odd_tables(spark):
    assert vector_codes.vector_codes(vectors_of(spark, [])).count() == 0
    assert vector_codes.vector_codes(vectors_of(spark, [(1, None, 0)])).count() == 0
    assert [r.code for r in vector_codes.vector_codes(vectors_of(spark, [(1, [], 0), (2, [], None)])).collect()] == ["00" * 8] * 2
    with pytest.raises(ValueError, match="components"):
        vector_codes.vector_codes(vectors_of(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)]))
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(vectors_of(spark, [(1, [1.0] * 9, 0)]))


# --- phrases ---

def plain_phrases(rows, support, top=2000, cover=80):
    counts, sizes = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for n in range(1, 5):
                counts[lang or "und"].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        f = {g: n for g, n in f.items() if n >= support}
        most = Counter()
        for g, n in f.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    most[g[i:i + size]] = max(most[g[i:i + size]], n)
        found = []
        for g, a in f.items():
            if len(g) > 1 and 100 * most[g] < cover * a:
                score, _, left, right = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, sizes[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rows = document_rows()
    rows += [(900, "New\tYork  City, new york city; NEW YORK\x0bnew york: new york! A b a b a b a b?É é É é", "und", None, 0),
             (901, "x y " * 4000 + ". x\ny\rz " * 50, None, None, 0), (902, " ,.; : \t", "en", None, 0), (903, "\x00 \x01 \x00 \x01 \x00 \x01", "en", None, 0)]
    return rows + [(1000 + i, "the very same words stand here. " + prose(i % 5, 30), ("en", "fr")[i % 2], None, 0) for i in range(60)]


@pytest.mark.parametrize("support,shards,top", [(2, 8, 2000), (3, 1, 2000), (5, 3, 7), (30, 8, 2000), (7, 50, 2000)])
def test_phrases_equal_brute_force(spark, support, shards, top):
    rows = phrase_rows()
    found = collocations.collocations(documents(spark, rows), support=support, shards=shards, top=top).collect()
    want = plain_phrases(rows, support, top)
    assert want and sorted(map(tuple, found)) == want


def test_phrases_with_a_full_bit_set(spark, monkeypatch):
    """Chance hits cost time, not results."""
    monkeypatch.setattr(collocations, "BITS", 64)
    rows = phrase_rows()
    assert sorted(map(tuple, collocations.collocations(documents(spark, rows), support=4).collect())) == plain_phrases(rows, 4)


def test_phrases_of_cut_batches(spark):
    rows, setting = phrase_rows(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        found = collocations.collocations(documents(spark, rows), support=4).collect()
    finally:
        spark.conf.set(setting, usual)
    assert sorted(map(tuple, found)) == plain_phrases(rows, 4)


def test_phrases_of_empty_tables(spark):
    assert collocations.collocations(no_documents(spark)).count() == 0
    assert collocations.collocations(documents(spark, [(1, None, None, None, None), (None, "", "en", None, 0)])).count() == 0


# --- neighbours ---

def plain_neighbours(rows, k, each=20):
    held = [(i, v) for i, v, *_ in rows if i is not None and v is not None and any(v) and all(x is not None and abs(x) < inf for x in v)]

    def score(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    out = []
    for q in sorted({i for i, _ in held if i % each == 0}):
        asked = {tuple(v) for i, v in held if i == q}
        best = sorted(((-score(a, v), i) for a in asked for i, v in held if i != q), key=lambda t: t)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


def test_neighbours_recall(spark):
    frame = table(spark, SF_MEDIUM, "embeddings")
    rows = [tuple(r) for r in frame.collect()]
    want = plain_neighbours(rows, 20)
    found = sorted(map(tuple, permutation_index.neighbours(frame, F.col("vec_id") % 20 == 0).collect()))
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert len({(q, i) for q, _, i, _ in found} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    exact = {(q, i): s for q, _, i, s in plain_neighbours(rows, len(rows))}
    assert all(exact[q, i] == s for q, _, i, s in found)


def test_neighbours_recall_with_the_share_of_a_large_part(spark):
    """Half the table out of reach: no vector beyond the share is reranked."""
    draw = np.random.default_rng(4)
    length = draw.uniform(0.5, 2, 3000)
    rows = [(i, [float(x) for x in v * n]) for i, (v, n) in enumerate(zip(draw.normal(0, 1, (3000, 16)), length))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = permutation_index.neighbours(frame, F.col("vec_id") % 100 == 0, k=10, vectors_per_part=1500, least=100, share=8).collect()
    want = {(q, i) for q, _, i, _ in plain_neighbours(rows, 10, 100)}
    assert len(found) == len(want) and len({(r.query_id, r.vec_id) for r in found} & want) >= 0.9 * len(want)


@pytest.mark.parametrize("blocks", [{}, {"queries_per_block": 3, "vectors_per_part": 11}])
def test_neighbours_on_hard_cases(spark, blocks):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.choice([-1.0, 0.0, 0.25, 0.5], 6)], 0) for i in range(130)]  # many ties
    rows += [(200, None, 0), (220, [1.0, None], 0), (240, [nan], 0), (260, [inf], 0), (280, [], 0), (300, [1e12] * 6, 0), (320, [0.0] * 6, 0),
             (300, [1e12] * 6, 0), (None, [1.0], 0), (340, [0.01], 0), (7, [0.5] * 6, 0), (7, [0.5] * 6, 0), (40, [0.5, -1.0], None)]
    rows += [(2000 + i, [0.25] * 6, 0) for i in range(150)]  # a hot vector, which would crowd out others
    found = permutation_index.neighbours(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, k=7, **blocks).collect()
    assert sorted(map(tuple, found)) == plain_neighbours(rows, 7)


def test_neighbours_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows, n in (([], 0), ([(20, [1.0])], 0), ([(20, None)], 0), ([(20, [1.0]), (40, [2.0]), (1, [0.5])], 4)):
        assert permutation_index.neighbours(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).count() == n


def test_footrule_of_prefixes():
    draw = np.random.default_rng(8)
    asked, held = (np.stack([draw.permutation(12)[:5] for _ in range(n)]).astype(np.uint16) for n in (4, 9))
    gain = permutation_index.nearness_of_prefixes(asked, permutation_index.inverted_files(held, 12), 9)

    def places(prefix):
        return [list(prefix).index(p) if p in prefix else 5 for p in range(12)]

    for q in range(4):
        for v in range(9):
            footrule = sum(abs(a - b) for a, b in zip(places(asked[q]), places(held[v])))
            assert footrule == 2 * (5 * 6 // 2 - gain[q, v])
