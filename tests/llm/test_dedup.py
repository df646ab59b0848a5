"""Exact deduplication, removal of repeated passages and the n-gram join against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tables import changed, document_rows, documents, no_documents, prose

from basketry.llm import exact_dedup, ngram_join, substring_dedup
from basketry.llm.words import U64, rolled
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def collapsed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# --- exact deduplication ---

def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[collapsed(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i))
        sha, kept = hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            stays = i == first and not kept
            kept |= stays
            out[(i, first, len(ids), stays, sha)] += 1
    return out


def test_exact_duplicates(spark):
    found = exact_dedup.exact_duplicates(documents(spark)).collect()
    assert Counter(map(tuple, found)) == exact_brute(document_rows())


def test_exact_names_that_collide_are_told_apart(spark, monkeypatch):
    real = exact_dedup._chunk
    monkeypatch.setattr(exact_dedup, "_chunk", lambda part: real(part).withField("name", F.length(part) % 2))
    found = exact_dedup.recipes(documents(spark)).select("text_sha256", F.to_json("recipe").alias("recipe")).distinct()
    assert found.count() == found.select("recipe").distinct().count() == found.select("text_sha256").distinct().count()


def test_exact_names_that_collide_merge_nothing(spark, monkeypatch):
    real = exact_dedup._chunk
    monkeypatch.setattr(exact_dedup, "_chunk", lambda part: real(part).withField("name", F.length(part) % 2))
    found = exact_dedup.exact_duplicates(documents(spark)).collect()
    assert Counter(map(tuple, found)) == exact_brute(document_rows())


def test_exact_groups_are_those_of_the_recipe(spark, monkeypatch):
    # Recipes that say too little must be noticed: the digest of the text only checks them.
    monkeypatch.setattr(exact_dedup, "_chunk", lambda part: F.struct(
        F.lit(1).cast("long").alias("name"), *[F.lit(0).cast("long").alias(c) for c in ("high", "low", "length")]))
    with pytest.raises(Exception, match="same recipe"):
        exact_dedup.exact_duplicates(documents(spark)).collect()


def test_exact_chunks_follow_content(spark):
    text = ". ".join(prose(i, 60) for i in range(40))
    rows = [(1, text, None, None, 0), (2, "An added sentence stands first. " + text, None, None, 0)]
    a, b = (set(r["recipe"]) for r in exact_dedup.recipes(documents(spark, rows)).collect())
    assert len(a) > 10 and len(a & b) >= 0.75 * len(a)


def test_exact_rows_that_stay(spark):
    docs = documents(spark)
    left = exact_dedup.without_duplicates(docs)
    assert left.columns == docs.columns
    want = Counter((i, sha) for (i, _, _, stays, sha), n in exact_brute(document_rows()).items() for _ in range(n * stays))
    got = Counter((r.doc_id, hashlib.sha256(collapsed(r.text).encode()).hexdigest()) for r in left.collect())
    assert got == want


def test_exact_empty(spark):
    assert exact_dedup.exact_duplicates(no_documents(spark)).count() == 0
    assert exact_dedup.without_duplicates(no_documents(spark)).count() == 0


def test_exact_plan_has_no_python(spark, capsys):
    exact_dedup.without_duplicates(documents(spark)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


# --- repeated passages ---

def passages_brute(rows, window):
    first = {}
    texts = [((LAST if i is None else i), i, WORD.findall(t or "")) for i, t, *_ in rows]
    for rank, _, words in texts:
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            first[w] = min(first.get(w, rank), rank)
    out = Counter()
    for rank, i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < rank:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[(i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,gram", [(50, 16), (6, 3), (20, 20)])
def test_passages(spark, window, gram):
    rows = [r for r in document_rows() if window == 50 or len(r[1] or "") < 20_000]
    found = substring_dedup.without_repeats(documents(spark, rows), window=window, gram=gram).collect()
    assert Counter(map(tuple, found)) == passages_brute(rows, window)


def test_passages_empty(spark):
    assert substring_dedup.without_repeats(no_documents(spark)).count() == 0


def test_rolling_hash_is_the_polynomial():
    values = np.arange(1, 40, dtype=U64) * U64(7919)
    for length in (1, 2, 5, 16, 31, 39):
        want = [sum(int(v) * 31 ** (length - 1 - k) for k, v in enumerate(values[i:i + length])) % 2**64
                for i in range(len(values) - length + 1)]
        assert rolled(values, length, 31).tolist() == want
    assert len(rolled(values, 40, 31)) == 0


def test_equal_windows_share_an_anchor():
    draw = np.random.default_rng(3)
    grams = draw.integers(0, 50, 400).astype(U64)
    other = np.concatenate([draw.integers(0, 50, 33).astype(U64), grams[100:160]])
    here, there = (substring_dedup.anchor_places(g, 35) for g in (grams, other))
    for start in range(60 - 35 + 1):
        a = {int(p) - 100 for p in here if 100 + start <= p < 100 + start + 35}
        b = {int(p) - 33 for p in there if 33 + start <= p < 33 + start + 35}
        assert a & b


# --- n-gram join ---

def ngrams(text):
    words = WORD.findall(text or "")
    n = min(5, len(words))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def join_brute(rows):
    """Per row: (doc_id, class_id, n_links, class_size)."""
    sets = [ngrams(r[1]) for r in rows]
    name, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                name[max(root(i), root(j))] = min(root(i), root(j))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(i)
    smallest = {k: min((rows[i][0] for i in v), key=lambda d: (d is None, d)) for k, v in members.items()}
    return Counter((rows[i][0], smallest[root(i)], links[i], len(members[root(i)])) for i in range(len(rows)))


def near_rows():
    """A large family of near copies, and pairs on either side of the threshold."""
    base, draw = prose(50, 150), np.random.default_rng(2)
    rows = [(100 + i, changed(base, *draw.integers(5, 145, 1 + i % 5).tolist()), None, None, 0) for i in range(60)]
    for i, n in enumerate((2, 3, 4, 5, 6)):
        text = prose(60 + i, 100)
        rows += [(300 + 2 * i, text, None, None, 0), (301 + 2 * i, changed(text, *range(7, 7 + 10 * n, 10)), None, None, 0)]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_join(spark, block):
    rows = document_rows() + near_rows()
    found = ngram_join.joined(documents(spark, rows), block=block).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links, r.class_size) for r in found) == join_brute(rows)
    assert sum(r.stays for r in found) == pytest.approx(sum(1 / r.class_size for r in found))  # one of each class


def test_join_rows_that_stay(spark):
    rows = document_rows() + near_rows()
    docs = documents(spark, rows)
    left = ngram_join.one_of_each_class(docs)
    assert left.columns == docs.columns
    stay = [r for r in ngram_join.joined(docs).collect() if r.stays]
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in stay)


def test_join_empty(spark):
    assert ngram_join.joined(no_documents(spark)).count() == 0
    assert ngram_join.one_of_each_class(no_documents(spark)).count() == 0


def test_posterior_bound():
    """The bound drops pairs only where the posterior mass above the threshold is below the tolerance."""
    draw = np.random.default_rng(0)
    for n in (32, 96, 160):
        m = ngram_join.fewest_matches(n, 0.8, 1e-3)
        for matches, low in ((m - 1, True), (m, False)):
            mass = (draw.beta(matches + 1, n - matches + 1, 400_000) >= 0.8).mean()
            assert (mass < 1.3e-3) if low else (mass > 0.7e-3)


def test_overlaps_agree():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, 80).astype(U64)) for _ in range(30)]
    x, y = (g.ravel() for g in np.meshgrid(np.arange(30), np.arange(30)))
    many = ngram_join.overlaps(sets, sets, x, y)
    one = [ngram_join.overlaps(sets, sets, x[k:k + 1], y[k:k + 1])[0] for k in range(0, 900, 17)]
    assert many[::17].tolist() == [int(n) for n in one]


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(2, 1), (1, 2), (2, 1)], [(i, i + 1) for i in range(40)], [(i + 1, i) for i in range(0, 40, 2)],
    [(0, i) for i in range(1, 60)], [(59, i) for i in range(59)], [(i, i % 7 + 100) for i in range(60)] + [(100, 106), (3, 104)],
    [(a, b) for a in range(8) for b in range(a)] + [(20, 21), (21, 22), (22, 20), (30, 7)]])
def test_components(spark, edges):
    from basketry.llm.components import components

    roots = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in roots:
        for a, b in edges:
            if a != b:
                roots[a] = roots[b] = min(roots[a], roots[b])
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted(roots.items())


def test_members_of_a_large_group_stay_out_of_the_rounds(spark, monkeypatch):
    """1,000 nodes with 8 edges each to the same leaders."""
    from basketry.llm import components as module

    seen, plain = [], module._core
    monkeypatch.setattr(module, "_core", lambda edges: (seen.append(edges.count()), plain(edges))[1])
    edges = spark.range(1000).selectExpr("id + 100 as a", "explode(sequence(1L, 8L)) as b")
    assert {r.component for r in module.components(edges).collect()} == {1}
    assert seen == [7]
