"""Language identification, archives, URL rules, mixing, packing, token files and search."""

import base64
import gzip
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_MEDIUM, SF_SMALL
from pyspark.sql import functions as F
from tables import CLASHING, WORDS, document_rows, documents, no_documents, prose
from tokenizers import Tokenizer

from basketry.llm import files, language_id, mixing, packing, token_files, topk, url_rules, warc
from basketry.llm.oracle import oracle_sql
from basketry.llm.shared import table
from basketry.llm.tokens import Encoder, strings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "a", " a", "a ", "a  b", "a   b  ", "\n a", "a\n b", "a \n b", "\u00a0 a \u00a0b", "it's 'tis 12345 ,, x", "日本語 テキスト。 ok",
       "x" * 500, "e\u0301 \u0308 ΣΑΣ Σ", "a\u2003 b\u2003", "tab\tand\x0bvt", "🙂 🙂🙂", "\x1c a \x85 b", None, prose(1, 300)]


# --- language identification ---

def test_language_accuracy(spark):
    docs = table(spark, SF_MEDIUM, "documents")
    found = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all()
    want = [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]
    assert found["held_out"].tolist() == want
    assert found["rejected"].mean() < 0.01  # prose of the known languages is kept


def test_language_ignores_labels_of_what_it_predicts(spark):
    docs = table(spark, SF_SMALL, "documents")
    blind = docs.withColumn("lang", F.when(~language_id.held_out(), F.col("lang"))).withColumn("source", F.lit("x"))
    a, b = (language_id.languages(d).orderBy("doc_id").collect() for d in (docs, blind))
    assert a == b


def test_language_hard_cases(spark):
    docs = documents(spark)
    found = language_id.languages(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
    by_text = {r.doc_id: r for r in found}
    for doc_id, text, *_ in document_rows():
        if doc_id is not None:
            assert (by_text[doc_id].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
            assert by_text[doc_id].rejected or by_text[doc_id].lang_pred != "und"
    kept = language_id.in_known_language(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if not r.rejected)


def test_language_rejects_what_is_far(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = language_id.fit(docs, ~language_id.held_out())
    assert model.nearest("ϗϙϛ Ωϝϟ ψϡϣ " * 100)[2]
    assert not model.nearest(docs.first().text)[2]


def test_language_empty_and_unlabelled(spark):
    assert language_id.languages(no_documents(spark)).count() == 0
    plain = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    found = language_id.languages(plain).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert {r.rejected for r in found} == {True, False}  # texts with letters are kept


def test_language_training_is_bounded(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = language_id.fit(docs, F.lit(True), texts=5, k=3)
    assert max(Counter(model.labels).values()) <= 3 and set(model.labels) == {"en", "de", "fr", "es"}


def plain_grams(text, bits):
    """Hashes of the 2- and 3-grams, and the number of letters, in whole numbers of 32 bits."""
    whole, kept = f" {text.lower()} ", []
    for i, c in enumerate(whole):
        if c.isalpha():
            kept.append(ord(c))
        elif i == 0 or whole[i - 1].isalpha():
            kept.append(32)
    cut, out = 2**32 - 1, []
    for n in (2, 3):
        for i in range(len(kept) - n + 1):
            h = (kept[i] * 0x9E3779B1 + kept[i + 1] * 0x85EBCA77) & cut
            if n == 3:
                h = (h * 0xC2B2AE3D + kept[i + 2] * 0x27D4EB2F) & cut
            out.append((((h ^ (h >> 15)) * 0x2C1B3C6D) & cut) >> (32 - bits))
    return out, sum(map(str.isalpha, whole))


def test_language_is_that_of_the_nearest_centroid(spark):
    """Plain nearest centroid: TF-IDF by dictionaries, cosines one by one."""
    rows = document_rows() + [(1000 + i, t, "en", "a", 0) for i, t in enumerate(ODD)]
    docs = documents(spark, rows)
    model = language_id.fit(docs, ~language_id.held_out(), texts=20, k=3)
    found = language_id.identified(docs.select("doc_id", "text"), model, ["doc_id", "text"]).collect()
    bits = language_id.FEATURE_BITS
    centroids = [{f: float(x) for f, x in enumerate(column) if x} for column in model.centroids.T]
    assert len(found) == len(rows) and len(centroids) > 2
    for r in found:
        grams, letters = plain_grams(r.text or "", bits)
        if not letters:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        weights = {g: (1 + np.log(n)) * model.idf[g] for g, n in Counter(grams).items()}
        length = sum(w * w for w in weights.values()) ** 0.5
        cosines = [sum(w * c.get(g, 0.0) for g, w in weights.items()) / length for c in centroids]
        best = max(cosines)
        near = {model.labels[i] for i, c in enumerate(cosines) if c > best - 1e-9}
        assert r.lang_pred in near and r.score == pytest.approx(min(1.0, max(0.0, best)), abs=1e-9)
        bounds = [model.far[i] * min(1.0, (letters / language_id.FULL_LETTERS) ** 0.5) for i, c in enumerate(cosines) if c > best - 1e-9]
        assert r.rejected in {best < b for b in bounds}


def test_language_trains_on_the_smallest_hashes(spark):
    labelled = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
                                        F.when(F.col("id") % 4 == 1, "de").otherwise("en").alias("lang"))
    labelled = labelled.unionByName(spark.createDataFrame([(7, "es")] * 500 + [(1, "fr"), (2, "fr")], "id long, lang string"))
    found = defaultdict(list)
    for r in language_id.training_ids(labelled, 50).collect():
        found[r.lang].append(r.id)
    hashed = defaultdict(set)
    for r in labelled.select("id", "lang", F.xxhash64("id", "lang", F.lit(7)).alias("hash")).collect():
        hashed[r.lang].add((r.hash, r.id))
    assert {lang: sorted(ids) for lang, ids in found.items()} == {
        lang: sorted(i for _, i in sorted(all_)[:50]) for lang, all_ in hashed.items()}


def test_language_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    rows = [(i % 3, prose(i, 30), "en", "a", 0) for i in range(90)]
    made, staged = {}, language_id.staged
    monkeypatch.setattr(language_id, "staged", lambda frame, name: made.setdefault(name, staged(frame, name)))
    assert language_id.fit(documents(spark, rows), F.lit(True), texts=5)
    assert made["language-sample"].count() == 5


# --- archives ---

def pages(spark, rows, clashing=True):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ["row", "sha1", "size", "first", "copy", "known", "none", "record_type", "path", "given", "tokens", "host"]
    return frame.withColumns({c: F.lit(1) for c in names}) if clashing else frame


PAGES = [(5, "http://a.org/x y\r\nz", "same"), (3, "http://b.org/", "same"), (9, None, "same"), (9, None, "same"), (1, "http://c", None),
         (2, "http://d", ""), (4, "http://e", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (None, "http://f", "same"), (None, None, "own"),
         (None, None, "own"), (6, "http://g/é", "é" * 400_000), (7, "http://h", "é" * 400_000)]


def archived(rows, least):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    out = Counter()
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first, seen = min(ids, key=lambda i: (i is None, i)), False
        for i in ids:
            response = len(payload) < least or (i == first and not seen)
            seen |= response
            out[(i, len(payload), digest, "response" if response else "revisit", None if response else first)] += 1
    return out


@pytest.mark.parametrize("least", [0, 1, 1000])
def test_archives(spark, least):
    found = warc.archived_pages(pages(spark, PAGES), least=least)
    assert Counter(map(tuple, found.collect())) == archived(PAGES, least)


def test_archive_files(spark, folder):
    rows = warc.resolved(pages(spark, PAGES))
    manifest = warc.write_archives(rows, f"file://{folder}/archives", file_bytes=500)
    assert manifest.count() > 1  # files roll over
    texts = [gzip.decompress(files.read(r.path).read()) for r in manifest.collect()]
    assert sum(t.count(b"WARC-Type: response") for t in texts) == 5
    heads = b"".join(texts)
    assert heads.count(b"WARC-Refers-To: <urn:uuid:") == len(PAGES) - 5
    assert b"WARC-Target-URI: http://a.org/x%20y%0D%0Az\r\n" in heads
    back = warc.read_archives(manifest).collect()
    ids = [r.record_id for r in back]
    assert len(set(ids)) == len(ids) == len(PAGES)
    responses = {r.record_id: r for r in back if r.record_type == "response"}
    for r in back:
        if r.record_type == "revisit":
            assert r.payload == b"" and responses[r.refers_id].payload_digest == r.payload_digest
        else:
            assert warc.digest_of(bytes(r.payload)) == r.payload_digest and len(r.payload) == r.payload_bytes


@pytest.mark.parametrize("least", [0, 1])
def test_archives_of_identical_rows(spark, least):
    rows = [(None, None, None)] * 40 + [(8, "http://x", "body")] * 40 + [(i, "http://y", "body" if i % 2 else f"own {i}") for i in range(40)]
    made = pages(spark, rows).repartition(7)
    assert Counter(map(tuple, warc.archived_pages(made, least=least).collect())) == archived(rows, least)
    resolved = warc.resolved(made, least=least).collect()
    numbers = [(r.page_id, r.sha1, r["copy"]) for r in resolved]
    assert len(set(numbers)) == len(numbers) == len(rows)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in resolved)


def test_damaged_archive_is_noticed():
    good = warc.record("response", "0" * 8, 1, "u", "d", warc.digest_of(b"abc"), 3, b"abc", None)
    assert warc.parsed(gzip.decompress(good))["payload"] == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(gzip.decompress(good).replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="ends"):
        list(warc.members(pa.BufferReader(good[:-9])))


def test_archives_empty(spark):
    assert warc.archived_pages(pages(spark, [])).count() == 0


# --- URL rules ---

def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def brute_rule(host, path):
    fits = [r for r in url_rules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def brute_tokens(url, host, path):
    query = re.match(r"[^#]*?\?([^#]*)", url or "", re.S)
    keys = [q.split("=")[0] for q in query.group(1).split("&")] if query else []
    return {f"{k}:{t}" for k, ts in (("host", host.split(".")), ("path", path.split("/")), ("query", keys)) for t in ts if t}


def brute_judged(rows):
    seen = []
    for page, url, *_ in rows:
        host, path = brute_host_path(url)
        seen.append((page, host, path, brute_rule(host, path), brute_tokens(url, host, path)))
    known = [(tokens, r.verdict) for *_, r, tokens in seen if r]
    n, blocks = Counter(t for ts, _ in known for t in ts), Counter(t for ts, v in known if v == "block" for t in ts)
    overall = blocks_all = sum(v == "block" for _, v in known)
    frequent = [t for t in n if n[t] >= url_rules.SUPPORT * len(known)]
    frequent.sort(key=lambda t: (-abs(blocks[t] / n[t] - overall / len(known)), -n[t], t))
    del blocks_all
    place = {t: i for i, t in enumerate(frequent)}
    holds, says = Counter(), Counter()
    for tokens, verdict in known:
        items = [t for t in tokens if t in place]
        for k in range(1, len(items) + 1):
            for part in itertools.combinations(sorted(items), k):
                holds[part] += 1
                says[(part, verdict)] += 1
    need = url_rules.SUPPORT * len(known)
    rules = {k: c / holds[k[0]] for k, c in says.items() if c >= need and c / holds[k[0]] >= url_rules.CONFIDENCE}
    rules = {(part, v): c for (part, v), c in rules.items()
             if not any(rules.get((sub, v), 0) >= c for k in range(1, len(part)) for sub in itertools.combinations(part, k))}
    out = Counter()
    for page, host, path, rule, tokens in seen:
        best = None
        if not rule:
            fits = [((-c, -says[(part, v)], -len(part), v != "allow", part), v, part) for (part, v), c in rules.items() if tokens >= set(part)]
            best = min(fits, default=None)
        out[(page, host, path, rule and rule.text, rule.verdict if rule else best[1] if best else "allow", best and best[2])] += 1
    return out


def test_url_rules(spark):
    source = table(spark, SF_MEDIUM, "pages").select("page_id", "url")
    odd = [(900001, None), (900002, "no scheme/x"), (900003, "HTTP://WWW.Example.ORG"), (900004, "http://notexample.org/es/x"),
           (900005, "http://x.example.org/es/?a=1&b#c"), (900006, "http://É.ORG/?q"), (900007, "s://h#f://g/x"), (None, "://com/de/"),
           (900008, "http://a.com:80/de/"), (900009, "http://z.net/" + "/".join(WORDS * 100)), (900009, "http://z.net/" + "/".join(WORDS * 100)),
           (900010, "http://org/\nx?y")]
    rows = [tuple(r) for r in source.collect()] + odd
    found = url_rules.judged(pages(spark, [(*r, None) for r in rows])).collect()
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict, r.mined and tuple(r.mined)) for r in found)
    assert got == brute_judged(rows)
    assert any(r.mined for r in found) and {r.verdict for r in found} == {"allow", "block"}


def test_url_copies_of_a_long_url_do_not_explode(spark):
    rows = [(i, "http://x.example.org/es/" + "/".join(f"s{k}" for k in range(60)), None) for i in range(50)]
    rows += [(100 + i, f"http://y.net/es/{i}", None) for i in range(5)]
    assert {r.verdict for r in url_rules.judged(pages(spark, rows)).collect()} == {"block"}


def brute_mined(known, longest, support=url_rules.SUPPORT, confidence=url_rules.CONFIDENCE):
    """All rules on whole URLs that no part makes idle."""
    holds, says = Counter(), Counter()
    for tokens, verdict in known:
        for k in range(1, longest + 1):
            for part in itertools.combinations(sorted(tokens), k):
                holds[part] += 1
                says[(part, verdict)] += 1
    rules = {(p, v): c / holds[p] for (p, v), c in says.items() if c >= support * len(known) and c / holds[p] >= confidence}
    return {(p, v, c, says[(p, v)] / len(known)) for (p, v), c in rules.items()
            if not any(rules.get((sub, v), 0) >= c for k in range(1, len(p)) for sub in itertools.combinations(p, k))}


def mined(spark, known, **options):
    labelled = spark.createDataFrame([(list(t), v) for t, v in known], "tokens array<string>, verdict string")
    return {(tuple(r.antecedent), r.verdict, r.confidence, r.support) for r in url_rules.mined_rules(labelled, **options).collect()}


def test_url_rules_count_whole_urls(spark):
    # 12 tokens tell more than "t", which is cut out of the URLs that speak against it when 10 are kept.
    telling = [f"a{i:02d}" for i in range(12)]
    known = [((*telling, "t"), "block")] * 30 + [(("t", "u"), "allow")] * 100 + [((f"b{i}", "u"), "block") for i in range(40)]
    found = mined(spark, known)
    assert found == brute_mined(known, 13)
    assert not [r for r in found if r[0] == ("t",)]


@pytest.mark.parametrize("seed", range(2))
def test_url_rules_of_random_urls(spark, seed):
    draw = np.random.default_rng(seed)
    known = []
    for _ in range(120):
        tokens = tuple(f"t{i:02d}" for i in np.flatnonzero(draw.random(13) < 0.85))
        known.append((tokens, "block" if "t00" in tokens and "t01" in tokens or draw.random() < 0.05 else "allow"))
    assert mined(spark, known, support=0.02) == brute_mined(known, 13, support=0.02)


def test_url_rules_of_many_tokens(spark):
    # Each three of the four tokens are allowed as often as all four are blocked.
    four = ("a", "b", "c", "d")
    known = [(four, "block")] * 20 + [(part, "allow") for part in itertools.combinations(four, 3)] * 20
    assert (four, "block", 1.0, 0.2) in mined(spark, known)


def test_url_empty_and_unlabelled(spark):
    assert url_rules.judged(pages(spark, [])).count() == 0
    assert {r.verdict for r in url_rules.judged(pages(spark, [(1, "http://a.net/", None), (2, None, None)])).collect()} == {"allow"}


def test_url_plan_has_no_python(spark, capsys):
    url_rules.judged(pages(spark, [(1, "http://a.org/", None)])).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_url_rules_need_no_python_in_the_workers(spark, monkeypatch):
    source = table(spark, SF_SMALL, "pages")
    expected = Counter(map(str, url_rules.judged(source).collect()))
    monkeypatch.setattr(spark.sparkContext, "pythonExec", "/no/such/python")
    with pytest.raises(Exception):  # noqa: B017
        spark.sparkContext.parallelize([1]).map(str).collect()
    assert Counter(map(str, url_rules.judged(source).collect())) == expected
    assert url_rules.judged(source.filter("false")).count() == 0


def test_url_kinds_of_mixed_tokens_do_not_explode(spark):
    # Forty query keys that always come together, with both verdicts; with "k" they block.
    keys = tuple(f"q{i:02d}" for i in range(40))
    known = [((*keys, "k"), "block")] * 20 + [(keys, "allow")] * 20 + [(("k",), "allow")] * 20 + [((), "allow")] * 5
    found = mined(spark, known)
    assert found == {((*sorted((q, "k")),), "block", 1.0, 20 / 65) for q in keys}


# --- mixing ---

def test_apportionment_is_by_highest_quotients():
    draw = np.random.default_rng(4)
    for case in range(40):
        votes = draw.integers(0, 1000, draw.integers(1, 12)).astype(float)
        if case % 4 == 0:
            votes[:] = votes[0]  # ties
        seats = int(draw.integers(0, 60))
        want = np.zeros(len(votes), int)
        for _ in range(seats if votes.sum() else 0):
            want[max(range(len(votes)), key=lambda i: (Fraction(int(votes[i])) / (2 * int(want[i]) + 1), -i))] += 1
        assert mixing.apportioned(votes, seats).tolist() == want.tolist()


def brute_targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("rows_per_shard", [2048, 7])
def test_mixing(spark, rows_per_shard):
    docs = table(spark, SF_SMALL, "documents").unionByName(
        documents(spark, clashing=False).filter("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 10_000))
    found = mixing.mixed(docs, rows_per_shard=rows_per_shard).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size + sum(x.last - x.first for x in r.ranges)
        assert all(0 <= x.first < x.last <= r.size for x in r.ranges)
    assert len(found) == docs.count() and all(r.source_size == sizes[source[r.doc_id]] for r in found)
    want = brute_targets(dict(sizes))
    assert target == pytest.approx(want, rel=1e-9)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * 16 * (1 if rows_per_shard > 1000 else 20)
    again = mixing.mixed(docs.repartition(5), rows_per_shard=rows_per_shard).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_mixing_caps(spark):
    rows = [(i, prose(i, 10), None, s, 0) for i, s in enumerate("abbbbbbbbbbbbbbbbbbbbbbbbbbbbccccccc")]
    found = {r.doc_id: r for r in mixing.mixed(documents(spark, rows)).collect()}
    assert found[0].target == 30 and found[0].taken == 30 and found[0].copies == 3


@pytest.mark.parametrize("words", [2, 18])
def test_mixing_does_not_round_by_shard(spark, words):
    rows = [(i, prose(i, words), None, "a", 0) for i in range(60)] + [(100 + i, prose(i, 400), None, "b", 0) for i in range(40)]
    rows += [(200 + i, prose(i, words), None, "c", 0) for i in range(160)]
    source = {r[0]: r[3] for r in rows}
    found = mixing.mixed(documents(spark, rows), rows_per_shard=1).collect()
    taken, target, size = Counter(), {}, {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]], size[source[r.doc_id]] = r.target, r.source_size
    assert target["a"] == 3 * size["a"] and taken["a"] == target["a"]
    assert all(abs(taken[s] - target[s]) <= 2 * 16 for s in target)


def brute_taken(rows, source, shards, block=16, most=3):
    """(doc_id, taken) of each row: the line of each source word by word; hashes and targets are those of ``rows``."""
    names = sorted({source[r.doc_id] for r in rows}, key=lambda s: (s is None, s or ""))
    target = {source[r.doc_id]: r.target for r in rows}
    seats, won = round(sum(target.values()) / block), dict.fromkeys(names, 0)
    for _ in range(seats):
        won[max(names, key=lambda s: (Fraction(target[s]) / (2 * won[s] + 1), -names.index(s)))] += 1
    out, quota_of = Counter(), {}
    for place, name in enumerate(names, 1):
        line = sorted((r for r in rows if source[r.doc_id] == name),
                      key=lambda r: (r.spread % shards, r.spread, str(r.doc_id), r.size))
        words = [(i, r.spread % shards) for i, r in enumerate(line) for _ in range(r.size)]
        whole = most if target[name] >= most * len(words) else min(most, won[name] * block // len(words))
        blocks = -(-len(words) // block)
        more = 0 if whole == most else min(blocks, round((won[name] * block - whole * len(words)) / block))
        taken = [whole * r.size for r in line]
        owner = defaultdict(list)
        for b in range(blocks):
            owner[words[b * block][1]].append(b)
        nearest = lambda b: int(Fraction(more * b, blocks) + Fraction(1, 2))  # noqa: E731, B023
        for shard, own in owner.items():
            quota = quota_of[name, shard] = nearest(own[-1] + 1) - nearest(own[0])
            for b in np.random.default_rng([mixing.SEED, place, shard]).choice(len(own), quota, replace=False, shuffle=False):
                for i, _ in words[(own[0] + b) * block:(own[0] + b + 1) * block]:
                    taken[i] += 1
        assert sum(q for (s, _), q in quota_of.items() if s == name) == more
        out.update((r.doc_id, t) for r, t in zip(line, taken, strict=True))
    return out


@pytest.mark.parametrize("rows_per_shard", [1, 9, 2048])
def test_mixing_takes_the_blocks_of_the_line(spark, rows_per_shard):
    rows = [(i, prose(i, (3, 40, 7, 0, 150)[i % 5]), None, ("a", "b", "b", None, "c", "c", "c")[i % 7], 0) for i in range(140)]
    found = mixing.mixed(documents(spark, rows, clashing=False), rows_per_shard=rows_per_shard).collect()
    want = brute_taken(found, {r[0]: r[3] for r in rows}, -(-len(rows) // rows_per_shard))
    assert Counter((r.doc_id, r.taken) for r in found) == want


def test_mix_has_the_words_taken(spark):
    docs = documents(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got, want = Counter(), Counter()
    for r in out.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    for r in mixing.mixed(docs).collect():
        if r.taken:
            want[r.doc_id] += r.taken
    assert got == want


def test_mixing_splits_identical_rows(spark, monkeypatch):
    rows = [(None, "one two three four five", None, "a", 0)] * 60 + [(i, prose(i, 20), None, "ab"[i % 2], 0) for i in range(120)]
    seen, first = {}, mixing.shard_quotas
    monkeypatch.setattr(mixing, "shard_quotas", lambda dealt, block: first(seen.setdefault("dealt", dealt), block))
    found = mixing.mixed(documents(spark, rows), rows_per_shard=20).collect()
    per_shard = [r["count"] for r in seen["dealt"].groupBy("shard").count().collect()]
    assert len(found) == 180 and max(per_shard) < 45 and len(per_shard) > 6
    for target, taken in {(r.target, sum(s.taken for s in found if s.target == r.target)) for r in found}:
        assert abs(taken - target) <= 2 * mixing.BLOCK_WORDS
    assert all(r.taken <= 3 * r.size for r in found)


def test_mixing_empty(spark):
    assert mixing.mixed(no_documents(spark)).count() == mixing.mix(no_documents(spark)).count() == 0
    blank = documents(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])
    assert [(r.size, r.target, r.taken) for r in mixing.mixed(blank).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(blank).count() == 0


# --- tokens ---

@pytest.mark.parametrize("path,spaced", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_pieces_encode_as_whole_texts(path, spaced, monkeypatch):
    whole = Tokenizer.from_file(path)
    texts = ODD + [r[1] for r in document_rows()]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    own = Encoder(path, spaced)
    assert [i.tolist() for i in own.encode(pa.array(texts, pa.string()))] == want
    monkeypatch.setattr("basketry.llm.tokens.MEMORY", 3)  # what was learned is forgotten again and again
    assert [i.tolist() for t in texts for i in own.encode(pa.array([t], pa.string()))] == want
    assert own.encode(pa.array([], pa.string())) == []


def ids_of(path, rows):
    whole = Tokenizer.from_file(path)
    return [(r[0], np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")) for r in rows]


def test_token_files(spark):
    rows = document_rows() + [(1000 + i, t, None, None, None) for i, t in enumerate(ODD)]
    found = token_files.token_digests(documents(spark, rows), BYTE_BPE).orderBy("start").collect()
    want = ids_of(BYTE_BPE, rows)
    assert [r.doc_id for r in found] == sorted((i for i, _ in want), key=lambda i: (i is not None, i or 0))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i, len(a), zlib.crc32(a)) for i, a in want)
    assert [r.start for r in found] == [0, *itertools.accumulate(r.n_tokens for r in found)][:-1]


def test_token_files_by_offset(spark, folder):
    rows = [r for r in document_rows() if r[0] is not None]
    docs = documents(spark, rows).select("doc_id", "text")
    content = token_files.train(docs, BYTE_BPE, True, 2)
    manifest = token_files.write_token_files(docs, f"file://{folder}/t", BYTE_BPE, True, 2, content, file_bytes=2000)
    assert manifest.count() > 1
    want = dict(ids_of(BYTE_BPE, rows))
    for r in manifest.collect():
        reader = token_files.Reader(r.path, content)
        for doc_id in reader.ids.tolist():
            assert reader.find(doc_id).tolist() == want[doc_id].tolist()
        assert reader.find(-5) is None
        with pytest.raises(ValueError, match="another dictionary"):
            token_files.Reader(r.path, content + b"x")
    with pytest.raises(ValueError, match="is not a token file"):
        (path := files.new_name(folder, ".x"), (out := files.create(path)).write(b"x" * 80), out.close(), token_files.Reader(path, content))


def test_dictionary_helps_short_documents():
    import zstandard

    texts = pa.array([prose(i, 40) for i in range(3000)])
    ids = [token_files.serialised(i, 2) for i in Encoder(BYTE_BPE, True).encode(texts)]

    content = token_files.trained(ids[:2000])
    small = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content))
    plain = zstandard.ZstdCompressor()
    assert sum(len(small.compress(i)) for i in ids[2000:]) < 0.8 * sum(len(plain.compress(i)) for i in ids[2000:])


def test_token_files_empty(spark):
    assert token_files.token_digests(no_documents(spark), BYTE_BPE).count() == 0


def test_mix_splits_a_text_once(spark, capsys):
    """The words of a text that is cut into many ranges are a column, not an expression of each range."""
    mixing.mix(documents(spark, [(1, prose(1, 3000), None, "a", 0), (2, prose(2, 3000), None, "b", 0)])).explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    inside = [line for line in optimized.splitlines() if "lambdafunction" in line]
    assert inside and not any("regexp_extract_all" in line and "slice(" in line for line in inside)


# --- packing ---

@pytest.mark.parametrize("window,rows_per_slice", [(4096, 2048), (64, 9)])
def test_packing(spark, window, rows_per_slice):
    rows = [r for r in document_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values()) + [(1000 + i, t, None, "b", None) for i, t in enumerate(ODD)]
    found = packing.packed(documents(spark, rows), WORD_BPE, window=window, rows_per_slice=rows_per_slice).collect()
    covered, sequences = defaultdict(list), defaultdict(list)
    want = dict(ids_of(WORD_BPE, rows))
    for r in found:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length])
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, total in [(sorted(covered[i]), len(a)) for i, a in want.items()] + [(sorted(s), None) for s in sequences.values()]:
        at = 0
        for start, length in parts:
            assert start == at
            at += length
        assert at == total if total is not None else at == window or (at < window and at & (at - 1) == 0)


def replayed(rows, window):
    """Deficit round-robin over the queues of one slice, id by id, in fractions: {(doc, at): (sequence, offset)}.

    ``rows``: (doc_id, source, ids) in the order of their queues.
    """
    queues = defaultdict(list)
    for doc, source, ids in rows:
        queues[source] += [(doc, at) for at in range(ids)]
    names = sorted(queues, key=lambda s: (s is None, s or ""))
    total = sum(map(len, queues.values()))
    share = {s: Fraction(len(queues[s]), total) for s in names}
    deficit, placed, sequence, rest = dict.fromkeys(names, Fraction(0)), {}, 0, total
    while rest:
        length = window
        while length > rest:
            length = length // 2 if length < window else 1 << (rest.bit_length() - 1)
        take = dict.fromkeys(names, 0)
        for s in names:
            deficit[s] += share[s] * length
        for s in sorted(names, key=lambda s: -deficit[s]):
            take[s] = max(0, min(len(queues[s]), int(deficit[s]), length - sum(take.values())))
        while (room := length - sum(take.values())):
            able = sorted((s for s in names if len(queues[s]) > take[s]), key=lambda s: take[s] - deficit[s])
            if room < len(able):
                for s in able[:room]:
                    take[s] += 1
                continue
            whole = sum(share[s] for s in able)
            for s in able:
                take[s] += min(max(1, int(room * share[s] / whole)), len(queues[s]) - take[s], length - sum(take.values()))
        offset = 0
        for s in names:
            for key in queues[s][:take[s]]:
                placed[key] = (sequence, offset)
                offset += 1
            deficit[s] -= take[s]
            del queues[s][:take[s]]
        sequence, rest = sequence + 1, rest - length
    return placed


@pytest.mark.parametrize("window", [64, 256])
def test_packing_replays_the_round_robin(spark, window):
    """Sources hold powers of two of the ids, so that shares are exact in both."""
    sizes = {"a": (512, [200, 56, 256]), "b": (256, [100, 156]), None: (256, [1, 15, 240])}
    frame, doc = [], 0
    for source, (held, parts) in sizes.items():
        assert held == sum(parts)
        for n in parts:
            frame.append((doc, source, n))
            doc += 1
    width = 2
    ids = {d: np.arange(n, dtype="<u2") for d, _, n in frame}
    docs = pa.table({"doc_id": pa.array([d for d, *_ in frame], pa.int64()), "source": pa.array([s for _, s, _ in frame]),
                     "spread": pa.array([7 * d for d, *_ in frame], pa.int64()), "tokens": pa.array([n for *_, n in frame], pa.int64()),
                     "ids": pa.array([ids[d].tobytes() for d, *_ in frame], pa.binary()),
                     "slice": pa.array([0] * len(frame), pa.int64())})
    cells = pa.Table.from_pylist([{"source": s, "share": held / 1024, "deficit": 0.0} for s, (held, _) in sizes.items()])
    found = {}
    for r in packing.packed_slice(docs, cells, window, width).to_pylist():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.astype("<u4"))
        for i in range(r["length"]):
            found[(r["doc_id"], r["start"] + i)] = (r["sequence_id"], r["offset"] + i)
    assert found == replayed(frame, window)


def test_identical_rows_are_packed_and_written_once_each(spark):
    rows = [(None, None, None, "a", 0)] * 50 + [(5, "one two", None, "b", 0)] * 50 + [(i, prose(i, 20), None, "a", 0) for i in range(50)]
    docs, want = documents(spark, rows).repartition(5), ids_of(WORD_BPE, rows)
    found = packing.packed(docs, WORD_BPE, window=64, rows_per_slice=10).collect()
    per_doc = Counter()
    for r in found:
        per_doc[r.doc_id] += r.length
    totals = Counter()
    for doc, a in want:
        totals[doc] += len(a)
    assert per_doc == totals
    slices_of_copies = {r.sequence_id >> 32 for r in found if r.doc_id == 5}
    assert len(slices_of_copies) > 3  # 50 copies fill several slices of ten
    written = token_files.token_digests(docs, BYTE_BPE).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in written) == Counter(
        (i, len(a), zlib.crc32(a)) for i, a in ids_of(BYTE_BPE, rows))
    starts = sorted((r.start, r.n_tokens) for r in written)
    assert [s for s, _ in starts] == [0, *itertools.accumulate(n for _, n in starts)][:-1]


def test_windows_keep_their_proportions():
    left = [6000, 3000, 1000]
    total, start = sum(left), [-37.0, 25.0, 12.0]
    deficit, given = list(start), np.zeros(3)
    for k, take in enumerate(packing.quotas(list(left), [n / total for n in left], deficit, packing.window_lengths(total, 500))):
        given += take
        if k == 5:  # what a queue is short of is made up for in the next windows
            assert given == pytest.approx([3000 * n / 10_000 + s for n, s in zip(left, start)], abs=2)
    assert given.tolist() == left


def test_mixture_holds_in_every_window(spark):
    docs = table(spark, SF_MEDIUM, "documents")
    found = packing.packed(docs, WORD_BPE).join(docs.select("doc_id", "source"), "doc_id")
    full = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n = 4096")
    per = found.join(full, "sequence_id").groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).groupBy("source").agg(
        F.expr("percentile_approx(n, 0.5)").alias("n")).toPandas().set_index("source")["n"]
    share = found.groupBy("source").agg(F.sum("length").alias("n")).toPandas().set_index("source")["n"]
    assert ((per / 4096 - share / share.sum()).abs() < 0.002).all()


def test_repeated_ids_and_empty_table(spark):
    rows = [(1, "one two", None, None, 0)] * 3 + [(None, "x", None, None, 0), (None, None, None, "a", None)]
    found = packing.packed(documents(spark, rows), WORD_BPE).collect()
    assert sum(r.length for r in found) == sum(len(a) for _, a in ids_of(WORD_BPE, rows))
    assert packing.packed(no_documents(spark), WORD_BPE).count() == 0


# --- search ---

def test_top_k(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.choice([-1.0, 0.0, 0.25, 0.5], 6)], 0) for i in range(130)]  # many ties
    rows += [(200, None, 0), (220, [1.0, None], 0), (240, [float("nan")], 0), (260, [float("inf")], 0), (280, [], 0), (300, [1e12] * 6, 0),
             (300, [1e12] * 6, 0), (None, [1.0], 0), (320, [0.01], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit(0) for c in ("weights", "asks", "block", "part", "score", *CLASHING[:2])})
    held = [(i, [int(np.floor(64 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(
        x is not None and np.isfinite(x) for x in v)]
    want = []
    for q in {i for i, _ in held}:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(asked, v)), i) for own, asked in held if own == q for i, v in held if i != q)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:7])]
    for blocks in ({}, {"queries_per_block": 3, "candidates_per_block": 10}):
        found = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=7, **blocks).collect()
        assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.parametrize("blocks", [{}, {"queries_per_block": 2, "candidates_per_block": 3}])
def test_top_k_of_repeated_ids(spark, blocks):
    rows = [(20, [1.0, 0.0])] + [(1, [float(x), 0.0]) for x in range(5)] + [(2, [2.5, 0.0]), (2, [2.5, 0.0]), (3, [-1.0, 0.0])]
    rows += [(40, [float(x), 1.0]) for x in range(6)]  # queries too, none of them its own candidate
    rows += [(4, [3.0, 0.5])] * 12  # a third of all rows, the same
    rows += [(60, [1.0, 0.5])] * 2  # a query that is there twice
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=20, **blocks).collect()
    db = duckdb.connect()
    db.register("embeddings", pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                                        "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}))
    sql = db.sql(oracle_sql()["op8_exact_top_k"])
    at = [sql.columns.index(c) for c in ("query_id", "rank", "vec_id", "score")]
    assert sorted(map(tuple, found)) == sorted(tuple(row[i] for i in at) for row in sql.fetchall())


def test_top_k_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows, n in (([], 0), ([(20, [1.0])], 0), ([(20, [1.0]), (40, [2.0]), (1, [0.5])], 4)):
        assert topk.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).count() == n


def test_words_leave_arrow_as_plain_strings():
    words = pa.array(["", " a", "\x00", "ß\u0301", "日本", "𝒳"]).dictionary_encode().dictionary
    assert strings(words) == words.to_pylist() and {type(w) for w in strings(words)} == {str}
    assert strings(words[2:4]) == ["\x00", "ß\u0301"] and strings(words[:0]) == []
