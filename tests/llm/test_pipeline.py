"""Each stage of the pipeline on hard cases, and the whole run against brute force."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from tables import documents, no_documents
from test_dedup import collapsed, exact_brute, join_brute
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from basketry.llm import language_id
from basketry.llm.shared import staged, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "source_mixing", "mixture_packing"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stage_on_hard_cases(spark, name, stage):
    docs = documents(spark)
    out = staged(stage(spark, docs, SF_SMALL), "hard")
    assert out.columns == docs.columns and 0 < out.count()
    assert stage(spark, no_documents(spark), SF_SMALL).count() == 0


def test_run(spark):
    """The rows of the stages, each judged on what the one before kept."""
    docs = table(spark, SF_SMALL, "documents")
    kept = {r.doc_id for r in language_id.languages(docs).collect() if not r.rejected}
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect() if r.doc_id in kept]
    stay = {i for (i, first, *_), _ in exact_brute(rows).items() if i == first}
    rows = [r for r in rows if r[0] in stay]
    stay = {i for (i, smallest, *_) in join_brute(rows) if i == smallest}
    rows = {r[0]: r for r in rows if r[0] in stay}
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in found} <= set(rows)

    total = sum(len(WORD.findall(r[1])) for r in rows.values())
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    most = {i: len(whole.encode(r[1], add_special_tokens=False).ids) + 1 for i, r in rows.items()}
    packed = Counter()
    for r in found:
        packed[r.doc_id] += r.length
    # No document is taken more than three times; a cut part ends with an end id of its own.
    assert all(n <= 3 * most[i] + 1 for i, n in packed.items())
    mixed = staged(corpus_pipeline.mixing_stage(spark, docs.filter(docs["doc_id"].isin(list(rows))), SF_SMALL), "mix").collect()
    words = sum(len(WORD.findall(r.text)) for r in mixed)
    assert abs(words - total) <= 16 * 20
    ids = sum(len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert ids == sum(packed.values())
    lengths = Counter()
    for r in found:
        lengths[r.sequence_id] += r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths.values())
    assert np.mean([n == 4096 for n in lengths.values()]) > 0.7
    assert collapsed("a \t b") == "a b"
