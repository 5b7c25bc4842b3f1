"""The pipeline against a plain version, and the registry of the queries."""

import re

import corpus_pipeline
import public_tokenizers
from test_dedup import brute_components, brute_lines
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lakeloom.llm import mixing, quality

SF = "/root/testdata/sf0.001"


def test_every_dealt_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_match_a_plain_version(spark, docs_of, sample):
    docs = docs_of(sample)
    kept = {r.doc_id for r in quality.judge(docs, public_tokenizers.path("piece_bpe_32k.model")).collect() if r.kept}
    one = [r for r in sample if r[0] in kept]
    got = corpus_pipeline.quality_rules(spark, docs, SF)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(one)

    lines = {int(i): (n, t) for i, _, n, t in brute_lines([r[:2] for r in one])}
    two = [(i, lines[i][1], la, so, len(lines[i][1]) if lines[i][0] else n) for i, t, la, so, n in one if not lines[i][0] or re.search(mixing.WORD, lines[i][1])]
    got = corpus_pipeline.repeated_lines(spark, docs_of(one), SF)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(two)

    stay = {int(i) for i, _, c in brute_components([r[:2] for r in two]) if i == c}
    three = [r for r in two if r[0] in stay]
    got = corpus_pipeline.near_duplicates(spark, docs_of(two), SF)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(three)

    four = corpus_pipeline.source_mixing(spark, docs_of(three), SF)
    assert four.columns == docs.columns
    chosen = sorted(map(tuple, four.collect()))
    assert set(chosen) <= set(three) and 0 < len(chosen) < len(three)

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = {r.doc_id: r for r in corpus_pipeline.token_ids(spark, docs_of(chosen), SF).collect()}
    for i, text, *_ in chosen:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert last[i].n_tokens == len(ids) and last[i].text == text
