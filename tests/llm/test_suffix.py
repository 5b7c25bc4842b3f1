"""Strings whose polynomial fingerprints are equal are no repeats."""

import numpy as np
import pytest

from lakeloom.llm import suffix_dedup
from test_dedup import brute_suffixes

TAIL = "a tail that both of the two texts share, long enough for a sample of 70 bytes"[:76]
#: Found by merging lists of random starts until a pair's fingerprints are equal.
CLASH = ["fqgaajzwhwlmglpuhkxkztlv" + TAIL, "kvjbdxbltxzbyhpmzxrzpjiy" + TAIL]


@pytest.mark.parametrize("block_bytes", [50, 10_000])
def test_a_clash_of_fingerprints_removes_nothing(docs_of, block_bytes):
    prints = [suffix_dedup._Windows(np.frombuffer(t.encode(), np.uint8)).at(np.array([0]), 100)[0] for t in CLASH]
    assert prints[0] == prints[1] and {len(t) for t in CLASH} == {100}
    rows = [(1, CLASH[0]), (2, CLASH[1]), (3, f"before {CLASH[1]} after"), (4, CLASH[0] + CLASH[1])]
    got = suffix_dedup.remove_repeats(docs_of(rows), block_bytes=block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_suffixes(rows)


@pytest.mark.parametrize("symbols", [1, 2, 5, 250])
def test_suffix_array_by_the_difference_cover(symbols):
    rnd = np.random.default_rng(symbols)
    for n in [*range(1, 30), 100, 500, 1001]:
        text = rnd.integers(1, symbols + 1, n)
        if n > 90:
            text[40:80] = text[:40]
        assert suffix_dedup.suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_suffix_array_of_many_symbols():
    text = np.random.default_rng(3).integers(1, 2**21, 400)
    text[200:300] = text[:100]
    assert suffix_dedup.suffix_array(text).tolist() == sorted(range(400), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("hot", [1, 2000])
def test_repeats_within_and_across_documents(docs_of, monkeypatch, hot):
    import random

    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rnd = random.Random(hot)
    word = lambda: "".join(rnd.choices("abcdeéß漢", k=rnd.randint(1, 8)))
    shared = [" ".join(word() for _ in range(n)) for n in (15, 30, 80, 200)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 30)))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randrange(len(s))
            parts += [s if rnd.random() < 0.5 else s[a : a + rnd.randint(90, 300)], word()]
        rows.append((rnd.choice([i, i, i // 2, None]), rnd.choice(["", "\n"]).join(parts)))
    rows += [(100, "a" * 350), (101, "ab" * 160), (102, "a" * 99 + "b" + "a" * 99), (103, "abc" * 50), (103, "abc" * 50), (104, shared[3] + shared[3])]
    want = brute_suffixes(rows)
    for kw in ({}, {"block_bytes": 700, "bucket_entries": 20, "shard_bytes": 3000}):
        got = suffix_dedup.remove_repeats(docs_of(rows).coalesce(1), **kw).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
