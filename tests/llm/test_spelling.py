"""Spelling variants against plain edits, and the Bloom filters against sets."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from lakeloom.llm import spelling
from lakeloom.llm.words import mix

LETTERS = [chr(c) for c in spelling.ALPHABET.tolist()]


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: set() for w in n}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + a + w[i + 1 :] for i in range(len(w)) for a in LETTERS}
        for e in edits - {w}:
            if e in n:
                near[w].add(e)
                near[e].add(w)
    form = {}
    for w, all_ in near.items():
        best = min(all_, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(df, **kw):
    rows = spelling.variants(spelling.damaged_runs(df), **kw).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = ["spelling", "variants", "grouping", "Étéœuvre", "letter", "letters", "aaaaa", "aaaaaa", "aaaaaaa", "colour", "color", "a" * 70 + "b", "a" * 70 + "c", "a" * 69 + "b"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rnd.randint(0, 60)):
            w = rnd.choice(base[: rnd.choice([3, 14])])
            if rnd.random() < 0.4:
                p = rnd.randrange(len(w))
                w = rnd.choice([w[:p] + w[p + 1 :], w[:p] + rnd.choice("xyÿÀ") + w[p:], w[:p] + rnd.choice("zéþ") + w[p + 1 :], w.upper()])
            words.append(w)
        rows.append((i, rnd.choice([" ", "-", "\n", "7"]).join(words)))
    rows += [(900 + i, "chainaa " * 8 + "chainab " * 3 + "chainbb ") for i in range(5)]  # a word two steps from its root
    return rows + [(None, "spelling speling " * 9), (None, None), (5, ""), (5, "many many manyy " * 50), (5, "many many manyy " * 50)]


def test_variants_are_the_plain_edits(spark, docs_of, texts):
    want = brute(texts)
    df = docs_of([(i, t) for i, t in texts])
    assert len(want) > 100 and any(v[0] != v[1] for v in want.values() if v[0])
    assert found(df) == want
    # filters of a few words, one or two in a round
    assert found(df.repartition(7), filter_words=20, round_bytes=300) == want


def test_clashing_columns_and_empty_table(spark, texts):
    rows = [(i, t, "x", 1) for i, t in texts[:150]]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    assert found(df) == brute(texts[:150])
    assert found(df.limit(0)) == {}


def test_a_very_long_word(spark, docs_of):
    long = "abcdefghij" * 3000
    rows = [(1, f"{long} {long} {long} {long} {long} {long}"), (2, f"{long[:-1]} {long[:-1]} {long[:-1]}")]
    assert {w: v[:2] for w, v in found(docs_of(rows)).items()} == {w: v[:2] for w, v in ((long, (None, long)), (long[:-1], (long, long)))}


def test_filters_let_all_words_through_and_few_others():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choices(LETTERS, k=8)) for _ in range(20000)})
    import pyarrow as pa

    h = spelling.word_hashes(words)
    t = pa.table({"hash": h.view(np.int64), "shard": pa.array([8] * len(h), pa.int32()), "part": pa.array([0] * len(h), pa.int32())})
    bits = np.frombuffer(spelling._filter(t).column("bits")[0].as_py(), np.uint64)
    assert len(spelling._tested(h, 8, {8: 1}, {(8, 0): bits})) == len(words)
    other = np.random.default_rng(2).integers(0, 2**64, 200000, dtype=np.uint64)
    assert len(spelling._tested(other, 8, {8: 1}, {(8, 0): bits})) < 200
    assert len(np.unique(mix(h))) == len(words)


def test_sql_is_the_plain_edits(texts):
    from lakeloom.llm.queries import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    rows = con.sql(ORACLES["op12_spelling_variants"]).to_arrow_table().to_pylist()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows} == brute(texts)
