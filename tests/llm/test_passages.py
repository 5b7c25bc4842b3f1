"""Passage removal against plain windows, the FM-index against plain search."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from lakeloom.llm import passages
from pyspark.sql import functions as F


def brute(rows, size=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [-(2**63) if i is None else i for i, _ in rows]
    least = {}
    for i, w in zip(ids, words, strict=True):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            least[key] = min(i, least.get(key, i))
    out = []
    for (doc, _), i, w in zip(rows, ids, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **kw):
    got = passages.remove_passages(df, **kw)
    rows = got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("h"), "spans").collect()
    assert all(sum(s.n for s in r.spans) == r.n_removed for r in rows)
    return sorted([tuple(r)[:4] for r in rows], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_all_matches(seed):
    rnd = np.random.default_rng(seed)
    text = np.append(rnd.integers(1, 5, 2999), 0)  # a separator ends the text
    index = passages.FMIndex(text, 13)
    places = np.flatnonzero(rnd.random(3000 - 13) < 0.1)
    pattern = text.copy()
    pattern[rnd.random(3000) < 0.05] = 1
    length, low, high = index.matches(pattern, places, 13)
    for p, n, a, b in zip(places.tolist(), length.tolist(), low.tolist(), high.tolist(), strict=True):
        ends = [i for i in range(3000 - n + 1) if (text[i : i + n] == pattern[p + 13 - n : p + 13]).all()]
        assert sorted(index.suffixes[a:b].tolist()) == ends
        if n < 13:
            longer = pattern[p + 12 - n : p + 13]
            assert not any(len(text[i : i + n + 1]) == n + 1 and (text[i : i + n + 1] == longer).all() for i in range(3000))


@pytest.mark.parametrize("size", [8, 13, 16])
def test_index_finds_own_repeats(size):
    rnd = np.random.default_rng(size)
    piece = rnd.integers(1, 400, 60)
    parts = [rnd.integers(1, 400, rnd.integers(1, 40)) if rnd.random() < 0.5 else piece[rnd.integers(0, 30) :][: rnd.integers(5, 40)] for _ in range(80)]
    text = np.concatenate([np.append(x, 0) for x in parts])
    index = passages.FMIndex(text, size)
    places = np.array([i for i in range(len(text) - size) if (text[i : i + size] != 0).all()])
    again, low, high = index.repeats(text, places, size)
    got = {int(places[a]): sorted(index.suffixes[x:y].tolist()) for a, x, y in zip(again, low, high, strict=True)}
    same = {}
    for p in places.tolist():
        same.setdefault(tuple(text[p : p + size].tolist()), []).append(p)
    assert got == {p: ps for ps in same.values() if len(ps) > 1 for p in ps} and len(got) > 50


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    word = lambda: rnd.choice(["the", "of", "a", "é", "漢字", "B", "b", *(f"w{k}" for k in range(400))])
    shared = [[word() for _ in range(n)] for n in (12, 13, 14, 25, 60, 300)]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            parts.append([word() for _ in range(rnd.randint(0, 40))])
            if rnd.random() < 0.5:
                s = rnd.choice(shared)
                a = rnd.randrange(len(s))
                parts.append(s if rnd.random() < 0.6 else s[a : a + rnd.randint(1, 40)])
        rows.append((rnd.choice([i, i, i, i // 2, None]), rnd.choice([" ", "\n", " \t "]).join(" ".join(p) for p in parts)))
    template = [f"t{k}" for k in range(9)]
    rows += [(1000 + i, " ".join([word() for _ in range(8)] + template + [word() for _ in range(8)])) for i in range(150)]  # a passage in many contexts
    rows += [(2000 + i % 3, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen") for i in range(40)]
    rows += [(3000, "again and " * 300), (3001, "again and " * 40), (3002, "again and " * 6)]
    return rows


def test_removal_is_the_plain_windows(spark, docs_of, texts):
    want = brute(texts)
    assert sum(n for _, _, n, _ in want) > 3000
    df = docs_of(texts)
    assert found(df) == want
    assert found(df.repartition(9), block_bytes=3000, bucket_entries=50, shard_words=400) == want


def test_hot_minimizers_are_dealt_by_windows(spark, docs_of, texts, monkeypatch):
    monkeypatch.setattr(passages, "HOT", 1)
    monkeypatch.setattr(passages, "LONGEST", 3)
    rows = texts[:60] + texts[160:200]
    blocks = [r.asDict() for r in docs_of(rows).selectExpr("coalesce(doc_id, -9223372036854775808) as doc", "text").coalesce(1).mapInArrow(passages._blocks(2000), "block long, ids binary, sizes binary, z binary").collect()]
    import pyarrow as pa

    bits, buckets, shards = 40, 3, 5
    seeds = list(passages._seeded(13, buckets, bits)([pa.RecordBatch.from_pylist(blocks, passages._BLOCK)]))
    seeds = pa.Table.from_batches(seeds)
    judged = pa.concat_tables([passages._judged(seeds.filter(pa.compute.equal(seeds.column("bucket"), b))) for b in range(buckets)])
    assert 2 in {f for x in judged.column("flags") for f in passages.unpack(x.as_py(), np.uint8).tolist()}
    of_block = lambda t, b: t.filter(pa.compute.equal(t.column("block"), b["block"]))
    sent = pa.concat_tables([passages._sent(13, buckets, bits, shards)(pa.Table.from_pylist([b], passages._BLOCK), of_block(judged, b)) for b in blocks])
    matched = pa.concat_tables([passages._matched(13)(sent.filter(pa.compute.equal(sent.column("shard"), s))) for s in sorted(set(sent.column("shard").to_pylist()))])
    both = pa.table({"kind": [1] * len(judged) + [2] * len(matched), "block": pa.concat_arrays([judged.column("block").combine_chunks(), matched.column("block").combine_chunks()]), "bucket": judged.column("bucket").to_pylist() + matched.column("shard").to_pylist(), "flags": pa.array(judged.column("flags").to_pylist() + matched.column("smallest").to_pylist(), pa.binary())})
    rows_out = [r for b in blocks for r in passages._covered(13, buckets, bits, shards)(pa.Table.from_pylist([b], passages._BLOCK), of_block(both, b)).to_pylist()]
    got = sorted([(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in rows_out], key=repr)
    assert got == brute(rows)


def test_awkward_rows(spark, docs_of, awkward):
    assert found(docs_of(awkward)) == brute(awkward)
    extra = spark.createDataFrame([(i, t, 5, "x") for i, t in awkward], "doc_id long, text string, block int, ids string")
    assert found(extra) == brute(awkward)
    assert found(docs_of([])) == []
    assert found(docs_of([(1, None), (None, "")])) == brute([(1, None), (None, "")])


def test_sql_is_the_plain_windows(texts, awkward):
    from lakeloom.llm.queries import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    rows = [r for r in {i: (i, t) for i, t in [*awkward, *texts] if i is not None and len(t or "") < 9000}.values()]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = con.execute(ORACLES["op11_passage_dedup"]).fetchall()
    assert sorted(got, key=repr) == brute(rows)
