import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import bpe, lm, mixing, quality, token_files, urls, words

WORD = re.compile("[^ \t-\r]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLIP, GPT = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def with_sample(sample, awkward, n=60):
    return [r[:2] for r in sample[:n]] + [(i + 1000 if i else i, t) for i, t in awkward]


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["a b a", None, "", " A\tB ", "x" * 100_000 + " y"]
    h, n = words.word_hashes(*words.text_buffer(pa.array(texts)))
    assert n.tolist() == [3, 0, 0, 2, 2]
    assert h[0] == h[2] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.uint64])
def test_pack_round_trip(dtype):
    x = np.arange(1000).astype(dtype)
    assert (words.unpack(words.pack(x), dtype) == x).all() and len(words.unpack(words.pack(x[:0]), dtype)) == 0


def test_bpe_equals_the_library_and_round_trips(docs_of, awkward, sample):
    rows = with_sample(sample, awkward)
    got = bpe.decode(bpe.encode(docs_of(rows), GPT, block_chars=5000, buckets=7), GPT).collect()
    t = Tokenizer.from_file(GPT)
    ids = [t.encode(x or "", add_special_tokens=False).ids for _, x in rows]
    want = sorted((str(i), np.array(k, "<u4").tobytes(), t.decode(k, skip_special_tokens=False)) for (i, _), k in zip(rows, ids, strict=True))
    assert sorted((str(r.doc_id), bytes(r.ids), r.text) for r in got) == want


def test_token_files_equal_the_library(docs_of, awkward, sample, tmp_path):
    rows = with_sample(sample, awkward)
    folder, dtype, manifest = token_files.write_token_files(docs_of(rows), CLIP, 2, folder=str(tmp_path / "files"))
    got = sorted((r.start, str(r.doc_id), r.n_tokens, r.ids_crc32) for r in token_files.read_digests(folder, dtype, manifest).collect())
    t, at, want = Tokenizer.from_file(CLIP), 0, []
    for i, x in sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], r[1] or "")):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        want.append((at, str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert not [p for p in (tmp_path / "files").iterdir() if p.suffix != ".bin"]


def test_lm_base_is_exact_and_the_mixture_predicts_better(docs_of, awkward, sample):
    rows = with_sample(sample, awkward, 200)
    got = lm.score(docs_of(rows), block_words=3000, bucket_entries=2000).collect()
    split = lambda t: [*WORD.findall((t or "").translate(LOWER)), None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(split(t)), sum(c[w] > 0 for w in split(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t)), 4)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_weights_are_learned():
    cells = np.array([(3 * 192 + lm._bin(np.array([0.5]))[0]) * 192 + lm._bin(np.array([0.001]))[0]])
    w = lm.mixture_weights(cells, np.array([100]), 1e-6)
    assert w[0, 3] > 0.9 and abs(w.sum(0) - 1).max() < 1e-9


def test_quality_counts_match_brute_force(docs_of, awkward, sample):
    rows = with_sample(sample, awkward, 150)
    for r in quality.judge(docs_of(rows).withColumn("lang", F.lit("en")), PIECES).collect():
        texts = [t or "" for i, t in rows if i == r.doc_id]
        found = []
        for t in texts:
            w = WORD.findall(t)
            grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
            again = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
            found.append((len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(again), failed))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in found
        assert not (r.base_failed and r.kept)


def test_quality_bands_reject_a_text_unlike_its_language(docs_of):
    plain = [(i, " ".join(f"{a} {b}" for a, b in zip(["walking", "houses", "green", "river", "music"] * 8, [f"word{(i * 7 + k) % 90}" for k in range(40)], strict=False)), "en") for i in range(300)]
    odd = [(999, " ".join("☃☄★☎☢" for _ in range(80)), "en")]
    got = {r.doc_id: r.kept for r in quality.judge(docs_of(plain + odd), PIECES).collect() if not r.base_failed}
    assert got.get(999, False) is False
    assert quality.script("Привет мир") == "cyrillic" and quality.script("12") == "none"


def test_lists_without_rows(docs_of, spark):
    none = docs_of([])
    assert quality.judge(none, PIECES).count() == 0
    assert lm.score(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert bpe.encode(none, GPT).count() == 0
    assert token_files.read_digests(*token_files.write_token_files(none, CLIP, 2)).count() == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_mixing_reaches_the_margins(docs_of):
    rows = [(i, "w " * (5 + i % 7), "en" if i % 3 else "de", f"s{i % 4}" if i % 2 else "hot") for i in range(2000)] + [(5000, None, None, None)]
    mixed = mixing.mix(docs_of(rows), rate=0.3)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = mixed.select("source", "lang", "n_tokens", "probability", "kept").collect()
    assert len(got) == len(rows) and all(0 <= r.probability <= 1 for r in got)
    total, have = sum(r.n_tokens for r in got), defaultdict(float)
    for r in got:
        have[r.source] += r.n_tokens * r.probability
    weight = defaultdict(int)
    for r in got:
        weight[r.source] += r.n_tokens
    root = {s: t**0.5 for s, t in weight.items()}
    for s in have:
        want = 0.3 * total * root[s] / sum(root.values())
        assert have[s] == pytest.approx(min(want, weight[s]), rel=0.05, abs=1)
    kept = sum(r.n_tokens for r in got if r.kept)
    assert kept == pytest.approx(0.3 * total, rel=0.15)


def test_urls_rules_hosts_and_propagation(spark):
    page = lambda *links: "".join(f'<a href="{x}">x</a>' for x in links)
    rows = [
        (1, "http://WWW.Example.com/en/a?x", None), (2, "https://example.com/en/b", ""), (3, "http://sub.example.com/de", None), (4, None, None), (5, "no scheme", None), (6, "http://a.net/es/1", page("/local")),
        (7, "http://a.net/en/1", None), (8, "http://farm.org/1", page("http://a.net/x", "//a.net/y")), (9, "http://clean.org", page("mailto:x")), (10, "http://evilexample.com/en/", None), (11, "http://a.net/es/2", None),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/en/b", "example.com/en/", "block")
    assert got[3] == ("sub.example.com", "/de", "com/", "allow")
    assert got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert got[6][3] == "block" and got[7] == ("a.net", "/en/1", None, "block")  # two thirds of the host's pages are blocked
    assert got[9] == ("clean.org", "", None, "allow") and got[10][2] == "com/"
    scores = urls.host_scores(spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0), ("c", 0.0, 0.0)], "host string, allowed double, blocked double"), spark.createDataFrame([("a", "c"), ("c", "b")], "src string, dst string"), rounds=3)
    s = {r.host: (r.trust, r.distrust) for r in scores.collect()}
    assert s["c"] == (pytest.approx(0.7), pytest.approx(0.7)) and s["a"][1] == pytest.approx(0.49)


def test_blocks_of_empty_texts_are_bounded(docs_of):
    rows = [(i, None if i % 2 else "", "en", "web", 0) for i in range(300)] + [(1000, "a word", "en", "web", 6)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = {r.doc_id: r.ids for r in bpe.encode(docs_of(rows), path, block_chars=160).collect()}
    assert len(coded) == 301 and [i for i, ids in coded.items() if ids] == [1000]
    scored = {r.doc_id: r.n_tokens for r in lm.score(docs_of(rows), block_words=10).collect()}
    assert len(scored) == 301 and scored[1000] == 3 and scored[7] == 1
