"""The whole pipeline, the quality bands and raking against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_lines
from test_models import PIECES
from tokenizers import Tokenizer

from lakeloom.llm import mixing, quality


def brute_kept(rows):
    """Ids that the quality rules keep; measures are given, the edges are plain."""
    long = [r for r in rows if r.n_words >= 10]
    flat = lambda r, m: r[m] + (0.04 * math.log2(max(1, r.n_tokens)) if m == "token_entropy" else 0)
    texts = {(r.script, r.language, r.band, r.text_key): r for r in long}.values()

    def half(found, m):
        v = np.percentile([round(flat(r, m), 3) for r in found], [2 * i for i in range(51)])
        return min((round(v[i + 25] - v[i], 9), v[i], v[i + 25]) for i in range(26))[1:]

    groups = {k: defaultdict(list) for k in ("band", "language", "script")}
    for r in texts:
        for k, g in groups.items():
            g[r[k]].append(r)
    edges = {(k, n): {m: half(found, m) for m in quality.MEASURES} for k, g in groups.items() for n, found in g.items() if len(found) >= 100}
    kept = set()
    for r in long:
        level = next((k for k in groups if (k, r[k]) in edges), None)
        wide = max(1, math.sqrt(30 / r.n_words))
        ok = not r.outside and 100 * r.n_repeat_words <= 20 * r.n_words
        for m, floor in quality.MEASURES.items() if level else ():
            lo, hi = edges[level, r[level]][m]
            reach = max(2 * (hi - lo) * (1 if level == "band" else wide), floor * wide)
            ok &= lo - reach <= round(flat(r, m), 3) <= hi + reach * (2 if m == "token_entropy" else 1)
        if ok:
            kept.add(r.doc_id)
    return kept


def brute_mix(rows, rate=0.5):
    """Rows that raking and sampling keep."""
    word = lambda t: len(re.findall(mixing.WORD, t or ""))
    topic = lambda t, n: "table" if " | " in (t or "") else "note" if n < 50 else "long read" if n >= 2000 else "article" if n >= 300 else "brief"
    cell = lambda r: (r[3] or "unknown", r[2] or "unknown", topic(r[1], word(r[1])))
    tokens = Counter()
    for r in rows:
        tokens[cell(r)] += word(r[1])
    total, p = sum(tokens.values()), dict.fromkeys(tokens, rate)
    for _ in range(8):
        for d, power in enumerate((0.5, 0.7, 0.7)):
            have, weight = defaultdict(float), Counter()
            for c, n in tokens.items():
                have[c[d]] += p[c] * n
                weight[c[d]] += n
            all_ = sum(n**power for n in weight.values() if n)
            p = {c: min(1.0, x * (weight[c[d]] ** power / all_ * rate * total) / have[c[d]]) if have[c[d]] > 0 else x for c, x in p.items()}
    draw = lambda i: int(hashlib.sha256(str(i).encode()).hexdigest()[:13], 16) / 2**52
    return [r for r in rows if draw(r[0]) < round(p[cell(r)], 9)]


def test_run_matches_plain_versions_chained(spark, docs_of, sample, tmp_path):
    docs_of(sample).write.parquet(str(tmp_path / "documents.parquet"))
    measured = quality.measure(docs_of(sample), PIECES).collect()
    kept = brute_kept(measured)
    assert kept == {r.doc_id for r in quality.judge(docs_of(sample), PIECES).where(F.col("kept")).collect()}
    one = [r for r in sample if r[0] in kept]
    lines = {int(i): (n, t) for i, _, n, t in brute_lines([r[:2] for r in one])}
    two = [(i, lines[i][1], *rest) for i, _, *rest in one if not lines[i][0] or re.search(mixing.WORD, lines[i][1])]
    stay = {int(i) for i, _, c in brute_components([r[:2] for r in two]) if i == c}
    four = brute_mix([r for r in two if r[0] in stay])
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes(), x or "") for i, x, *_ in four)
    got = sorted((r.doc_id, bytes(r.ids), r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and 0 < len(got) < len(sample)


def test_shares_are_totalled_without_a_window(spark):
    cells = spark.createDataFrame([(f"s{i}", i) for i in range(5)], "source string, tokens long")
    shares = mixing.tempered(cells, "source", 0.5)
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()
    got = {r.source: r.share for r in shares.collect()}
    roots = sum(i**0.5 for i in range(5))
    assert all(abs(got[f"s{i}"] - i**0.5 / roots) < 1e-12 for i in range(5))
