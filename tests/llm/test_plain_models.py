"""Scores and measures of the models against plain versions that share no code with them."""

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from lakeloom.llm import lm, quality

WORD = r"[^\x20\x09-\x0D]+"
END = object()


# ------------------------------------------------------------------- op7
def quarter(x):
    """An estimate in quarter octaves below 1, as many as the histogram has."""
    return 0.0 if x <= 0 else 2.0 ** (max(-190, min(0, round(4 * math.log2(x)))) / 4)


def plain_scores(rows, rounded):
    docs = []
    for doc, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        docs.append((zlib.crc32(b"" if doc is None else b"%d" % doc) % 10 == 0, [*re.findall(WORD, low), END]))
    one, two = Counter(), Counter()
    for held, words in docs:
        if not held:
            one.update(words)
            two.update(zip([END, *words], words, strict=False))
    total, distinct = sum(one.values()), len(one)
    level = lambda n: 0 if n <= 0 else 1 + int(math.floor(math.log2(n)))
    cells = Counter()
    for held, words in docs:
        if held:
            continue
        for a, b in zip([END, *words], words, strict=False):
            v = one[a] - 1
            f2, f1 = ((two[a, b] - 1) / v if v > 0 else 0.0), (one[b] - 1) / max(1, total - 1)
            cells[(level(v), *((quarter(f2), quarter(f1)) if rounded else (f2, f1)))] += 1
    weights = defaultdict(lambda: [1 / 3] * 3)
    weights[0] = [0.0, 0.5, 0.5]
    for _ in range(60):
        got = defaultdict(lambda: [0.0] * 3)
        for (at, f2, f1), n in cells.items():
            parts = [w * f for w, f in zip(weights[at], (f2, f1, 1 / (distinct + 1)), strict=True)]
            for i, p in enumerate(parts):
                got[at][i] += n * p / max(sum(parts), 1e-300)
        for at, g in got.items():
            if sum(g) > 0:
                weights[at] = [x / sum(g) for x in g]
    for at in range(1, 66):
        if not any(c[0] == at for c in cells):
            weights[at] = weights[at - 1]
    out = []
    for _, words in docs:
        score = 0.0
        for a, b in zip([END, *words], words, strict=False):
            w = weights[level(one[a])]
            score += math.log10(w[0] * (two[a, b] / one[a] if one[a] else 0.0) + w[1] * one[b] / max(1, total) + w[2] / (distinct + 1))
        out.append(score)
    return out


@pytest.mark.parametrize("block_words", [300, 1_000_000])
def test_lm_score_is_the_plain_mixture(docs_of, sample, awkward, block_words):
    rows = [(r[0], r[1]) for r in sample[:80]] + awkward
    exact, binned = plain_scores(rows, False), plain_scores(rows, True)
    got = lm.score(docs_of(rows).coalesce(1), block_words=block_words).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id, r.n_tokens].append(r.score)
    want, unrounded = defaultdict(list), defaultdict(list)
    for (doc, text), b, e in zip(rows, binned, exact, strict=True):
        key = doc, len(re.findall(WORD, text or "")) + 1
        want[key].append(b)
        unrounded[key].append(e)
    assert by.keys() == want.keys()
    for key in want:
        assert sorted(by[key]) == pytest.approx(sorted(want[key]), rel=1e-9, abs=1e-9), key
        # what the histogram's quarter octaves cost: below half a percent of a score
        assert sorted(by[key]) == pytest.approx(sorted(unrounded[key]), rel=5e-3, abs=5e-3), key


def test_lm_of_extra_columns(docs_of, spark, sample):
    rows = [(r[0], r[1], "x", 1, 2.0) for r in sample[:30]]
    clash = spark.createDataFrame(rows, "doc_id long, text string, words string, block int, score double")
    plain = docs_of([r[:2] for r in rows])
    assert sorted(map(tuple, lm.score(clash).collect())) == sorted(map(tuple, lm.score(plain).collect()))


# ------------------------------------------------------------------- op6
def plain_measures(text, sp):
    words = re.findall(WORD, text or "")
    ids = [i for w in words for i in sp.encode(w)]
    chars = sum(map(len, words))
    entropy = 0.0
    if len(ids) > 1:
        entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values()) / math.log2(len(ids))
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i + k for i, g in enumerate(grams) if Counter(grams)[g] > 1 for k in range(5)} if len(grams) < 400 else None
    return len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice) if twice is not None else None, len(ids), chars / max(1, len(ids)), sum(sp.is_byte(i) for i in ids) / max(1, len(ids)), entropy


def plain_script(text):
    total = Counter()
    for c in text or "":
        if c.isalpha():
            total[unicodedata.name(c, "?").split()[0]] += 1
    return total


#: the scripts whose fixed limits the texts here meet: characters a token, byte share
PLAIN_LIMITS = {"latin": (1.3, 10.0, 0.3), "han": (0.3, 5.0, 0.8), "cyrillic": (1.2, 8.0, 0.3)}


def test_measures_and_limits_are_the_plain_ones(docs_of, sample, awkward):
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    odd = [
        (700, "qzxj kvwq zzxq jjkv wqzx xqjv kqzx vvjq zxqk jqvz " * 4, "en"), (701, "слово за словом идёт простой русский текст о погоде и природе " * 4, "ru"), (702, "это русский текст под английской меткой " * 5, "en"),
        (703, "一个 普通 的 中文 句子 关于 天气 和 自然 风景 以及 人们 " * 4, "zh"), (704, "🙂🙃😀😁 😂🤣😃😄 😅😆😉😊 😋😎😍😘 🥰😗😙😚 🙂🤗🤩🤔 🤨😐😑😶 🙄😏😣😥 😮🤐😯😪 😫🥱😴😌", None), (705, "word " * 60, "en"),
    ]
    rows = [(r[0], r[1], r[2]) for r in sample[:60]] + [(i, t, None) for i, t in awkward if i not in (6, 7)] + odd
    got = defaultdict(list)
    for r in quality.measure(docs_of(rows), public_tokenizers.path("piece_bpe_32k.model")).collect():
        got[r.doc_id, r.n_words, r.word_chars].append(r)
    for doc, text, lang in rows:
        n, chars, symbols, lines, twice, tokens, *measures = plain_measures(text, sp)
        r = got[doc, n, chars].pop()
        assert (r.n_symbols, r.n_dup_lines, r.n_tokens) == (symbols, lines, tokens), doc
        assert twice is None or r.n_repeat_words == twice, doc
        assert [r.chars_per_token, r.byte_share, r.token_entropy] == pytest.approx(measures, abs=1e-9), doc
        # fixed limits: of the language's script, wider for short texts, entropy of three bits or half the most
        names = plain_script(text)
        found = {"LATIN": "latin", "CJK": "han", "CYRILLIC": "cyrillic"}.get(max(names, key=names.get)) if names else None
        if found is None or (lang and lang not in ("en", "de", "es", "fr", "ru", "zh")):
            continue
        home = {"ru": "cyrillic", "zh": "han", None: found}.get(lang, "latin")
        wide = max(1.0, (30 / max(1, n)) ** 0.5)
        low, high, most_bytes = PLAIN_LIMITS[home]
        most = math.log2(max(2, tokens))
        outside = found != home or measures[0] < low / wide or measures[0] > high * wide or measures[1] > most_bytes * wide or measures[2] * most < min(3.0, most / 2) / wide
        assert r.outside == outside, (doc, text[:40])


# -------------------------------------------------------------- pipeline
STAGES = [f for _, f in corpus_pipeline.STAGES[:-1]]


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__name__)
def test_stages_of_empty_tables_null_texts_and_clashing_columns(spark, docs_of, stage, awkward):
    assert stage(spark, docs_of([]), "").count() == 0
    assert stage(spark, docs_of([]), "").columns == docs_of([]).columns
    none = docs_of([(1, None), (None, None), (1, None)])
    assert stage(spark, none, "").count() <= 3
    rows = [(i, t, "en", "web", len(t or ""), "k", 1, True) for i, t in awkward if i not in (6, 7)]
    wide = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, text_key string, doc int, kept boolean")
    narrow = wide.drop("text_key", "doc", "kept")
    got = stage(spark, wide, "")
    assert got.columns == wide.columns
    key = lambda df: sorted(((r.doc_id is None, r.doc_id, r.text or "") for r in df.collect()), key=str)
    assert key(got) == key(stage(spark, narrow, ""))
