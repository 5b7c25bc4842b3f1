"""Quality rules by tokeniser fertility (operator 6).

Every document's words are encoded with a public vocabulary (sentencepiece,
byte fallback); measured are characters per token, the share of byte-fallback
tokens and the entropy of the token distribution relative to the largest that
so many tokens can have, less its fall with length in prose. A document that
the base rules pass and that lies outside its edges goes.

Edges come from the shortest interval that holds half of the distinct texts,
widened by ``width`` times its length and no less than a floor (entropy's
upper edge, where nothing is repetitive, is twice as far). Rows that lie apart
and are fewer than half cannot pull that interval to themselves, so a third of
junk moves it little. Texts are compared with those of their language (their
script, where the language is null) and half octave of length; where these are
under ``LEAST`` with all lengths of the language, then with all texts of the
script. A script of fewer texts has fixed limits only, as fertility is not
comparable between scripts. The limits, by language or script, hold for every
text. Floors and limits are wider for texts of under ``SHORT`` words.

Defined results: null text has no words (it fails the base rule); a null
language is replaced by the text's script; repeated rows are judged alike; a
null id stays null.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import SPACE, id_of, releasing, text_of, written
from lakeloom.llm.vocabulary import share
from lakeloom.llm.words import by_document, slices, text_buffer, windows, word_hashes

#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_WORDS = re.compile("[^ \t-\r]+")
#: First code points of scripts' main ranges.
_SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x1000, "other"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0xD800, "other"))
_STARTS = np.array([a for a, _ in _SCRIPTS])
_LOADED: dict = {}
#: Bytes of encoded words that a task remembers.
_KEEP = 48 << 20

#: measure, floor of the distance between the interval and an edge
MEASURES = {"chars_per_token": 0.5, "byte_share": 0.05, "token_entropy": 0.06}
#: Fewest words that the base rules pass, words under which a text is short, fewest texts that set edges, fall of prose's relative entropy in an octave of length.
BASE_WORDS, SHORT, LEAST, FALL = 10, 30, 100, 0.04
#: Steps of the quantiles among which the shortest half is looked for.
STEPS = 50
#: Fixed limits by script: fewest and most characters per token, largest share of byte tokens. Scripts that the vocabulary hardly covers may be all bytes.
LIMITS = {"latin": (1.3, 10.0, 0.3), "cyrillic": (1.2, 8.0, 0.3), "none": (0.25, 10.0, 0.6), **dict.fromkeys(("greek", "hebrew", "arabic", "indic", "thai", "kana", "han", "hangul"), (0.3, 5.0, 0.8)), **dict.fromkeys(("armenian", "other"), (0.2, 5.0, 1.0))}
#: Fixed limits by language: its scripts, the first of which has its limits.
LANGUAGES = {**dict.fromkeys(("de", "en", "es", "fr", "it", "nl", "pt"), ("latin",)), **dict.fromkeys(("bg", "ru", "uk"), ("cyrillic",)), **dict.fromkeys(("ar", "fa"), ("arabic",)), "el": ("greek",), "he": ("hebrew",), "hi": ("indic",), "th": ("thai",), "zh": ("han",), "ja": ("kana", "han"), "ko": ("hangul", "han")}
#: Fixed limit: bits of entropy, or half of the largest where that is less.
LEAST_BITS = 3.0
_SCHEMA = "doc_id long, text_key long, band string, language string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, token_entropy double, outside boolean"


def script(text: str) -> str:
    """The script of most letters."""
    total: Counter = Counter()
    for c, n in Counter(text).items():
        if c.isalpha():
            total[_SCRIPTS[max(0, int(np.searchsorted(_STARTS, ord(c), "right")) - 1)][1]] += n
    return min(total, key=lambda s: (-total[s], s)) if total else "none"


def outside(lang: str | None, written_in: str, n_words: int, n_tokens: int, chars_per_token: float, byte_share: float, entropy: float) -> bool:
    """Whether a text is beyond the fixed limits of its language or script."""
    wide = max(1.0, (SHORT / max(1, n_words)) ** 0.5)
    scripts = LANGUAGES.get((lang or "").lower().replace("_", "-").split("-")[0], ())
    if scripts and written_in not in (*scripts, "none"):
        return True
    low, high, bytes_most = LIMITS[scripts[0] if scripts else written_in]
    most = float(np.log2(max(2, n_tokens)))
    return chars_per_token < low / wide or chars_per_token > high * wide or byte_share > bytes_most * wide or entropy * most < min(LEAST_BITS, most / 2) / wide


def _model(content: bytes):
    key = hash(content)
    if key not in _LOADED:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=content)
        _LOADED[key] = sp, np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
    return _LOADED[key]


def repeated_words(words: np.ndarray, counts: np.ndarray, size: int = 5) -> np.ndarray:
    """Words of each document that lie in a window of ``size`` words found twice or more in it."""
    grams, doc, at = windows(words, counts, size)
    order = by_document(doc, grams)
    g, d = grams[order], doc[order]
    same = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(g), bool)
    twice[1:] |= same
    twice[:-1] |= same
    first = at[order[twice]]
    cover = np.bincount(first, minlength=len(words) + size + 1) - np.bincount(first + size, minlength=len(words) + size + 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(words)] > 0)])
    ends = np.cumsum(counts)
    return covered[ends] - covered[ends - counts]


def _measured(model):
    def run(batches):
        sp, is_byte = _model(model.value)
        known, size = {}, 0  # forgotten with the task: workers go on to other stages
        for b in (part for whole in batches for part in slices(whole, "text", 2 << 20)):
            texts = [t or "" for t in b.column("text").to_pylist()]
            words, counts = word_hashes(*text_buffer(b.column("text")), lower=False)
            repeats = repeated_words(words, counts)
            split = [_WORDS.findall(t) for t in texts]
            if size > _KEEP:
                known, size = {}, 0
            new = list({w for ws in split for w in ws if w not in known})
            for w, ids in zip(new, sp.encode(new), strict=True):
                known[w] = np.array(ids, "<u2").tobytes()
                size += 160 + len(w) + len(known[w])
            out = []
            for t, ws, lang in zip(texts, split, b.column("lang").to_pylist(), strict=True):
                lines = [x for x in t.split("\n") if x.strip(SPACE)]
                ids = np.frombuffer(b"".join([known[w] for w in ws]), "<u2")
                chars = sum(map(len, ws))
                k = np.unique(ids, return_counts=True)[1] / max(1, len(ids))
                entropy = float(-(k * np.log2(k)).sum() / np.log2(len(ids))) if len(ids) > 1 else 0.0
                fertility = chars / max(1, len(ids)), float(is_byte[ids].mean()) if len(ids) else 0.0, entropy
                found = script(t)
                band = f"{lang or found}/{int(2 * np.log2(max(1, len(ws))))}"
                out.append((band, lang or found, found, len(ws), chars, sum(t.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), len(ids), *fertility, outside(lang, found, len(ws), len(ids), *fertility)))
            c = list(zip(*out, strict=True)) if out else [()] * 12
            kinds = [*[pa.string()] * 3, *[pa.int64()] * 5, *[pa.float64()] * 3, pa.bool_()]
            a = [pa.array(x, k) for x, k in zip(c, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), *a[:7], pa.array(repeats.astype(np.int64)), *a[7:]], names=[x.split()[0] for x in _SCHEMA.split(", ")])

    return run


def measure(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All counts and measures of every row, ``band``, the language or script and length it is judged with, and ``outside``, the verdict of the fixed limits."""
    with open(model_path, "rb") as f:
        model = share(docs.sparkSession, f.read())
    rows = docs.select(id_of(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(releasing(_measured(model)), _SCHEMA)


def judged(measure: str) -> Column:
    """A measure as it is compared: entropy without its fall with length."""
    fall = F.lit(FALL) * F.log2(F.greatest(F.lit(1), F.col("n_tokens"))) if measure == "token_entropy" else F.lit(0.0)
    return F.col(measure) + fall


def bands(measures: DataFrame) -> DataFrame:
    """(band, script, own, and per measure ``_lo`` and ``_hi``): the shortest half of the distinct texts a band is held against, null where they are too few."""
    keys = ["script", "language", "band"]
    # copies of a text count once; measures follow from the text, so any copy's will do
    texts = measures.where(F.col("n_words") >= BASE_WORDS).groupBy(*keys, "text_key").agg(*[F.max(F.round(judged(m), 3)).alias(m) for m in MEASURES])
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])).alias("v")
    counts = written(texts.select(*keys, values).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")).select(*keys, "v.*", "n"), "values")

    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.col(k).alias("name")) for i, k in enumerate(reversed(keys))])).alias("g")
    grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    quantiles = counts.select(levels, "measure", "value", "n").groupBy("g.level", "g.name", "measure").agg(F.sum("n").alias("n"), F.percentile("value", grid, F.col("n")).alias("q")).where(F.col("n") >= LEAST)
    at = lambda i: F.element_at("q", i)
    half = F.array_min(F.transform(F.sequence(F.lit(1), F.lit(STEPS // 2 + 1)), lambda i: F.struct(F.round(at(i + STEPS // 2) - at(i), 9).alias("size"), at(i).alias("lo"), at(i + STEPS // 2).alias("hi"))))
    halves = quantiles.select("level", "name", "measure", half.alias("h")).groupBy("level", "name").agg(*[F.max(F.when(F.col("measure") == m, F.col("h"))).alias(m) for m in MEASURES])
    halves = written(halves, "halves")

    found = counts.select(*keys).distinct()
    for i, k in enumerate(reversed(keys)):
        found = found.join(halves.where(F.col("level") == i).select(F.col("name").alias(k), F.struct(*MEASURES).alias(f"of_{k}")), k, "left")
    used = F.coalesce("of_band", "of_language", "of_script")
    return found.select("band", "script", F.col("of_band").isNotNull().alias("own"), *[used[m][e].alias(f"{m}_{e}") for m in MEASURES for e in ("lo", "hi")])


def judge(docs: DataFrame, model_path: str, width: float = 2.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row."""
    m = written(measure(docs, model_path, id_col, text_col, lang_col), "quality")
    joined = m.join(written(bands(m), "bands"), ["band", "script"], "left")
    wide = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(SHORT)) / F.greatest(F.lit(1), F.col("n_words"))))
    inside = F.lit(True)
    for x, floor in MEASURES.items():
        lo, hi = F.col(f"{x}_lo"), F.col(f"{x}_hi")
        spread = F.lit(width) * (hi - lo) * F.when(F.col("own"), F.lit(1.0)).otherwise(wide)
        reach = F.greatest(spread, F.lit(floor) * wide)
        inside &= F.round(judged(x), 3).between(lo - reach, hi + reach * (2 if x == "token_entropy" else 1))
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passed = ~F.col("outside") & F.coalesce(inside, F.lit(True))
    return joined.select(*m.columns, failed.alias("base_failed"), (~failed & passed).alias("kept"))
