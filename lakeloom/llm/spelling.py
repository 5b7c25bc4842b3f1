"""Spelling variant grouping (operator 12).

Words that differ by one inserted, deleted or replaced code point are near; a
word's form is its most frequent near word where that one is frequent enough,
and its root is found by following forms.

Bloom-guided neighbourhoods. The vocabulary is counted in Spark. Blocked Bloom
filters (512-bit blocks, six bits a word) of the vocabulary are built in shards
by word length, each shard cut by the words' hash into filters of bounded size.
They are broadcast in rounds, each of at most ``round_bytes``, so what a task
holds is bounded whatever the vocabulary's size; a larger vocabulary takes more
rounds. Each word's edits are generated in numpy as hashes only: its deletions,
and its replacements by a greater code point (nearness is symmetric, so these
meet every pair exactly once; an insertion is the longer word's deletion). Of
all edits only those a filter lets through become strings; they are shuffled to
an exact join with the vocabulary, which removes the false positives.

Roots are found by pointer doubling. Along forms frequencies double at least,
so a chain has at most 63 steps and at most six rounds follow all of them.

Defined results: null or empty texts have no words; a null id is empty in the
damage's key; repeated rows count each; words shorter than ``min_chars`` or
rarer than ``min_count`` do not take part; an empty table gives no rows; other
columns are ignored. Words of 64 code points and more share a length shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import lower_ascii, text_of, written
from lakeloom.llm.words import mix

#: Fixed value: the letters of words.
RUN = "[A-Za-zÀ-ÿ]+"
#: Code points that an edit may bring in: the letters of lower-cased words.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
LONGEST = 64
BITS_PER_WORD = 24
BLOCK_BITS = 512
FILTER_WORDS = 1 << 14
#: Words whose edits one task probes.
PROBE_WORDS = 20_000
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
#: Edits of one chunk of words and places.
_CHUNK = 1 << 18


# ------------------------------------------------------------ the words
def damaged_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word): every run of letters, A-Z lower-cased; a run whose crc32 with its document's id 97 divides loses a code point."""
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # deleting shortens: runs below five code points never count
    runs = docs.select(doc.alias("doc"), F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    low = runs.select("doc", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return low.select(F.when(h % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of words that are long and frequent enough."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


# ------------------------------------------------------- hashes, filters
def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _STEP, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their code points as a matrix) of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        codes = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le"), np.uint32)
        yield at, codes.reshape(len(at), n).astype(np.uint64)


def word_hashes(words: list[str]) -> np.ndarray:
    """A polynomial over a word's code points; ``mix`` spreads it where bits are taken."""
    out = np.zeros(len(words), np.uint64)
    for at, codes in _by_length(words):
        out[at] = (codes * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)
    return out


def _places(mixed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(first 64-bit word of the block, bits for the places in it) of mixed hashes."""
    block = ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return (block * np.uint64(BLOCK_BITS // 64)).astype(np.int64), mix(mixed + np.uint64(_STEP))


def _bit(places: np.ndarray, k: int) -> np.ndarray:
    return ((places >> np.uint64(9 * k)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


def _blocks(words: int) -> int:
    return max(1, -(-words * BITS_PER_WORD // BLOCK_BITS))


def _filter(table: pa.Table) -> pa.Table:
    """The blocked Bloom filter of one shard's hashes."""
    mixed = mix(table.column("hash").to_numpy().view(np.uint64))
    blocks = _blocks(len(mixed))
    bits = np.zeros(blocks * BLOCK_BITS // 64, np.uint64)
    base, places = _places(mixed, blocks)
    for k in range(6):
        bit = _bit(places, k)
        np.bitwise_or.at(bits, base + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return pa.table({"shard": table.column("shard")[:1], "part": table.column("part")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})


def _hashed(parts: dict[int, int]):
    """mapInArrow body: a word's hash, length shard and part of the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            h = word_hashes(words)
            shard = np.fromiter((min(len(w), LONGEST) for w in words), np.int32, len(words))
            part = _part(mix(h), np.array([parts[x] for x in shard.tolist()], np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), *map(pa.array, (h.view(np.int64), shard, part))], names=["word", "n", "hash", "shard", "part"])

    return run


def _part(mixed: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return mix(mixed ^ np.uint64(_BACK)) % parts


# --------------------------------------------------------------- probing
def _tested(hashes: np.ndarray, shard: int, parts: dict[int, int], filters: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """Which of the hashes a filter of this round lets through (their indexes)."""
    mixed = mix(hashes)
    found = []
    part = _part(mixed, np.uint64(parts[shard])) if parts[shard] > 1 else None
    for (s, p), bits in filters.items():
        if s != shard:
            continue
        at = np.arange(len(mixed)) if part is None else np.flatnonzero(part == p)
        base, places = _places(mixed[at], len(bits) * 64 // BLOCK_BITS)
        for k in range(6):  # most edits fail at the first or second bit
            bit = _bit(places, k)
            hit = (bits[base + (bit >> 6)] >> (bit & 63).astype(np.uint64)) & np.uint64(1) != 0
            at, base, places = at[hit], base[hit], places[hit]
        found.append(at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def edits_let_through(words: list[str], parts: dict[int, int], filters: dict[tuple[int, int], np.ndarray]) -> Iterator[tuple[int, str]]:
    """(row, edited word) of each deletion, and each replacement by a greater code point, that a filter lets through."""
    shards = {s for s, _ in filters}
    for at, codes in _by_length(words):
        n = codes.shape[1]
        same, shorter = min(n, LONGEST), min(n - 1, LONGEST)
        if not shards & {same, shorter}:
            continue
        power = _powers(n)
        step = max(1, _CHUNK // (len(ALPHABET) * n))
        places = max(1, _CHUNK // len(ALPHABET))
        for i in range(0, len(at), step):
            rows, c = at[i : i + step], codes[i : i + step]
            terms = c * power[:-1]
            before = np.cumsum(terms, axis=1, dtype=np.uint64)
            whole = before[:, -1:]
            if shorter in shards:  # of a run of equal code points only the first is deleted
                gone = (before - terms) + (whole - before) * np.uint64(_BACK)
                first = np.ones(c.shape, bool)
                first[:, 1:] = c[:, 1:] != c[:, :-1]
                r, p = np.nonzero(first)
                for j in _tested(gone[r, p], shorter, parts, filters):
                    w = words[rows[r[j]]]
                    yield int(rows[r[j]]), w[: p[j]] + w[p[j] + 1 :]
            if same in shards:
                for lo in range(0, n, places):
                    part = c[:, lo : lo + places]
                    r, p, a = np.nonzero(ALPHABET[None, None, :] > part[:, :, None])
                    put = whole[r, 0] + (ALPHABET[a] - part[r, p]) * power[lo + p]
                    for j in _tested(put, same, parts, filters):
                        w, q = words[rows[r[j]]], lo + p[j]
                        yield int(rows[r[j]]), w[:q] + chr(ALPHABET[a[j]]) + w[q + 1 :]


def _probes(parts, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: np.frombuffer(v, np.uint64) for k, v in shared.value.items()}
        for b in batches:
            words, n = b.column("word").to_pylist(), b.column("n").to_pylist()
            for i in range(0, len(words), 512):
                got = list(edits_let_through(words[i : i + 512], parts, filters))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([words[i + r] for r, _ in got]), pa.array([n[i + r] for r, _ in got], pa.int64()), pa.array([x for _, x in got])], names=["word", "n", "edit"])

    return run


def near_pairs(vocab: DataFrame, filter_words: int = FILTER_WORDS, round_bytes: int = 64 << 20) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words of ``vocab`` (word, n) once."""
    spark = vocab.sparkSession
    length = F.least(F.length("word"), F.lit(LONGEST))
    sizes = dict(vocab.groupBy(length.alias("shard")).count().collect())  # LONGEST rows at most
    parts = {s: -(-n // filter_words) for s, n in sizes.items()}
    hashed = written(vocab.mapInArrow(_hashed(parts), "word string, n long, hash long, shard int, part int"), "vocabulary-hashes")
    most = _blocks(2 * filter_words) * BLOCK_BITS // 8  # a filter is cut by hash, so it may be somewhat larger than planned
    per_round = max(1, round_bytes // most)
    units = [(s, p) for s in sorted(parts) for p in range(parts[s])]
    probed = []
    for i in range(0, len(units), per_round):
        now = units[i : i + per_round]
        low, high = now[0], now[-1]
        unit = F.struct("shard", "part")
        mine = hashed.where(unit.between(F.struct(*map(F.lit, low)), F.struct(*map(F.lit, high)))).select("hash", "shard", "part")
        rows = mine.groupBy("shard", "part").applyInArrow(_filter, "shard int, part int, bits binary").collect()  # round_bytes at most
        shared = spark.sparkContext.broadcast({(r.shard, r.part): bytes(r.bits) for r in rows})
        shards = sorted({s for s, _ in now})
        ends = sorted({x for s in shards for x in (s, s + 1)} | ({LONGEST} if LONGEST in shards else set()))
        probing = hashed.where(F.col("shard").isin(ends)).select("word", "n")
        tasks = max(1, -(-sum(sizes.get(e, 0) for e in ends) // PROBE_WORDS))  # the work is in the edits, not in the bytes
        probed.append(written(probing.repartition(tasks, "word").mapInArrow(_probes(parts, shared), "word string, n long, edit string"), "edits"))
        shared.unpersist()
    if not probed:
        return vocab.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("word").alias("b"), F.col("n").alias("b_n")).limit(0)
    edits = probed[0]
    for more in probed[1:]:
        edits = edits.union(more)
    exact = hashed.select(F.col("word").alias("edit"), F.col("n").alias("b_n"))
    return edits.join(exact, "edit").select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("edit").alias("b"), "b_n")


# ---------------------------------------------------------------- forms
def variants(words: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2, filter_words: int = FILTER_WORDS, round_bytes: int = 64 << 20) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``words`` (word), one row per distinct word that takes part."""
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, so that forms end")
    vocab = written(vocabulary(words, min_chars, min_count), "vocabulary")
    pairs = written(near_pairs(vocab, filter_words, round_bytes), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    has = F.col("near_n") >= ratio * F.col("n")
    forms = written(known.select("word", F.when(has, F.col("near")).alias("form"), "n", "n_near", F.when(has, F.col("near_n")).alias("form_n")), "forms")
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    moving = True
    while moving:  # pointer doubling: six rounds at most
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = written(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moving = not jumped.where("moved").isEmpty()
        roots = jumped.select("word", "root")
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
