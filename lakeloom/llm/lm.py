"""LM scoring by deleted interpolation (operator 7).

A word bigram model. The maximum-likelihood estimates of bigram, unigram and
a uniform distribution are mixed with weights that depend on a bucket of the
context's frequency (its power of two); the weights are learned by
expectation-maximisation on held-out counts: each training token in turn is
deleted from the counts it is predicted with.

How it runs: documents are coded into blocks (a block's distinct words and
its tokens as numbers), written once. Each block sends its distinct words and
bigrams, with their training counts, to buckets of the hash space; a bucket
sums them over all blocks and returns the totals to each block. A bigram that
occurs in every block is one entry a block, so no key is hot. The totals meet
the block's tokens by a cogroup on the block's number. The EM works on a
histogram of all training tokens over (context bucket, quarter octaves of
both estimates), whose size is bounded (under 2 million cells, whatever the
input) and which alone reaches the driver.

Defined results: null and empty texts have the end token only; a null id's
text is empty, so its remainder is 0; repeated rows are scored each and count
each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import NO_ID, id_of, text_of, written
from lakeloom.llm.words import combined, mix, pack, pack_sorted, text_buffer, unpack, unpack_sorted, word_hashes

_END = mix(np.array([0x454E44], np.uint64))
_BLOCK = "block long, ids binary, sizes binary, words binary, tokens binary, n_train long"
_BINS = 192  # quarter octaves; 0 is the estimate 0


def _held(ids: np.ndarray, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i == NO_ID else b"%d" % i) % folds == 0 for i in ids.tolist()], bool)


def _blocks(block_words: int, folds: int):
    def coded(n, ids, words, counts):
        ids, counts, words = np.concatenate(ids), np.concatenate(counts), np.concatenate(words)
        sizes = counts + 1
        ends = np.cumsum(sizes) - 1
        tokens = np.empty(len(words) + len(ids), np.uint64)
        is_end = np.zeros(len(tokens), bool)
        is_end[ends] = True
        tokens[is_end], tokens[~is_end] = _END[0], words
        distinct, code = np.unique(tokens, return_inverse=True)
        n_train = int(sizes[~_held(ids, folds)].sum())
        row = [n, pack(ids), pack(sizes.astype(np.uint32)), pack_sorted(distinct), pack(code.astype(np.uint32)), n_train]
        return pa.RecordBatch.from_pylist([dict(zip(_names, row, strict=True))], pa.schema([(c, pa.int64() if c in ("block", "n_train") else pa.binary()) for c in _names]))

    _names = ["block", "ids", "sizes", "words", "tokens", "n_train"]

    def run(batches):
        from pyspark import TaskContext

        n, ids, words, counts, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        for b in batches:
            data, offsets = text_buffer(b.column("text"))
            w, c = word_hashes(data, offsets)
            d = b.column("doc").to_numpy(zero_copy_only=False)
            while len(d):  # whole documents, as many as reach the block's size
                k = int(np.searchsorted(np.cumsum(c + 1), block_words - size)) + 1  # empty texts have their end
                m = int(c[:k].sum())
                ids.append(d[:k]), words.append(w[:m]), counts.append(c[:k])
                size += m + len(d[:k])
                d, w, c = d[k:], w[m:], c[k:]
                if size >= block_words:
                    yield coded(n, ids, words, counts)
                    n, ids, words, counts, size = n + 1, [], [], [], 0
        if ids:
            yield coded(n, ids, words, counts)

    return run


def _tokens(row: dict, folds: int):
    """(word hashes, code of each token, code of its context, is it for training)."""
    words, code = unpack_sorted(row["words"]), unpack(row["tokens"], np.uint32)
    sizes, ids = unpack(row["sizes"], np.uint32), unpack(row["ids"], np.int64)
    before = np.empty(len(code), np.uint32)
    before[1:] = code[:-1]
    before[0] = np.searchsorted(words, _END)[0]  # a document's first context is the end before it
    train = np.repeat(~_held(ids, folds), sizes)
    return words, code, before, train


def _bigrams(words, code, before):
    return np.unique(combined([words[before], words[code]]), return_inverse=True)


def _parts(buckets: int, folds: int):
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                words, code, before, train = _tokens(row, folds)
                pairs, pair = _bigrams(words, code, before)
                for kind, keys, of in ((1, words, code), (2, pairs, pair)):
                    n = np.bincount(of, weights=train, minlength=len(keys)).astype(np.uint32)
                    cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    some = [(i, a, z) for i, (a, z) in enumerate(zip(cut, cut[1:], strict=False)) if z > a]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([kind] * len(some), pa.int32()), pa.array([i for i, _, _ in some], pa.int32()), pa.array([row["block"]] * len(some), pa.int64()),
                            pa.array([pack_sorted(keys[a:z]) for _, a, z in some], pa.binary()), pa.array([pack(n[a:z]) for _, a, z in some], pa.binary()),
                        ],
                        names=["kind", "bucket", "block", "keys", "n"],
                    )

    return run


_TOTALS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.binary()), ("seen", pa.int64())])


def _summed(t: pa.Table) -> pa.Table:
    """A bucket's totals for each block; the row of block -1 has the number of distinct keys seen in training."""
    kind, bucket = t.column("kind")[0].as_py(), t.column("bucket")[0].as_py()
    keys = [unpack_sorted(x.as_py()) for x in t.column("keys")]
    distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(of, weights=np.concatenate([unpack(x.as_py(), np.uint32) for x in t.column("n")]), minlength=len(distinct))
    n = n.astype(np.uint64)
    out = [{"kind": kind, "bucket": bucket, "block": -1, "n": b"", "seen": int((n > 0).sum())}]
    for block, part in zip(t.column("block").to_pylist(), np.split(n[of], np.cumsum([len(k) for k in keys])[:-1]), strict=True):
        out.append({"kind": kind, "bucket": bucket, "block": block, "n": pack(part), "seen": 0})
    return pa.Table.from_pylist(out, _TOTALS)


_JOINED = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("c", pa.binary()), ("c2", pa.binary()), ("cells", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])


def _bin(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.clip(_BINS - 1 + np.round(4 * np.log2(x, where=x > 0, out=np.zeros_like(x))), 1, _BINS - 1), 0).astype(np.int64)


def _unbin(b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, 2.0 ** ((b - (_BINS - 1)) / 4), 0.0)


def _level(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0, then 1 + its power of two."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def _with_totals(total: int, folds: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        got = sorted(right.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        for row in left.to_pylist():
            words, code, before, train = _tokens(row, folds)
            pairs, pair = _bigrams(words, code, before)
            n1, n2 = (np.concatenate([unpack(r["n"], np.uint64) for r in got if r["kind"] == k]) for k in (1, 2))
            if len(n1) != len(words) or len(n2) != len(pairs):
                raise ValueError("a block and its counts don't match")
            c, v, c2 = n1[code].astype(float), n1[before].astype(float), n2[pair].astype(float)
            v1, c1, p1 = v[train] - 1, c[train] - 1, c2[train] - 1  # the token itself is deleted
            f2 = np.divide(p1, v1, out=np.zeros_like(p1), where=v1 > 0)
            cell, k = np.unique((_level(v1) * _BINS + _bin(f2)) * _BINS + _bin(c1 / max(1, total - 1)), return_counts=True)
            out.append({"block": row["block"], "ids": row["ids"], "sizes": row["sizes"], "c": pack(n1[code]), "c2": pack(n2[pair]), "cells": cell.tolist(), "tokens": k.tolist()})
        return pa.Table.from_pylist(out, _JOINED)

    return run


def mixture_weights(cells: np.ndarray, tokens: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of every context bucket, by EM."""
    level, f = cells // _BINS**2, np.stack([_unbin(cells // _BINS % _BINS), _unbin(cells % _BINS), np.full(len(cells), uniform)])
    w = np.full((3, 66), 1 / 3)
    w[:, 0] = [0, 0.5, 0.5]
    for _ in range(rounds):
        share = w[:, level] * f
        share *= tokens / np.maximum(share.sum(0), 1e-300)
        got = np.stack([np.bincount(level, weights=s, minlength=66) for s in share])
        seen = got.sum(0) > 0
        w[:, seen] = got[:, seen] / got[:, seen].sum(0)
    for i in range(1, 66):  # a bucket without tokens is like the one below it
        if not (level == i).any():
            w[:, i] = w[:, i - 1]
    return w


def _scored(total: int, distinct: int, weights: np.ndarray, folds: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, sizes = unpack(row["ids"], np.int64), unpack(row["sizes"], np.uint32).astype(np.int64)
                c, c2 = unpack(row["c"], np.uint64).astype(float), unpack(row["c2"], np.uint64).astype(float)
                start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                v = np.empty_like(c)
                v[1:] = c[:-1]
                v[0] = c[np.cumsum(sizes)[0] - 1]  # the end's count
                base = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
                w = weights[:, _level(v)]
                p = w[0] * np.divide(c2, v, out=np.zeros_like(v), where=v > 0) + w[1] * c / max(1, total) + w[2] / (distinct + 1)
                add = lambda x: np.add.reduceat(x, start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, mask=ids == NO_ID), pa.array(_held(ids, folds)), pa.array(sizes), pa.array(add((c > 0).astype(np.int64))),
                        pa.array(np.full(len(ids), total, np.int64)), pa.array(add(base)), pa.array(add(np.log10(p))),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, folds: int = 10, block_words: int = 1_000_000, bucket_entries: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Documents whose crc32(id as text) is divisible by ``folds`` are not
    learned from. ``block_words`` and ``bucket_entries`` bound a task's memory.
    """
    rows = docs.select(F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"), text_of(text_col).alias("text"))
    blocks = written(rows.mapInArrow(_blocks(block_words, folds), _BLOCK), "lm-blocks")
    total, n_blocks = blocks.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(8, -(-n_blocks * block_words // bucket_entries))
    sent = blocks.mapInArrow(_parts(buckets, folds), "kind int, bucket int, block long, keys binary, n binary")
    totals = written(sent.groupBy("kind", "bucket").applyInArrow(_summed, "kind int, bucket int, block long, n binary, seen long"), "lm-totals")
    distinct = totals.where("kind = 1 AND block = -1").agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    joined = written(
        blocks.groupBy("block").cogroup(totals.where("block >= 0").groupBy("block")).applyInArrow(_with_totals(total, folds), "block long, ids binary, sizes binary, c binary, c2 binary, cells array<long>, tokens array<long>"),
        "lm-joined",
    )
    cells = joined.select(F.explode(F.arrays_zip("cells", "tokens")).alias("x")).groupBy("x.cells").agg(F.sum("x.tokens").alias("n")).collect()
    cell, n = (np.array([r[i] for r in cells], np.int64) for i in (0, 1))
    order = np.argsort(cell)
    weights = mixture_weights(cell[order], n[order], 1 / (distinct + 1))
    return joined.select("ids", "sizes", "c", "c2").mapInArrow(
        _scored(total, distinct, weights, folds), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
