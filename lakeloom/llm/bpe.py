"""BPE encoding and decoding by a distinct-word table (operator 9).

Texts are split into words (white space goes with the word after it, where a
byte-level BPE never merges across). Documents form blocks; a block's distinct
words go, packed, to buckets of the hash space. Each bucket is a part of the
distinct-word table: it encodes every distinct word once, whatever the number
of blocks it comes from, and returns the ids to the blocks, where they are
joined back by position. A word that every document has is one entry a block,
so no key is hot. Blocks are known by a digest of their ids and words: the texts
are split twice and moved never, and a block that finds no ids fails the job
rather than give wrong ids.

Decoding joins ids to the vocabulary's pieces (a fixed small table, broadcast)
and reads the bytes as UTF-8, bad sequences as U+FFFD.

Defined results: null text counts as empty and has no ids; a null id stays
null; rows repeating an id are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import id_of, release, releasing, shuffle_partitions, text_of
from lakeloom.llm.vocabulary import SPACED_WORDS, byte_pieces, encoder, id_type, read, share
from lakeloom.llm.words import pack, unpack

#: Bytes of text whose distinct words one bucket of the word table has, about.
BUCKET_BYTES = 32 << 20


def _blocks(block_chars: int):
    """Yields (words of the block in order of appearance, [(id, codes of the document's words)])."""

    def run(batches):
        words, docs, size = {}, [], 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                t = t.as_py()
                docs.append((i, np.array([words.setdefault(w, len(words)) for w in SPACED_WORDS.findall(t)], np.uint32)))
                size += len(t) + 16  # empty texts have their ids at least
                if size >= block_chars:
                    yield words, docs
                    words, docs, size = {}, [], 0
        if docs:
            yield words, docs

    return run


def _join(words: list[str]) -> bytes:
    lengths = np.array([len(w) for w in words], np.uint32)
    return zstandard.compress(np.uint32(len(words)).tobytes() + lengths.tobytes() + "".join(words).encode(), 3)


def _cut(data: bytes) -> list[str]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    ends = np.cumsum(np.frombuffer(raw[4 : 4 + 4 * n], np.uint32)).tolist()
    text = raw[4 + 4 * n :].decode()
    return [text[a:z] for a, z in zip([0, *ends], ends, strict=False)]


def _name(words, docs) -> int:
    h = hashlib.blake2b(repr([i for i, _ in docs]).encode(), digest_size=8)
    for w in words:
        h.update(w.encode())
        h.update(b"\xff")
    return int.from_bytes(h.digest(), "little", signed=True)


def _bucket_of(words: list[str], buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) % buckets for w in words], np.int64)


def _word_parts(block_chars: int, buckets: int):
    def run(batches):
        for words, docs in _blocks(block_chars)(batches):
            listed = list(words)
            bucket = _bucket_of(listed, buckets)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
            block = _name(listed, docs)
            out = [(int(bucket[order[a]]), block, _join([listed[k] for k in order[a:z]])) for a, z in zip(cut, cut[1:], strict=False)]
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["bucket", "block", "words"])

    return run


def _encoded(vocabulary, dtype: str):
    """A bucket of the distinct-word table: every word once, its ids to each block that has it."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        enc = encoder(vocabulary.value, dtype)
        lists = [_cut(x.as_py()) for x in t.column("words")]
        enc.known.clear()  # no other bucket has this one's words
        known = enc.learn(dict.fromkeys(w for ws in lists for w in ws))
        size, out = enc.dtype.itemsize, []
        for block, bucket, ws in zip(t.column("block").to_pylist(), t.column("bucket").to_pylist(), lists, strict=True):
            ids = [known[w] for w in ws]
            out.append({"block": block, "bucket": bucket, "lengths": pack(np.array([len(x) // size for x in ids], np.uint32)), "ids": pack(np.frombuffer(b"".join(ids), enc.dtype))})
        enc.known.clear()  # the worker goes on to other stages
        release()
        return pa.Table.from_pylist(out, schema)

    return run


def _coded(block_chars: int):
    def run(batches):
        for words, docs in _blocks(block_chars)(batches):
            block = _name(words, docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(words)], pa.int64()), pa.array([[i for i, _ in docs]], pa.list_(pa.int64())), pa.array([pack(np.array([len(c) for _, c in docs], np.uint32))], pa.binary()), pa.array([pack(np.concatenate([c for _, c in docs]))], pa.binary()), pa.array([zstandard.compress(_bucket_order(words))], pa.binary())],
                names=["block", "n_words", "doc_ids", "sizes", "codes", "buckets"],
            )

    def _bucket_order(words):
        return b"".join((zlib.crc32(w.encode()) & 0xFFFFFFFF).to_bytes(4, "little") for w in words)

    return run


def _with_ids(dtype: str, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = {r["bucket"]: r for r in right.to_pylist()}  # blocks of equal ids and words have equal parts
        docs, out = [], []
        for row in left.to_pylist():
            crc = np.frombuffer(zstandard.decompress(row["buckets"]), "<u4")
            order = np.argsort(crc % buckets, kind="stable")  # the order in which the words were sent
            got = [parts[k] for k in sorted(parts)]
            lengths = np.concatenate([np.zeros(0, np.uint32), *(unpack(r["lengths"], np.uint32) for r in got)]).astype(np.int64)
            ids = np.concatenate([np.zeros(0, dtype), *(unpack(r["ids"], dtype) for r in got)]).astype("<u4")
            if len(lengths) != row["n_words"]:
                raise ValueError("a block's words were split in another way before; the input is not deterministic")
            starts = np.cumsum(lengths) - lengths
            start, size = np.empty_like(starts), np.empty_like(lengths)
            start[order], size[order] = starts, lengths
            codes, at = unpack(row["codes"], np.uint32), 0
            for i, n in zip(row["doc_ids"], unpack(row["sizes"], np.uint32).tolist(), strict=True):
                c = codes[at : at + n]
                at += n
                k = size[c]
                where = np.repeat(start[c] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
                docs.append(i)
                out.append(ids[where].tobytes())
        return pa.Table.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return run


def encode(docs: DataFrame, vocabulary_path: str, block_chars: int = 8_000_000, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids), one row per input row; ids are little-endian unsigned 32-bit integers.

    The ids are those of the tokenizers library for a byte-level BPE without
    truncation, padding and added special tokens.
    """
    spark = docs.sparkSession
    content = read(vocabulary_path)
    dtype = id_type(content)
    rows = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    if buckets is None:  # a bucket's words are a share of the text, whatever its size
        total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(8 * shuffle_partitions(spark), total // BUCKET_BYTES)
    parts = rows.mapInArrow(releasing(_word_parts(block_chars, buckets)), "bucket int, block long, words binary")
    table = parts.groupBy("bucket").applyInArrow(_encoded(share(spark, content), dtype), "block long, bucket int, lengths binary, ids binary")
    coded = rows.mapInArrow(releasing(_coded(block_chars)), "block long, n_words long, doc_ids array<long>, sizes binary, codes binary, buckets binary")
    return coded.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_with_ids(dtype, buckets), "doc_id long, ids binary")


def _decoded(pieces, keep: list[str]):
    def run(batches):
        table = pieces.value
        for b in batches:
            texts = [b"".join([table[i] for i in np.frombuffer(x.as_py(), "<u4").tolist()]).decode(errors="replace") for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    return run


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, ids, text): ids joined to the vocabulary's pieces."""
    pieces = share(encoded.sparkSession, byte_pieces(read(vocabulary_path)))
    return encoded.select("doc_id", "ids").mapInArrow(releasing(_decoded(pieces, ["doc_id", "ids"])), "doc_id long, ids binary, text string")
