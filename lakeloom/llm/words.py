"""Words of whole texts as 64-bit hashes, computed in numpy over Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+``. A word's hash is a polynomial over its bytes
(each byte mapped to a random 64-bit value) followed by a bijective mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_AS_IS = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = _AS_IS.copy()
_LOWER[65:91] = _AS_IS[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 4 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = int(offsets[0]) if len(offsets) else 0
    return data[lo : int(offsets[-1])] if len(column) else data[:0], offsets - lo


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Parts of a batch with at most ``most`` bytes of text each, or one row."""
    size = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size)
    first = 0
    while first < len(size):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every document)."""
    table = _LOWER if lower else _AS_IS
    space = _SPACE[data]
    first = np.ones(len(data), bool)
    first[1:] = space[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(first & ~space)
    counts = np.diff(np.searchsorted(start, offsets))
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # in segments, cut between words
        j = max(i + 1, int(np.searchsorted(start, start[i] + _SEGMENT)))
        a, b = int(start[i]), int(start[j]) if j < len(start) else len(data)
        at = np.flatnonzero(~space[a:b])
        begin = np.searchsorted(at, start[i:j] - a)
        size = np.diff(np.append(begin, len(at)))
        inside = np.arange(len(at)) - np.repeat(begin, size)
        power = np.full(int(size.max()), _STEP, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        out[i:j] = np.add.reduceat(table[data[a:b][at]] * power[inside], begin)
        i = j
    return mix(out), counts


def combined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several aligned hashes; their order counts."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = mix(h * _STEP + p)
    return h


def windows(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside documents: (hash, document number, first word's number)."""
    n = len(words) - size + 1
    doc = np.repeat(np.arange(len(counts)), counts)
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return combined([words[at + k] for k in range(size)]), doc[at], at


def by_document(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The order by document, then key; document numbers are small (a batch's rows)."""
    order = np.argsort(keys)
    small = doc[order].astype(np.uint16) if len(doc) and doc.max() < 2**16 else doc[order]
    return order[np.argsort(small, kind="stable")]


def pack(values: np.ndarray) -> bytes:
    """Compressed integers; bytes of equal weight are laid side by side."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    return zstandard.compress(planes, 3)


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel() if len(planes) else np.zeros(0, dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
