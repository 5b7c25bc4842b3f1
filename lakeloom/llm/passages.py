"""Substring dedup over FM-indexes (operator 11).

Words are removed that a window of ``size`` words covers whose word sequence
also starts in a document with a smaller id.

1. Blocks. Documents are packed into blocks of bounded bytes, written once.
   Words are 64-bit hashes of their bytes.
2. Shards by content. Every window belongs to its minimizer, the least hash of
   a run of seven words in it, and neighbouring windows of one minimizer form a
   passage. Equal windows have equal minimizers, so they meet in one shard, and
   a shard needs no other shard's index: work grows with the text, not with
   documents times shards. Minimizers that only one document id has are left
   out before passages are sent: one pass counts them by bucket, packed, each
   once a block. A minimizer of very many different contexts is dealt by whole
   windows in place of the minimizer, so no passage that a third of all
   documents vary makes a large shard.
3. FM-index per shard. The shard's distinct passages are one text; its suffixes
   are sorted by their first ``size`` symbols and more, its Burrows-Wheeler
   transform is kept as a wavelet matrix of packed bits with rank directories.
   Every passage is streamed through it: backward search over ``size`` words
   extends the match of every place at once to the threshold, and the interval
   of suffixes gives the least document of each match.
4. Intervals. Back in its block, a place whose match of ``size`` words has a
   smaller document covers these words; adjoining intervals are merged.

Every group is bounded: a block by its bytes (a longer document is a block of
its own), a bucket by its entries, a shard by its words. Two words, or two
passages of a block, whose 64-bit hashes are equal count as equal.

Defined results: null text counts as empty; texts of fewer words than ``size``
lose nothing; a null id is the smallest and rows of one id are one document (none
of them removes from another, whatever they repeat); repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import NO_ID, id_of, text_of, written
from lakeloom.llm.words import combined, mix, pack, pack_sorted, unpack, unpack_sorted, word_hashes

SIZE = 13
#: Words of a minimizer's runs.
GRAM = 7
#: Windows of a passage at most; contexts from which on a minimizer is dealt by windows.
LONGEST = 64
HOT = 64
_R = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


# ------------------------------------------------------------- FM-index
class FMIndex:
    """Backward search in a text of small integers (0 separates), for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, done = text.astype(np.int64), 1
        order = np.argsort(rank)
        while done < depth:
            key = rank * np.int64(n + 2)
            key[: n - done] += rank[done:] + 1
            order = np.argsort(key)
            key = key[order]
            first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            # a suffix' rank is where its group begins, so the intervals of ``done`` words can be kept
            rank[order] = np.repeat(first, np.diff(np.append(first, n)))
            done *= 2
            if done <= depth:
                self.tail, self.tails = done, rank.copy()
                self.tail_end = np.zeros(n + 1, np.int64)
                self.tail_end[first] = np.append(first[1:], n)
        self.suffixes = order
        last = text[order - 1]
        symbols = int(text.max()) + 1 if n else 1
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        # wavelet matrix: one packed bit vector a level, the zeros of each level before its ones
        self.levels = []
        for level in reversed(range(max(1, (symbols - 1).bit_length()))):
            bit = (last >> level) & 1
            packed = np.packbits(np.concatenate([bit, np.zeros(128 - n % 64, bit.dtype)]).astype(np.uint8), bitorder="little")
            words = packed[: len(packed) // 8 * 8].view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((level, words, ones, n - int(bit.sum())))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        self.first = np.zeros(symbols, np.int64)
        self.first = self._down(np.arange(symbols), self.first)

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, words, ones, zeros in self.levels:
            w = at >> 6
            under = words[w] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            rank = ones[w] + np.bitwise_count(under)
            at = np.where((symbol >> level) & 1 == 1, zeros + rank, at - rank)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes once ``symbol`` is put before what they start with."""
        at = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.less[symbol] - self.first[symbol]
        return base + at[: len(symbol)], base + at[len(symbol) :]

    def matches(self, text: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics up to ``size``: for patterns of ``text`` that end ``size`` words after
        ``places``, (length matched from the end, interval of the suffixes that start with it)."""
        symbol = text[places + size - 1]
        low, high = self.less[symbol].copy(), self.less[symbol + 1].copy()
        length = (high > low).astype(np.int64)
        going = np.flatnonzero(length)
        for k in range(size - 2, -1, -1):
            a, b = self.step(text[places[going] + k], low[going], high[going])
            more = b > a
            going = going[more]
            low[going], high[going] = a[more], b[more]
            length[going] += 1
        return length, low, high

    def repeats(self, text: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of ``places`` of the index' own text start a string of ``size`` words that occurs elsewhere too,
        interval of the suffixes that start with it). A search begins with the interval of its last words, kept
        from the sorting, and ends once one suffix is left: that is the place itself."""
        tail = min(self.tail, size)
        low = self.tails[places + size - tail]
        high = self.tail_end[low]
        going = np.flatnonzero(high - low > 1)
        low, high = low[going], high[going]
        for k in range(size - tail - 1, -1, -1):
            low, high = self.step(text[places[going] + k], low, high)
            more = high - low > 1
            going, low, high = going[more], low[more], high[more]
        return going, low, high


# --------------------------------------------------------------- blocks
_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("z", pa.binary())])


def _blocks(block_bytes: int):
    """mapInArrow body: documents to blocks of at least ``block_bytes`` of text, but for the last one."""

    def block(n, ids, texts):
        row = {"block": n, "ids": pack(np.array(ids, np.int64)), "sizes": pack(np.array([len(t) for t in texts], np.uint64)), "z": zstandard.compress(b"".join(texts), 6)}
        return pa.RecordBatch.from_pylist([row], _BLOCK)

    def run(batches):
        from pyspark import TaskContext

        n, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for i, t in zip(b.column("doc").to_pylist(), b.column("text"), strict=True):
                ids.append(i)
                texts.append(t.as_py().encode())
                size += len(texts[-1]) + 16
                if size >= block_bytes:
                    yield block(n, ids, texts)
                    n, ids, texts, size = n + 1, [], [], 0
        if ids:
            yield block(n, ids, texts)

    return run


class _Prints:
    """Hashes of strings of words."""

    def __init__(self, words: np.ndarray):
        power, back = np.full(len(words) + 1, _R), np.full(len(words) + 1, _BACK)
        power[0] = back[0] = 1
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(power)[:-1], dtype=np.uint64)])
        self.back = np.cumprod(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(mix((self.sums[end] - self.sums[start]) * self.back[start]) + (end - start).astype(np.uint64))


class _Opened:
    """A block's words and passages."""

    def __init__(self, row: dict, size: int):
        self.data = np.frombuffer(zstandard.decompress(row["z"]), np.uint8)
        self.ids, sizes = unpack(row["ids"], np.int64), unpack(row["sizes"], np.uint64).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.words, self.counts = word_hashes(self.data, self.offsets, lower=False)
        self.doc = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        n, self.size, self.hashes = len(self.words), size, None
        self.run = self.end = self.name = np.zeros(0, np.int64)
        if n < size:
            return
        grams = combined([self.words[k : n - GRAM + 1 + k] for k in range(GRAM)])
        least = grams[: n - size + 1].copy()
        for k in range(1, size - GRAM + 1):
            np.minimum(least, grams[k : n - size + 1 + k], out=least)
        at = np.flatnonzero(self.doc[: n - size + 1] == self.doc[size - 1 :])  # the windows
        if not len(at):
            return
        name = least[at]
        new = np.ones(len(at), bool)
        new[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1] + 1)
        begun = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - begun) % LONGEST == 0
        first = np.flatnonzero(new)
        self.run = at[first]  # a passage's first window, and one past its last one
        self.end = self.run + np.diff(np.append(first, len(at)))
        self.name = name[first]

    def prints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.hashes is None:
            self.hashes = _Prints(self.words)
        return self.hashes.of(start, end)

    def seeds(self, bits: int):
        """(sorted distinct names, number of each passage's name, passages by name, first of each name)."""
        names = self.name.astype(np.uint64) >> np.uint64(64 - bits)
        return np.unique(names, return_inverse=True)


def _cut(keys: np.ndarray, buckets: int, bits: int) -> list[tuple[int, int, int]]:
    edges = np.array([(i << bits) // buckets for i in range(1, buckets)], np.uint64)
    at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(i, a, z) for i, (a, z) in enumerate(zip(at, at[1:], strict=False)) if z > a]


_SEEDS = "bucket int, block long, base long, keys binary, low binary, high binary, context binary, contexts binary"
_LIVE = "block long, bucket int, flags binary, n_live long"


def _seeded(size: int, buckets: int, bits: int):
    """mapInArrow body: a block's names with the least and greatest document id and a sample of their contexts."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                opened = _Opened(row, size)
                names, of = opened.seeds(bits)
                if not len(names):
                    continue
                ids = opened.ids[opened.doc[opened.run]]
                prints = opened.prints(opened.run, opened.end + size - 1)
                order = np.lexsort((prints, of))
                first = np.flatnonzero(np.diff(of[order], prepend=-1))
                low, high = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
                new = np.ones(len(of), bool)
                new[1:] = (of[order][1:] != of[order][:-1]) | (prints[order][1:] != prints[order][:-1])
                contexts = np.add.reduceat(new.astype(np.int64), first)
                base = int(low.min())
                relative = lambda x: x.astype(np.uint64) - np.uint64(base % 2**64)  # noqa: E731, B023
                columns = {"keys": names, "low": relative(low), "high": relative(high), "context": prints[order][first].astype(np.uint16), "contexts": np.minimum(contexts, 65535).astype(np.uint16)}
                parts = _cut(names, buckets, bits)
                out = {"bucket": pa.array([i for i, _, _ in parts], pa.int32()), "block": pa.array([row["block"]] * len(parts), pa.int64()), "base": pa.array([base] * len(parts), pa.int64())}
                for c, x in columns.items():
                    out[c] = pa.array([(pack_sorted if c == "keys" else pack)(x[a:z]) for _, a, z in parts], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return run


def _judged(t: pa.Table) -> pa.Table:
    """Of each name in a bucket whether documents of two ids have it, and whether its contexts are very many."""
    keys = [unpack_sorted(x.as_py()) for x in t.column("keys")]
    sizes = [len(k) for k in keys]
    bases = t.column("base").to_pylist()
    ids = lambda c: np.concatenate([unpack(x.as_py(), np.uint64) + np.uint64(b % 2**64) for x, b in zip(t.column(c), bases, strict=True)]).view(np.int64)
    small = lambda c: np.concatenate([unpack(x.as_py(), np.uint16) for x in t.column(c)])
    low, high, context, contexts = ids("low"), ids("high"), small("context"), small("contexts").astype(np.int64)
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    order = np.lexsort((context, of))
    start = np.diff(of[order], prepend=-1) != 0
    first = np.flatnonzero(start)
    other = start.copy()
    other[1:] |= context[order][1:] != context[order][:-1]
    live = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
    many = np.add.reduceat(other + contexts[order] - 1, first) > HOT
    flags = live.astype(np.uint8) + (live & many)
    parts = np.split(flags[of], np.cumsum(sizes)[:-1])
    return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "flags": pa.array([pack(x) for x in parts], pa.binary()), "n_live": pa.array([int((x > 0).sum()) for x in parts], pa.int64())})


class _Passages:
    """A block's distinct live passages, by shard, and the windows they stand for."""

    def __init__(self, opened: _Opened, answers: pa.Table, buckets: int, bits: int, shards: int):
        self.opened, size = opened, opened.size
        names, of = opened.seeds(bits)
        flags = {r["bucket"]: r["flags"] for r in answers.to_pylist()}
        flag = np.concatenate([np.zeros(0, np.uint8), *(unpack(flags[i], np.uint8) for i, _, _ in _cut(names, buckets, bits))])[of]
        whole, hot = flag == 1, flag == 2
        n_hot = (opened.end - opened.run)[hot]
        single = np.repeat(opened.run[hot], n_hot) + np.arange(n_hot.sum()) - np.repeat(np.cumsum(n_hot) - n_hot, n_hot)
        start = np.concatenate([opened.run[whole], single])
        end = np.concatenate([opened.end[whole], single + 1])  # windows
        prints = opened.prints(start, end + size - 1)
        # of one minimizer, or, where it is hot, of one window: the same in every block
        key = np.concatenate([names[of[whole]], prints[whole.sum() :]])
        shard = (mix(key) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((start, prints, shard))
        new = np.ones(len(order), bool)
        new[1:] = (prints[order][1:] != prints[order][:-1]) | (shard[order][1:] != shard[order][:-1])
        first = np.flatnonzero(new)
        ids = opened.ids[opened.doc[start]] if len(start) else np.zeros(0, np.int64)
        self.start, self.end, self.order = start, end, order
        self.of = np.cumsum(new) - 1  # of the ordered places the distinct passage
        self.first = order[first]
        self.shard = shard[self.first]
        self.least = np.minimum.reduceat(ids[order], first) if len(first) else ids
        self.windows = (end - start)[self.first]

    def parts(self) -> list[tuple[int, int, int]]:
        at = np.flatnonzero(np.diff(self.shard, prepend=-1, append=-1)).tolist()
        return [(int(self.shard[a]), a, z) for a, z in zip(at, at[1:], strict=False)]


_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("windows", pa.binary()), ("least", pa.binary())])


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each (start, size)."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _sent(size: int, buckets: int, bits: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            p = _Passages(_Opened(row, size), right, buckets, bits, shards)
            for shard, a, z in p.parts():
                first, windows = p.first[a:z], p.windows[a:z]
                words = p.opened.words[_spread(p.start[first], windows + size - 1)]
                rows.append({"shard": shard, "block": row["block"], "words": zstandard.compress(words.tobytes(), 3), "windows": pack(windows.astype(np.uint16)), "least": pack(p.least[a:z])})
        return pa.Table.from_pylist(rows, _SENT)

    return run


def _matched(size: int):
    """applyInArrow body: a shard's passages through its FM-index; the least document of each window."""

    def run(t: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), np.uint64) for x in t.column("words")])
        each = [unpack(x.as_py(), np.uint16).astype(np.int64) for x in t.column("windows")]
        windows = np.concatenate(each)
        least = np.concatenate([unpack(x.as_py(), np.int64) for x in t.column("least")])
        ends = np.cumsum(windows + size - 1)
        start = ends - windows - size + 1
        # blocks have passages in common: each is indexed once, with the least of its documents
        _, first, passage = np.unique(_Prints(words).of(start, ends), return_index=True, return_inverse=True)
        least_of = np.full(len(first), 2**63 - 1, np.int64)
        np.minimum.at(least_of, passage, least)
        n_windows = windows[first]
        # the text: passages one after another, a separator after each
        _, symbol = np.unique(words[_spread(start[first], n_windows + size - 1)], return_inverse=True)
        text = np.zeros(len(symbol) + len(first), np.int64)
        text[np.arange(len(symbol)) + np.repeat(np.arange(len(first)), n_windows + size - 1)] = symbol + 1
        owner = np.repeat(least_of, n_windows + size)
        index = FMIndex(text, size)
        offset = np.cumsum(n_windows) - n_windows
        places = _spread(offset + np.arange(len(first)) * size, n_windows)
        smallest = owner[places]  # of a match with nothing but itself
        again, low, high = index.repeats(text, places, size)
        if len(again):
            at, of = np.unique(low, return_inverse=True)
            upto = np.zeros(len(at), np.int64)
            upto[of] = high
            smallest[again] = np.minimum.reduceat(np.append(owner[index.suffixes], 2**63 - 1), np.column_stack([at, upto]).ravel())[::2][of]
        smallest = smallest[_spread(offset[passage], windows)]
        cuts = np.cumsum([int(x.sum()) for x in each])[:-1]
        return pa.table({"block": t.column("block"), "shard": t.column("shard"), "smallest": pa.array([pack(x) for x in np.split(smallest, cuts)], pa.binary())})

    return run


_DONE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))), ("kept", pa.string())])
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _covered(size: int, buckets: int, bits: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        judged = right.filter(pa.compute.equal(right.column("kind"), 1))
        found = {r["bucket"]: r["flags"] for r in right.filter(pa.compute.equal(right.column("kind"), 2)).to_pylist()}
        for row in left.to_pylist():
            opened = _Opened(row, size)
            gone = np.zeros(len(opened.words) + 1, np.int64)
            if len(opened.run):
                p = _Passages(opened, judged, buckets, bits, shards)
                smallest = np.concatenate([np.zeros(0, np.int64), *(unpack(found[shard], np.int64) for shard, _, _ in p.parts())])
                offset = np.cumsum(p.windows) - p.windows
                for i in range(0, len(p.order), 1 << 18):  # every place of a passage, in slices
                    at, of = p.order[i : i + (1 << 18)], p.of[i : i + (1 << 18)]
                    place = _spread(p.start[at], p.windows[of])
                    least = smallest[_spread(offset[of], p.windows[of])]
                    hit = place[least < opened.ids[opened.doc[place]]]
                    np.add.at(gone, hit, 1)
                    np.subtract.at(gone, np.minimum(hit + size, len(opened.words)), 1)
            gone = np.cumsum(gone)[:-1] > 0
            first = np.cumsum(opened.counts) - opened.counts
            for i, a, n, lo, hi in zip(opened.ids.tolist(), first.tolist(), opened.counts.tolist(), opened.offsets[:-1].tolist(), opened.offsets[1:].tolist(), strict=True):
                g = gone[a : a + n]
                edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                words = _split(opened.data[lo:hi])
                if len(edge):
                    words = [w for w, x in zip(words, g.tolist(), strict=True) if not x]
                spans = [{"first": int(x), "n": int(y - x)} for x, y in edge]
                out.append({"doc_id": None if i == NO_ID else i, "n_words": n, "n_removed": int(g.sum()), "spans": spans, "kept": b" ".join(words).decode()})
        return pa.Table.from_pylist(out, _DONE)

    return run


def _split(data: np.ndarray) -> list[bytes]:
    return data.tobytes().split()  # bytes split at exactly these six characters


def remove_passages(docs: DataFrame, size: int = SIZE, block_bytes: int = 2_000_000, bucket_entries: int = 1_000_000, shard_words: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans of removed words, kept text), one row per input row."""
    if size < GRAM:
        raise ValueError(f"windows must have {GRAM} words at least")
    rows = docs.select(F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"), text_of(text_col).alias("text"))
    blocks = written(rows.mapInArrow(_blocks(block_bytes), "block long, ids binary, sizes binary, z binary"), "word-blocks")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(64, 8 + max(24, int(total).bit_length()))
    buckets = max(8, -(-total // (24 * bucket_entries)))  # a name for four words, about
    names = blocks.mapInArrow(_seeded(size, buckets, bits), _SEEDS).groupBy("bucket").applyInArrow(_judged, _LIVE)
    names = written(names, "judged-names")
    live = names.agg(F.coalesce(F.sum("n_live"), F.lit(0))).first()[0]
    shards = max(8, -(-live * (size + 5) // shard_words))
    by_block = blocks.groupBy("block")
    sent = by_block.cogroup(names.groupBy("block")).applyInArrow(_sent(size, buckets, bits, shards), "shard int, block long, words binary, windows binary, least binary")
    matches = written(sent.groupBy("shard").applyInArrow(_matched(size), "block long, shard int, smallest binary"), "passage-matches")
    answers = names.select(F.lit(1).alias("kind"), "block", "bucket", "flags").union(matches.select(F.lit(2), "block", "shard", "smallest"))
    spans = "array<struct<first:long,n:long>>"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_covered(size, buckets, bits, shards), f"doc_id long, n_words long, n_removed long, spans {spans}, kept string")
