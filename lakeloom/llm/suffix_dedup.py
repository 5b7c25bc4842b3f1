"""Suffix dedup with a difference cover (operator 2).

Bytes are removed that a string of ``length`` bytes covers which also starts
earlier in the corpus.

1. Dealing. Documents form blocks of bounded size, written once. Every string
   of ``length`` bytes belongs to its minimizer, the least hash of a run of
   ``GRAM`` bytes in it, and neighbouring strings of one minimizer form a
   passage. Equal strings have equal minimizers, so all suffixes that share
   their first ``length`` bytes meet in one shard: the shards are sorted apart
   and together they order all suffixes that can matter. Minimizers that occur
   once are left out first: blocks send their names, sorted and packed, to
   buckets of the hash space, each once a block, so a passage that every
   document has is one entry a block. A minimizer of very many different contexts
   is dealt by whole strings in place of the minimizer.
   A minimizer that only copies of one passage have leaves nothing to sort.
2. Sorting, by the difference-cover algorithm modulo 3. The suffixes at places
   1 and 2 modulo 3 are the sample: their triples are sorted and named, and
   while names repeat the algorithm recurses on the text of names. The remaining
   suffixes are sorted by their first byte and the sample that follows, and
   merged with the sample by the rank of the next sampled place that both reach.
3. Comparing. The first ``length`` bytes of suffixes adjacent in that order are
   compared as bytes; of equal ones the earliest start stays.
4. Back in its block each passage learns which of its strings start earliest
   where the passage first occurs there; all other occurrences are covered.

Every group is bounded: a block by its bytes (a longer document is a block of
its own), a bucket by its entries, a shard by its bytes. Strings are compared by
their bytes; only copies of whole passages are recognised by 128 bits of two
independent hashes, before they are sent and where blocks meet (the expected
number of clashes among 10^13 passages is 1.5*10^-13).

Defined results: null text counts as empty; texts shorter than ``length``
lose nothing; a null id is the smallest; of rows repeating an id the one
earlier in the written blocks comes first; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import NO_ID, id_of, release, releasing, text_of, written
from lakeloom.llm.passages import _blocks, _cut, _spread
from lakeloom.llm.words import mix, pack, pack_sorted, unpack, unpack_sorted

#: The sampled places; their differences are all numbers modulo 3.
COVER_MODULUS = 3
COVER = (1, 2)
#: Bytes of a minimizer, strings of a passage at most, contexts from which on a minimizer is dealt by strings.
GRAM, LONGEST, HOT = 32, 256, 2000

_VALUES = np.random.default_rng(23).integers(1, 2**64, 256, dtype=np.uint64)
_OTHER = np.random.default_rng(29).integers(1, 2**64, 256, dtype=np.uint64)
_R = 0x9E3779B97F4A7C15
_R2 = 0xD6E8FEB86659FD93
_FACTORS = np.random.default_rng(31).integers(1, 2**63, GRAM // 8 + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NAME_BITS = 48
_CHUNK = 1 << 14
_POWERS: dict[int, np.ndarray] = {}


def _powers(step: int, n: int) -> np.ndarray:
    """step**0 ... step**n modulo 2**64; short ones are kept by the worker."""
    have = _POWERS.get(step)
    if have is None or len(have) <= n:
        have = np.full(n + 1, step, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if n <= 1 << 20:
            _POWERS[step] = have
    return have[: n + 1]


class _Windows:
    """Fingerprints of strings of a block's bytes."""

    def __init__(self, data: np.ndarray, values: np.ndarray = _VALUES, step: int = _R):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * _powers(step, len(data))[:-1], out=self.sums[1:])
        self.back = _powers(pow(step, -1, 2**64), len(data))

    def at(self, places: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[places + length] - self.sums[places]) * self.back[places])


def prints(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the ``size`` bytes at each place."""
    at = np.cumsum(size) - size
    data = data[_spread(start, size)]
    return mix(_Windows(data).at(at, size) + size.astype(np.uint64)), _Windows(data, _OTHER, _R2).at(at, size)


# ------------------------------------------------- the suffix array of a shard
def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of ``text`` (positive integers below 2**31) in the order of their suffixes, by the difference cover modulo 3."""
    n = len(text)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.zeros(n + 3, np.int64)
    s[:n] = text
    top = int(s.max()) + 1
    # a sampled place beyond the end keeps the two halves of the sample apart
    place = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    first = s[place] * top + s[place + 1]
    if top < 2**20:
        key = first * top + s[place + 2]
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort((s[place + 2], first))
        a, b = first[order], s[place + 2][order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    name = np.empty(len(place), np.int64)
    name[order] = np.cumsum(new)
    key = first = None  # not kept through the recursion
    if not new.all():  # names repeat: sort the suffixes of the text of names
        new = order = None
        order = suffix_array(name)
        name[order] = np.arange(1, len(place) + 1)
    rank = np.zeros(n + 3, np.int64)  # of the sample's places; beyond the end: 0
    rank[place] = name
    sampled = place[order]
    sampled = sampled[sampled < n]
    # the rest: by the first symbol and the sample that follows
    rest = np.arange(0, n, 3)
    much = len(place) + 2
    rest_key = s[rest] * much + rank[rest + 1]
    by = np.argsort(rest_key)
    rest, rest_key = rest[by], rest_key[by]
    # merged: places 1 modulo 3 compare by one symbol and a rank, places 2 by two symbols and a rank
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(s[one] * much + rank[one + 1], rest_key)
    pair = lambda i: (s[i] * top + s[i + 1]) * much + rank[i + 2]
    if top < 2**20:
        before += np.searchsorted(pair(two), pair(rest))
    else:  # such keys don't fit 64 bits: name the pairs of symbols first
        pairs = np.concatenate([s[two] * top + s[two + 1], s[rest] * top + s[rest + 1]])
        pairs = np.unique(pairs, return_inverse=True)[1] * much
        before += np.searchsorted(pairs[: len(two)] + rank[two + 2], pairs[len(two) :] + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = np.arange(len(rest)) + before
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sampled
    return out


def equal_neighbours(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at each place are those at the place before it in the list."""
    same = np.ones(max(0, len(places) - 1), bool)
    word = np.lib.stride_tricks.sliding_window_view(text, 8)
    for k in [*range(0, length - 8, 8), length - 8]:
        at = np.flatnonzero(same)
        if not len(at):
            break
        same[at] = (word[places[at] + k] == word[places[at + 1] + k]).all(axis=1)
    return np.concatenate([[False], same]) if len(places) else np.zeros(0, bool)


# --------------------------------------------------------------- blocks
def minimizers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least hash of ``GRAM`` bytes in each string of ``length`` bytes: (places where another one is least than
    in the string before, these hashes, places where the same hash is found at another place than before)."""
    n, wide = len(data) - length + 1, length - GRAM + 1
    changes, names, moves, last = [], [], [], None
    for a in range(0, n, _CHUNK):  # only a chunk's strings are in memory, and they fit the processor's cache
        b = min(n, a + _CHUNK)
        word = np.lib.stride_tricks.sliding_window_view(data[a : b + length - 1], 8).copy().view("<u8").ravel()
        grams = word[: b - a + wide - 1] * _FACTORS[0]
        for k in range(8, GRAM, 8):
            grams += word[k : k + len(grams)] * _FACTORS[k // 8]
        grams ^= grams >> np.uint64(29)
        grams *= _FACTORS[-1]
        # the place in the chunk in the low bits: of equal hashes the first place is the least
        grams &= ~np.uint64(0xFFFF)
        grams |= np.arange(len(grams), dtype=np.uint64)
        have = 1
        while 2 * have <= wide:  # the least of ``wide`` neighbours, by doubling
            grams = np.minimum(grams[:-have], grams[have:])
            have *= 2
        if have < wide:
            grams = np.minimum(grams[: b - a], grams[wide - have : wide - have + b - a])
        name, place = grams >> np.uint64(16), (grams & np.uint64(0xFFFF)).astype(np.int32)
        other, moved = np.ones(len(name), bool), np.ones(len(name), bool)
        other[1:], moved[1:] = name[1:] != name[:-1], place[1:] != place[:-1]
        if last is not None:
            other[0], moved[0] = name[0] != last[0], a + int(place[0]) != last[1]
        last = name[-1], a + int(place[-1])
        at = np.flatnonzero(other)
        changes.append(at + a)
        names.append(name[at])
        moves.append(np.flatnonzero(moved & ~other) + a)
    return np.concatenate(changes), np.concatenate(names), np.concatenate(moves)


class _Opened:
    """A block's bytes and its passages."""

    def __init__(self, row: dict, length: int):
        self.data = np.frombuffer(zstandard.decompress(row["z"]), np.uint8)
        self.ids, sizes = unpack(row["ids"], np.int64), unpack(row["sizes"], np.uint64).astype(np.int64)
        self.ends = np.cumsum(sizes)
        self.starts, self.sizes, self.length = self.ends - sizes, sizes, length
        self.run = self.end = np.zeros(0, np.int64)
        self.name = np.zeros(0, np.uint64)
        self.again = np.zeros(0, bool)
        long = self.sizes >= length
        if not long.any():
            return
        changes, names, moves = minimizers(self.data, length)
        # strings lie within documents: from their starts, as long as ``length`` bytes are left
        begin, over = self.starts[long], self.ends[long] - length + 1
        cut = np.union1d(np.concatenate([changes, over]), begin)
        size = np.diff(np.append(cut, len(self.data)))
        doc = np.searchsorted(begin, cut, side="right") - 1
        inside = (doc >= 0) & (cut < over[doc])
        first, size = cut[inside], size[inside]
        if size.max() > LONGEST:
            pieces = -(-size // LONGEST)
            end = np.repeat(first + size, pieces)
            first = np.repeat(first, pieces) + LONGEST * _spread(np.zeros(len(pieces), np.int64), pieces)
            size = np.minimum(LONGEST, end - first)
        self.run, self.end = first, first + size
        self.name = names[np.searchsorted(changes, first, side="right") - 1]
        # strings that repeat in a passage have their minimizers at different places
        self.again = np.searchsorted(moves, self.end) > np.searchsorted(moves, self.run, side="right")

    def contexts(self) -> np.ndarray:
        """16 bits of each passage's first and last bytes and its size."""
        word = np.lib.stride_tricks.sliding_window_view(self.data, 8)
        size = self.end - self.run + self.length - 1
        first, last = (word[at].view("<u8").ravel() for at in (self.run, self.run + size - 8))
        return mix(first * _FACTORS[0] + last * _FACTORS[1] + size.astype(np.uint64)).astype(np.uint16)

    def seeds(self, bits: int):
        return np.unique(self.name >> np.uint64(NAME_BITS - bits), return_inverse=True)


_SEEDS = "bucket int, block long, keys binary, twice binary, context binary, contexts binary"
_LIVE = "block long, bucket int, flags binary, n_live long"


def _seeded(length: int, buckets: int, bits: int):
    """mapInArrow body: a block's names, whether they occur there twice, and a sample of their contexts."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                opened = _Opened(row, length)
                names, of = opened.seeds(bits)
                if not len(names):
                    continue
                context = opened.contexts()
                order = np.lexsort((context, of))
                first = np.flatnonzero(np.diff(of[order], prepend=-1))
                new = np.ones(len(of), bool)
                new[1:] = (of[order][1:] != of[order][:-1]) | (context[order][1:] != context[order][:-1])
                runs = np.diff(np.append(first, len(of)))
                columns = {
                    "keys": names, "twice": ((runs > 1) | np.maximum.reduceat(opened.again[order], first)).astype(np.uint8),
                    "context": context[order][first], "contexts": np.minimum(np.add.reduceat(new.astype(np.int64), first), 65535).astype(np.uint16)}
                parts = _cut(names, buckets, bits)
                out = {"bucket": pa.array([i for i, _, _ in parts], pa.int32()), "block": pa.array([row["block"]] * len(parts), pa.int64())}
                for c, x in columns.items():
                    out[c] = pa.array([(pack_sorted if c == "keys" else pack)(x[a:z]) for _, a, z in parts], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return run


def _judged(t: pa.Table) -> pa.Table:
    """Of each name in a bucket whether it occurs twice in the corpus, and whether its contexts are very many."""
    keys = [unpack_sorted(x.as_py()) for x in t.column("keys")]
    read = lambda c, kind: np.concatenate([unpack(x.as_py(), kind) for x in t.column(c)])
    twice, context, contexts = read("twice", np.uint8), read("context", np.uint16), read("contexts", np.uint16).astype(np.int64)
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    order = np.lexsort((context, of))
    start = np.diff(of[order], prepend=-1) != 0
    first = np.flatnonzero(start)
    other = start.copy()
    other[1:] |= context[order][1:] != context[order][:-1]
    live = (np.diff(np.append(first, len(of))) > 1) | (np.maximum.reduceat(twice[order], first) > 0)
    many = np.add.reduceat(other + contexts[order] - 1, first) > HOT
    flags = live.astype(np.uint8) + (live & many)
    parts = np.split(flags[of], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "flags": pa.array([pack(x) for x in parts], pa.binary()), "n_live": pa.array([int((x > 0).sum()) for x in parts], pa.int64())})


class _Passages:
    """A block's distinct passages that may occur elsewhere, by shard, and where they occur in the block."""

    def __init__(self, opened: _Opened, answers: pa.Table, buckets: int, bits: int, shards: int):
        self.opened, length = opened, opened.length
        names, of = opened.seeds(bits)
        flags = {r["bucket"]: r["flags"] for r in answers.to_pylist()}
        flag = np.concatenate([np.zeros(0, np.uint8), *(unpack(flags[i], np.uint8) for i, _, _ in _cut(names, buckets, bits))])[of]
        whole, hot = flag == 1, flag == 2
        n_hot = (opened.end - opened.run)[hot]
        single = _spread(opened.run[hot], n_hot)
        self.start = np.concatenate([opened.run[whole], single])
        self.end = np.concatenate([opened.end[whole], single + 1])
        if not len(self.start):
            self.order = self.of = self.first = self.shard = self.strings = np.zeros(0, np.int64)
            return
        a, b = prints(opened.data, self.start, self.end - self.start + length - 1)
        # dealt by the minimizer, or, where that is hot, by the string: the same in every block
        self.key = key = np.concatenate([names[of[whole]], a[whole.sum() :]])
        self.again = np.concatenate([opened.again[whole], np.zeros(len(single), bool)])
        shard = (mix(key) % np.uint64(shards)).astype(np.int64)
        doc = np.searchsorted(opened.ends, self.start, side="right")
        rank = np.empty(len(opened.ids), np.int64)  # documents by id, then as they lie in the block
        rank[np.argsort(opened.ids, kind="stable")] = np.arange(len(opened.ids))
        self.doc = doc
        self.order = np.lexsort((self.start, rank[doc], b, a, shard))
        new = np.ones(len(self.order), bool)
        new[1:] = np.any([x[self.order][1:] != x[self.order][:-1] for x in (shard, a, b)], axis=0)
        self.of = np.cumsum(new) - 1
        self.first = self.order[new]  # where each distinct passage starts first in the block
        self.shard = shard[self.first]
        self.strings = (self.end - self.start)[self.first]

    def parts(self) -> list[tuple[int, int, int]]:
        at = np.flatnonzero(np.diff(self.shard, prepend=-1, append=-1)).tolist()
        return [(int(self.shard[a]), a, z) for a, z in zip(at, at[1:], strict=False)]


_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("passages", pa.binary())])
#: A row's passages: strings, whether some of them repeat in the passage, document, place and minimizer of each; then their bytes.
_FIELDS = (("strings", np.uint16), ("again", np.uint8), ("ids", np.int64), ("places", np.int64), ("keys", np.uint64))


def _sent(length: int, buckets: int, bits: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            p = _Passages(_Opened(row, length), right, buckets, bits, shards)
            for shard, a, z in p.parts():
                # in the order of the text, so that passages side by side compress together
                by = a + np.argsort(p.start[p.first[a:z]])
                at = p.first[by]
                values = p.strings[by], p.again[at], p.opened.ids[p.doc[at]], p.start[at], p.key[at]
                raw = [v.astype(kind).tobytes() for v, (_, kind) in zip(values, _FIELDS, strict=True)]
                raw.append(p.opened.data[_spread(p.start[at], p.strings[by] + length - 1)].tobytes())
                rows.append({"shard": shard, "block": row["block"], "n": z - a, "passages": zstandard.compress(b"".join(raw), 3)})
            p = None
            release()
        return pa.Table.from_pylist(rows, _SENT)

    return run


def _received(t: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The fields of a shard's passages and their bytes, row after row."""
    fields, data = {c: [] for c, _ in _FIELDS}, []
    for n, blob in zip(t.column("n").to_pylist(), t.column("passages"), strict=True):
        raw, at = zstandard.decompress(blob.as_py()), 0
        for c, kind in _FIELDS:
            fields[c].append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        data.append(np.frombuffer(raw, np.uint8, offset=at))
    return {c: np.concatenate(x) for c, x in fields.items()}, np.concatenate(data)


def _sorted(length: int):
    """applyInArrow body: a shard's suffixes sorted; of each passage's strings those that start earliest where its block says."""

    def run(t: pa.Table) -> pa.Table:
        fields, data = _received(t)
        strings, ids, places = fields["strings"].astype(np.int64), fields["ids"], fields["places"]
        sizes = t.column("n").to_numpy()
        block = np.repeat(t.column("block").to_numpy(), sizes)
        ends = np.cumsum(strings + length - 1)
        start = ends - strings - length + 1
        # blocks have passages in common: each is sorted once, as of its earliest occurrence
        keys = *prints(data, start, ends - start), strings
        order = np.lexsort((places, block, ids, *keys))
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        first = order[new]
        # a minimizer all of whose occurrences lie in copies of one passage leaves nothing to sort:
        # each of its strings starts earliest where the passage does
        _, of, contents = np.unique(fields["keys"][first], return_inverse=True, return_counts=True)
        several = (contents[of] > 1) | (fields["again"][first] > 0)
        n = strings[first]
        offset = np.cumsum(n) - n
        bit = np.ones(int(n.sum()), bool)
        sort = np.flatnonzero(several)
        if len(sort):
            bit[_spread(offset[sort], n[sort])] = _earliest(data, start[first[sort]], n[sort], length, ids[first[sort]], block[first[sort]], places[first[sort]])
        # only the occurrence that was sorted can start earliest
        is_first = np.zeros(len(strings), bool)
        is_first[first] = True
        number = np.empty(len(strings), np.int64)
        number[order] = np.cumsum(new) - 1
        flat = bit[_spread(offset[number], strings)] & np.repeat(is_first, strings)
        total = np.cumsum(np.add.reduceat(strings, np.cumsum(sizes) - sizes))
        fields = data = None
        release()
        parts = np.split(flat, total[:-1])
        return pa.table({"block": t.column("block"), "shard": t.column("shard"), "bits": pa.array([np.packbits(x).tobytes() for x in parts], pa.binary())})

    return run


def _earliest(data: np.ndarray, start: np.ndarray, n: np.ndarray, length: int, ids: np.ndarray, block: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of the ``n`` strings of each passage (at ``start`` in ``data``), one after another, which start
    earliest there; ``ids``, ``block`` and ``places`` tell where the passages start."""
    text = np.zeros(int((n + length).sum()), np.uint8)  # a separator after each
    begin = np.cumsum(n + length) - n - length
    text[_spread(begin, n + length - 1)] = data[_spread(start, n + length - 1)] + 1  # no byte of UTF-8 is above 244
    array = suffix_array(text.astype(np.int64) + 1)
    string = np.zeros(len(text), bool)
    string[_spread(begin, n)] = True
    array = array[string[array]]  # places with ``length`` bytes left in their passage
    group = np.cumsum(~equal_neighbours(text, array, length))
    owner = np.searchsorted(begin, array, side="right") - 1
    inside = array - begin[owner]
    by = np.lexsort((places[owner] + inside, block[owner], ids[owner], group))
    first = by[np.diff(group[by], prepend=0) != 0]
    bit = np.zeros(int(n.sum()), bool)
    bit[(np.cumsum(n) - n)[owner[first]] + inside[first]] = True
    return bit


_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _removed(length: int, buckets: int, bits: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        judged = right.filter(pa.compute.equal(right.column("kind"), 1))
        found = {r["bucket"]: r["flags"] for r in right.filter(pa.compute.equal(right.column("kind"), 2)).to_pylist()}
        for row in left.to_pylist():
            opened = _Opened(row, length)
            covers = np.zeros(len(opened.data), bool)  # a string that starts there starts earlier elsewhere
            if len(opened.run):
                p = _Passages(opened, judged, buckets, bits, shards)
                earliest = np.zeros(int(p.strings.sum()), bool)
                offset = np.cumsum(p.strings) - p.strings
                for shard, a, z in p.parts():
                    by = a + np.argsort(p.start[p.first[a:z]])
                    to = _spread(offset[by], p.strings[by])
                    earliest[to] = np.unpackbits(np.frombuffer(found[shard], np.uint8))[: len(to)].astype(bool)
                is_first = np.zeros(len(p.start), bool)
                is_first[p.first] = True
                for i in range(0, len(p.order), 1 << 16):  # every occurrence of a passage, in slices
                    at, of = p.order[i : i + (1 << 16)], p.of[i : i + (1 << 16)]
                    place = _spread(p.start[at], p.strings[of])
                    stays = earliest[_spread(offset[of], p.strings[of])] & np.repeat(is_first[at], p.strings[of])
                    covers[place[~stays]] = True
            until = np.cumsum(covers, dtype=np.int64)
            until[length:] -= until[:-length].copy()
            gone = until > 0
            for i, a, n in zip(opened.ids.tolist(), opened.starts.tolist(), opened.sizes.tolist(), strict=True):
                g = gone[a : a + n]
                spans = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
                out.append({"doc_id": None if i == NO_ID else i, "n_bytes": n, "n_removed": int(g.sum()), "n_spans": spans, "kept": opened.data[a : a + n][~g].tobytes()})
        done = pa.Table.from_pylist(out, _DONE)
        out.clear()
        release()
        return done

    return run


def remove_repeats(docs: DataFrame, length: int = 100, block_bytes: int = 2_000_000, bucket_entries: int = 1_000_000, shard_bytes: int = 1_500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes left of every text, one row per input row."""
    if length <= GRAM:
        raise ValueError("strings must be longer than a minimizer")
    rows = docs.select(F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"), text_of(text_col).alias("text"))
    blocks = written(rows.mapInArrow(releasing(_blocks(block_bytes)), "block long, ids binary, sizes binary, z binary"), "byte-blocks", "uncompressed")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(NAME_BITS, 8 + max(24, int(total).bit_length()))
    wide = length - GRAM + 1
    buckets = max(8, -(-2 * total // (wide * bucket_entries)))
    names = blocks.mapInArrow(releasing(_seeded(length, buckets, bits)), _SEEDS).groupBy("bucket").applyInArrow(_judged, _LIVE)
    names = written(names, "judged-names")
    live = names.agg(F.coalesce(F.sum("n_live"), F.lit(0))).first()[0]
    shards = max(8, -(-live * (length + wide // 2) // shard_bytes))
    by_block = blocks.groupBy("block")
    sent = by_block.cogroup(names.groupBy("block")).applyInArrow(_sent(length, buckets, bits, shards), "shard int, block long, n long, passages binary")
    firsts = written(sent.groupBy("shard").applyInArrow(_sorted(length), "block long, shard int, bits binary"), "earliest")
    answers = names.select(F.lit(1).alias("kind"), "block", "bucket", "flags").union(firsts.select(F.lit(2), "block", "shard", "bits"))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_removed(length, buckets, bits, shards), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
