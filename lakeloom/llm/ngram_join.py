"""N-gram Jaccard join (operator 1).

A document is its set of word shingles (64-bit hashes). Equal sets form a
class, one representative of which goes on. Sets are ordered by how common a
shingle is, rare ones first; sets that reach the threshold must share one of
their first (1 - threshold) * size + 1 shingles. A tile is the sets sharing
such a shingle, sorted by size, so that only a band of sizes can match. In a
tile, sets are compared as 512-bit bitmaps: the bits one has and the other
lacks bound their overlap from above, as does the place of the shared
shingle. Pairs that pass are compared exactly as sorted arrays.

No tile gives all its pairs. First each set is compared with sets that its
tiles begin with (a star's centres, the few it shares most tiles with) and
links found are joined into components. Then each is compared with sets of
other components whose bitmaps are nearest to its own, and components are
joined again. In the last round only pairs of different components are looked
at, all of them, each in the first tile the two share or soon after. So a
group of near copies costs a few comparisons a member, and no component is
missed.

How common a shingle is, is counted: blocks of representatives send their
distinct shingles, sorted and packed, to buckets of the hash space and get back
for each one in how many sets it is, as a power of two. So a shingle that only
one set has comes first in its order and into no tile, however large the corpus
is. (A clash of the shortened hashes that are sent only makes a shingle look
more common; any order gives right results.)

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; texts of fewer words than a shingle are one shingle; rows
repeating an id and text are one document given twice; a null id stays null
and counts as the smallest; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import NO_ID, id_of, releasing, text_of, written
from lakeloom.llm.components import joined_components
from lakeloom.llm.words import by_document, combined, mix, pack, pack_sorted, slices, text_buffer, unpack, unpack_sorted, windows, word_hashes

_SIG_WORDS = 8
_SETS = "doc long, text_key long, n long, k1 long, k2 long, sig binary"
#: Bytes of text in a block of representatives, shingles in a bucket.
BLOCK_BYTES = 2_000_000
BUCKET_ENTRIES = 1_000_000


def sets_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, document number of each, shingles per document); sorted within documents, distinct."""
    words, counts = word_hashes(*text_buffer(column))
    grams, doc, _ = windows(words, counts, size)
    start = np.cumsum(counts) - counts
    parts, owners = [grams], [doc]
    for k in range(1, size):
        at = np.flatnonzero(counts == k)
        if len(at):
            parts.append(combined([words[start[at] + i] for i in range(k)]))
            owners.append(at)
    grams, doc = np.concatenate(parts), np.concatenate(owners)
    order = by_document(doc, grams)
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, doc, np.bincount(doc, minlength=len(counts)).astype(np.int64)


def _signatures(grams: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    bits = np.zeros((n_docs, _SIG_WORDS * 64), bool)
    bits[doc, (mix(grams) % np.uint64(_SIG_WORDS * 64)).astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def _measured(size: int):
    def run(batches):
        for b in (part for whole in batches for part in slices(whole, "text")):
            grams, doc, n = sets_of(b.column("text"), size)
            some = np.flatnonzero(n)
            first = (np.cumsum(n) - n)[some]
            keys = [np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)]
            for k, salt in zip(keys, (11, 13), strict=True):
                if len(some):
                    k[some] = np.add.reduceat(mix(grams ^ np.uint64(salt << 40)), first)
            sig = _signatures(grams, doc, len(n))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("text_key"), pa.array(n), *(pa.array(k.view(np.int64)) for k in keys), pa.array([x.tobytes() for x in sig], pa.binary())],
                names=_names(_SETS),
            )

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _blocked(block_bytes: int):
    """mapInArrow body: representatives (cid, z) to blocks."""

    def run(batches):
        from pyspark import TaskContext

        no, cids, z, total = TaskContext.get().partitionId() << 32, [], [], 0

        def block():
            return pa.RecordBatch.from_arrays([pa.array([no], pa.int64()), pa.array([cids], pa.list_(pa.int64())), pa.array([z], pa.list_(pa.binary()))], names=["block", "cids", "z"])

        for b in batches:
            for cid, x, n in zip(b.column("cid").to_pylist(), b.column("z").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                cids.append(cid)
                z.append(x)
                total += n
                if total >= block_bytes:
                    yield block()
                    no, cids, z, total = no + 1, [], [], 0
        if cids:
            yield block()

    return run


def _block_sets(row: dict, size: int):
    return sets_of(pa.array([zstandard.decompress(z).decode() for z in row["z"]], pa.large_string()), size)


def _cut(keys: np.ndarray, buckets: int, bits: int) -> list[tuple[int, int, int]]:
    edges = np.array([(i << bits) // buckets for i in range(1, buckets)], np.uint64)
    at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(i, a, z) for i, (a, z) in enumerate(zip(at, at[1:], strict=False)) if z > a]


def _counted(size: int, buckets: int, bits: int):
    """mapInArrow body: a block's distinct shingles and in how many of its sets they are, by bucket."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys, n = np.unique(_block_sets(row, size)[0] >> np.uint64(64 - bits), return_counts=True)
                parts = _cut(keys, buckets, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _, _ in parts], pa.int32()), pa.array([row["block"]] * len(parts), pa.int64()), pa.array([pack_sorted(keys[a:z]) for _, a, z in parts], pa.binary()), pa.array([pack(np.minimum(n[a:z], 65535).astype(np.uint16)) for _, a, z in parts], pa.binary())],
                    names=["bucket", "block", "keys", "sets"],
                )

    return run


def _totalled(t: pa.Table) -> pa.Table:
    """Of each shingle in a bucket how many sets have it: 0 for one, else the power of two."""
    keys = [unpack_sorted(x.as_py()) for x in t.column("keys")]
    n = np.concatenate([unpack(x.as_py(), np.uint16) for x in t.column("sets")])
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(of, weights=n)
    common = np.frexp(total - 0.5)[1].astype(np.uint8)[of]  # 1: 0, 2: 1, up to 4: 2, up to 8: 3
    parts = np.split(common, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "common": pa.array([pack(x) for x in parts], pa.binary())})


def _prefixes(size: int, percent: int, buckets: int, bits: int):
    """Of each set's first shingles, rare ones first, those that another set may have, with the set's bitmap."""
    schema = pa.schema([("token", pa.int64()), ("np", pa.int64()), ("cid", pa.int64()), ("sig", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = {r["bucket"]: r["common"] for r in right.to_pylist()}
        out = [pa.Table.from_pylist([], schema)]
        for row in left.to_pylist():
            grams, doc, n = _block_sets(row, size)
            sig = _signatures(grams, doc, len(n))
            keys, of = np.unique(grams >> np.uint64(64 - bits), return_inverse=True)
            common = np.concatenate([np.zeros(0, np.uint8), *(unpack(answers[i], np.uint8) for i, _, _ in _cut(keys, buckets, bits))])[of]
            order = np.lexsort((grams, common, doc))
            grams, common, doc = grams[order], common[order], doc[order]
            rank = np.arange(len(grams)) - (np.cumsum(n) - n)[doc]
            first = (rank <= n[doc] + (-percent * n[doc]) // 100) & (common > 0)  # n - ceil(percent * n) + 1 of them
            cid = np.array(row["cids"], np.int64)[doc[first]]
            sigs = pa.Array.from_buffers(pa.binary(), len(cid), [None, pa.py_buffer(np.arange(len(cid) + 1, dtype=np.int32) * (8 * _SIG_WORDS)), pa.py_buffer(sig[doc[first]].tobytes())])
            out.append(pa.table([grams[first].view(np.int64), (n[doc[first]] << 32) | rank[first], cid, sigs], schema=schema))
        return pa.concat_tables(out)

    return run


def _shared(batches):
    """Rows whose shingle another set has as well, from rows sorted by shingle."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = b.column("token").to_numpy()
        like = np.zeros(len(t), bool)
        like[1:] = t[1:] == t[:-1]
        keep = like.copy()
        keep[:-1] |= like[1:]
        if held is not None:
            last, was_kept = held
            joins = last.column("token")[0].as_py() == int(t[0])
            keep[0] |= joins
            if joins or was_kept:
                yield last
        held = b.slice(len(t) - 1, 1), bool(keep[-1])
        yield b.slice(0, len(t) - 1).filter(pa.array(keep[:-1]))
    if held is not None and held[1]:
        yield held[0]


def _margin(percent, n, pos, sig, i, js):
    """By how much the overlap of the pairs of rows (i, j) can exceed what a link takes; negative: no link.

    ``i`` is a number or as many as ``js``."""
    need = -(-percent * (n[i] + n[js]) // (100 + percent))
    spare = np.minimum(n[i] - pos[i], n[js] - pos[js]) - need
    at = np.flatnonzero(spare >= 0)
    if len(at):
        x, y = sig[i] if np.ndim(i) == 0 else sig[i[at]], sig[js[at]]
        ni, nj = n[i] if np.ndim(i) == 0 else n[i[at]], n[js[at]]
        most = np.minimum(ni - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), nj - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
        spare[at] = np.minimum(spare[at], most - need[at])
    return spare


_SMALL = 12
#: Rounds before the last one, and the sets that a set is compared with in each: any give the same components.
ROUNDS = ("stars", "nearest")
CENTRES = 3
#: Earlier tiles of a set that its row in a tile tells of.
_BEFORE = 4


def _met_before(before, i, js):
    """Which of the pairs share one of the tiles just before this one: that tile has the pair."""
    x = before[i][None, :, None] if np.ndim(i) == 0 else before[i][:, :, None]
    return (x == before[js][:, None, :]).any((1, 2))


def _small_tiles(percent, mode, n, pos, label, sig, before, first, k):
    """Pairs of all tiles of ``k`` rows at once; ``first``: their first rows."""
    left, right = [], []
    for j in range(1, k):
        best, which = np.full(len(first), -1), np.zeros(len(first), np.int64)
        for i in range(j):
            open_ = label[first + i] != label[first + j]
            if mode == "stars":
                open_ &= best < 0
            open_ = np.flatnonzero(open_)
            if not len(open_):
                continue
            at = first[open_]
            spare = _margin(percent, n, pos, sig, at + i, at + j)
            if mode == "all":
                at = at[spare >= 0]
                at = at[~_met_before(before, at + i, at + j)]
                left.append(at + i), right.append(at + j)
            else:
                more = spare > best[open_]
                best[open_[more]], which[open_[more]] = spare[more], i
        got = np.flatnonzero(best >= 0)
        left.append(first[got] + which[got]), right.append(first[got] + j)
    return left, right


def _before_names(mode: str) -> list[str]:
    return [f"before{k}" for k in range(1, _BEFORE + 1)] if mode == "all" else []


def _tile_pairs(percent: int, mode: str):
    """Candidate pairs of each tile, from rows sorted by shingle and size; only
    rows of different labels make pairs.

    "stars": each row with the first earlier row that may link with it (in
    large tiles, of those that began a star). "nearest": each row with the
    earlier row that may overlap most beyond need. "all": all pairs, but for
    those that one of the tiles just before has as well. A tile is read in
    pieces; rows too small for what is left are let go.
    """

    def large(n, pos, label, sig, before, old):
        left, right = [], []
        begun = np.ones(len(n), bool)
        if label.min() == label.max():
            pass
        elif mode == "stars":
            begun[old:] = False
            free = np.arange(old, len(n))
            for i in [*range(old), None]:
                while len(free):
                    if i is None:  # a new star
                        begun[free[0]] = True
                    at, js = (free[0], free[1:]) if i is None else (i, free)
                    ok = _margin(percent, n, pos, sig, at, js) >= 0
                    left.append(np.full(ok.sum(), at)), right.append(js[ok])
                    free = js[~ok]
                    if i is not None:
                        break
        elif mode == "nearest":
            for j in range(max(old, 1), len(n)):
                some = np.flatnonzero(label[:j] != label[j])
                spare = _margin(percent, n, pos, sig, j, some)
                if len(some) and spare.max() >= 0:
                    left.append(some[[spare.argmax()]]), right.append(np.array([j]))
        else:
            for i in range(len(n) - 1):
                js = np.arange(max(old, i + 1), len(n))
                js = js[label[js] != label[i]]
                js = js[_margin(percent, n, pos, sig, i, js) >= 0]
                js = js[~_met_before(before, i, js)]
                left.append(np.full(len(js), i)), right.append(js)
        return left, right, begun & (100 * n >= percent * n[-1])

    def run(batches):
        token, carry = None, None  # carry: rows of the open tile that later rows can link with
        for b in batches:
            if not b.num_rows:
                continue
            t = b.column("token").to_numpy()
            rows = [b.column("np").to_numpy() >> 32, b.column("np").to_numpy() & 0xFFFFFFFF, b.column("cid").to_numpy(), b.column("label").to_numpy()]
            rows.append(np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint64).reshape(-1, _SIG_WORDS))
            rows.append(np.stack([b.column(c).to_numpy() for c in _before_names(mode)] or [t], axis=1))
            old = 0
            if carry is not None and token == t[0]:
                old = len(carry[0])
                rows = [np.concatenate(x) for x in zip(carry, rows, strict=True)]
                t = np.concatenate([np.full(old, token), t])
            n, pos, cid, label, sig, before = rows
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            size = np.diff(np.append(first, len(t)))
            left, right = [], []
            whole = np.ones(len(first), bool)
            whole[-1] = False  # the open tile
            if old:
                whole[0] = False
            for k in range(2, _SMALL + 1):
                some = first[whole & (size == k)]
                if len(some):
                    a, c = _small_tiles(percent, mode, n, pos, label, sig, before, some, k)
                    left += a
                    right += c
            for tile in np.flatnonzero(~whole | (size > _SMALL)).tolist():
                a, z = int(first[tile]), int(first[tile] + size[tile])
                i, j, still = large(n[a:z], pos[a:z], label[a:z], sig[a:z], before[a:z], old if tile == 0 else 0)
                left += [x + a for x in i]
                right += [x + a for x in j]
                if tile == len(first) - 1:
                    token, carry = t[-1], [x[a:z][still] for x in rows]
            if left:
                x, y = cid[np.concatenate(left)], cid[np.concatenate(right)]
                yield pa.RecordBatch.from_arrays([pa.array(x[x != y]), pa.array(y[x != y])], names=["a", "b"])

    return run


_TILED = "token long, np long, cid long, a long, b long"


def _tiled(percent: int):
    """Rows of tiles of two sets or more, and the first round's pairs of these tiles, in one pass over rows sorted by shingle and size."""
    stars = _tile_pairs(percent, ROUNDS[0])

    def run(batches):
        rows = []

        def shared():
            for b in _shared(batches):
                none = pa.nulls(b.num_rows, pa.int64())
                rows.append(pa.RecordBatch.from_arrays([*(b.column(c) for c in ("token", "np", "cid")), none, none], names=_names(_TILED)))
                yield pa.RecordBatch.from_arrays([*b.columns, b.column("cid")], names=[*b.schema.names, "label"])

        for pairs in stars(shared()):
            yield from rows
            rows.clear()
            none = pa.nulls(pairs.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, *pairs.columns], names=_names(_TILED))
        yield from rows

    return run


def _zipped(batches):
    """Texts compressed; of rows that repeat an id and text in a batch only one goes on."""
    for b in (part for whole in batches for part in slices(whole, "text")):
        _, first = np.unique(np.stack([b.column("doc").to_numpy(), b.column("text_key").to_numpy()]), axis=1, return_index=True)
        b = b.take(pa.array(np.sort(first)))
        texts = [(x or "").encode() for x in b.column("text").to_pylist()]
        z = [zstandard.compress(x, 3) for x in texts]
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("text_key"), pa.array(z, pa.binary()), pa.array([len(x) for x in texts], pa.int64())], names=["doc", "text_key", "z", "bytes"])


def _verified(size: int, percent: int):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                sides = []
                for side in ("za", "zb"):
                    distinct, of = np.unique(part.column(side).to_numpy(zero_copy_only=False), return_inverse=True)
                    grams, _, n = sets_of(pa.array([zstandard.decompress(z).decode() for z in distinct], pa.large_string()), size)
                    sides.append((np.split(grams, np.cumsum(n)[:-1]), of))
                ok = []
                for x, y in zip(sides[0][1], sides[1][1], strict=True):
                    p, q = sides[0][0][x], sides[1][0][y]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    ok.append(100 * both >= percent * (len(p) + len(q) - both))
                yield part.select(["a", "b"]).filter(pa.array(ok))

    return run


def link_components(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key, component_key), one row per input row.

    Documents link when 100 * intersection >= percent * union; component_id is
    the smallest id that links lead to, and component_key the least text_key
    that a row of that id has in the component, which tells apart components
    that share an id and names one document of each.
    """
    rows = docs.select(F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_of(text_col)).alias("text_key"), text_of(text_col).alias("text"))
    sets = written(rows.mapInArrow(releasing(_measured(size)), _SETS), "sets")
    members = sets.select("doc", "text_key", "n", "k1", "k2")
    key = ["n", "k1", "k2"]
    classes = members.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc", "text_key")).alias("m"))
    classes = written(classes.select(*key, "m.doc", "m.text_key").withColumn("cid", F.monotonically_increasing_id()), "classes")
    reps = classes.select("doc", "text_key", "cid")
    one = ["doc", "text_key"]
    # rows that repeat an id and text are one: a class has one signature and one text
    sigs = written(sets.select(*one, "sig").dropDuplicates(one).join(reps, one).select("cid", "sig"), "signatures")

    # compressed once for all rounds; few texts are read into a comparison
    zipped = rows.mapInArrow(releasing(_zipped), "doc long, text_key long, z binary, bytes long").dropDuplicates(one).join(reps, one).select("cid", "z", "bytes")
    blocks = written(zipped.mapInArrow(releasing(_blocked(BLOCK_BYTES)), "block long, cids array<long>, z array<binary>"), "texts", "uncompressed")
    zipped = blocks.select(F.inline(F.arrays_zip("cids", "z"))).withColumnRenamed("cids", "cid")

    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits, buckets = min(64, 8 + max(24, int(total).bit_length())), max(8, -(-total // BUCKET_ENTRIES))
    counts = blocks.mapInArrow(releasing(_counted(size, buckets, bits)), "bucket int, block long, keys binary, sets binary").groupBy("bucket").applyInArrow(_totalled, "block long, bucket int, common binary")
    tokens = blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_prefixes(size, percent, buckets, bits), "token long, np long, cid long, sig binary")
    tiled = written(tokens.repartition("token").sortWithinPartitions("token", "np", "cid").mapInArrow(releasing(_tiled(percent)), _TILED), "tiles")
    tiles = tiled.where("cid IS NOT NULL").select("token", "np", "cid")

    def found_in(rows_, mode):
        given = rows_.join(sigs, "cid").select("token", "np", "cid", "label", *_before_names(mode), "sig")
        return given.repartition("token").sortWithinPartitions("token", "np", "cid").mapInArrow(releasing(_tile_pairs(percent, mode)), "a long, b long")

    def few_pairs(found, tried):
        """Of the sets a set was found with the few it shares most tiles with; the last round has all the rest."""
        votes = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"))
        if tried is not None:
            votes = votes.join(tried, ["a", "b"], "left_anti")
        best = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("k"), "a"))
        return written(votes.withColumn("nth", best).where(F.col("nth") <= CENTRES).select("a", "b"), "candidates")

    def all_pairs(rows_):
        order = Window.partitionBy("cid").orderBy(F.col("np").bitwiseAND(0xFFFFFFFF))
        # where there is no earlier tile, a value no other set has
        before = [F.coalesce(F.lag("token", k).over(order), F.bitwise_not("cid")).alias(c) for k, c in enumerate(_before_names("all"), 1)]
        found = found_in(rows_.select("*", *before), "all")
        return written(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")

    def links(pairs):
        used = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
        texts = written(zipped.join(used, "cid"), "texts", "uncompressed")
        sides = pairs.join(texts.select(F.col("cid").alias("a"), F.col("z").alias("za")), "a").join(texts.select(F.col("cid").alias("b"), F.col("z").alias("zb")), "b")
        return written(sides.select("a", "b", "za", "zb").mapInArrow(releasing(_verified(size, percent)), "a long, b long"), "verified")

    def mixed(rows_, labels):
        """Rows of the tiles that still hold more than one component."""
        labelled = rows_.drop("label").join(labels, rows_["cid"] == labels["node"], "left").select("token", "np", "cid", F.coalesce("root", "cid").alias("label"))
        labelled = written(labelled, "labelled")
        several = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
        return labelled.join(several, "token")

    rows_, tried, labels = tiles.withColumn("label", F.col("cid")), None, None
    for mode in ROUNDS:
        first = mode == ROUNDS[0]
        pairs = few_pairs(tiled.where("a IS NOT NULL").select("a", "b") if first else found_in(rows_, mode), tried)
        tried = pairs if tried is None else tried.union(pairs)
        labels = written(joined_components(labels, links(pairs)), "labels")
        rows_ = written(mixed(rows_, labels), "mixed")
    rest = all_pairs(rows_)
    if not rest.isEmpty():
        labels = written(joined_components(labels, links(rest)), "labels")

    named = classes.join(labels, classes["cid"] == labels["node"], "left").select(*key, F.struct(classes["doc"], classes["text_key"]).alias("least"), F.coalesce("root", "cid").alias("root"))
    named = written(named, "named")
    smallest = written(named.groupBy("root").agg(F.min("least").alias("smallest")), "smallest")
    of_class = written(named.join(smallest, "root").select(*key, F.col("smallest.doc").alias("component"), F.col("smallest.text_key").alias("component_key")), "components")
    joined = members.join(of_class, key, "left")
    known = lambda c: F.when(c != NO_ID, c)
    return joined.select(known(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), known(F.coalesce("component", "doc")).alias("component_id"), "text_key", F.coalesce("component_key", "text_key").alias("component_key"))
