"""Line dedup (operator 10).

Every line's key (stripped, A-Z lower-cased) is hashed to 128 bits. The rows
(hash, document, position) are range-partitioned on hash *and* document, so a
line that a third of all documents hold is split over many partitions, and
sorted by hash, document (largest first) and position. Each partition streams
its rows once: the first document of a run of equal hashes keeps its lines,
the lines of the others are marked as dropped once the run has enough
documents. A run that touches a partition's edge may go on in the next one;
its few undecided rows are settled by a small join on per-edge counts.

The result is not text but one compressed keep bitmap per document:
``zlib(packed bits)``, bit i for line i, lines beyond its end are kept.

Defined results: null text counts as empty (one empty line, never dropped,
as it has no key of the minimal length); a null id counts as the smallest id;
rows that repeat an id and text are one document and share its bitmap; rows
that share an id but not the text have bitmaps of their own and count as one
document. Other columns of the input are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeloom.llm.base import NO_ID, SPACE, id_of, lower_ascii, releasing, text_of, written

_MARKS = "kind int, h1 long, h2 long, doc long, text_key long, pos int, n int"
_DROP, _OPEN, _EDGE = 0, 1, 2


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(id_of(id_col), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        text_of(text_col).alias("text"),
    )


def line_rows(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, doc, text_key, pos) of every line whose key is long enough."""
    lines = _keyed(docs, id_col, text_col).select("doc", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = lower_ascii(F.btrim("line", F.lit(SPACE)))
    return (
        lines.select("doc", "text_key", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc", "text_key", "pos")
    )


def _marks(min_docs: int):
    """Streams one sorted partition; yields drops, undecided rows and edge counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the open run from its first min_docs - 1 documents
        full = False  # the open run has min_docs documents or more
        first = True  # the open run is the partition's first

        def rows(kind, m, n):
            size = len(m[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, kind, np.int32)), *[pa.array(x) for x in m], pa.array(np.asarray(n, np.int32))],
                names=["kind", "h1", "h2", "doc", "text_key", "pos", "n"],
            )

        for b in batches:
            if not b.num_rows:
                continue
            m = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                m = [np.concatenate(x) for x in zip(held, m, strict=True)]
            h1, h2, doc = m[:3]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            start = np.flatnonzero(new)
            run_no = np.cumsum(new) - 1
            count = np.cumsum(new_doc)
            rank = count - count[start][run_no] + 1
            docs_in = np.maximum.reduceat(rank, start)
            if full:
                docs_in[0] = max(docs_in[0], min_docs)
            last = run_no == run_no[-1]
            sure = rank >= min_docs
            closed = ~last & (rank > 1) & (rank < min_docs) & (docs_in[run_no] >= min_docs)
            if first:
                closed &= run_no != 0
            drop = sure | closed
            if drop.any():
                yield rows(_DROP, [x[drop] for x in m], np.zeros(drop.sum()))
            if first and len(start) > 1:  # the partition's first run has ended
                open_ = (run_no == 0) & ~sure
                yield rows(_OPEN, [x[open_] for x in m], np.zeros(open_.sum()))
                yield rows(_EDGE, [x[:1] for x in m], [min(docs_in[0], min_docs)])
            full = bool(docs_in[-1] >= min_docs)
            first = first and len(start) == 1
            held = [x[last & ~sure] for x in m]
        if held is not None:
            doc = held[2]
            ranks = np.cumsum(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
            open_ = ranks >= (1 if first else 2)
            yield rows(_OPEN, [x[open_] for x in held], np.zeros(open_.sum()))
            n = min_docs if full else int(ranks[-1])
            yield rows(_EDGE, [x[:1] for x in held], [n])

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_key, n_dropped, keep_bitmap) of every document that loses lines.

    ``doc`` is the id (the smallest long for null), ``text_key`` the text's
    hash, as repeated ids may have several texts.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 at least")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc()]
    ranged = line_rows(docs, min_chars, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    marks = written(ranged.mapInArrow(releasing(_marks(min_docs)), _MARKS), "line-marks")
    edges = marks.where(F.col("kind") == _EDGE).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc").alias("keeper"))
    settled = (
        marks.where(F.col("kind") == _OPEN)
        .join(edges, ["h1", "h2"])
        .where((F.col("docs") >= min_docs) & (F.col("doc") != F.col("keeper")))
    )
    cols = ["doc", "text_key", "pos"]
    drops = marks.where(F.col("kind") == _DROP).select(cols).union(settled.select(cols))
    lists = drops.groupBy("doc", "text_key").agg(F.collect_set("pos").alias("at"))
    return lists.mapInArrow(_packed, "doc long, text_key long, n_dropped long, keep_bitmap binary")


def _packed(batches):
    for b in batches:
        maps = []
        for at in b.column("at").to_pylist():
            bits = np.ones(max(at) // 8 * 8 + 8, np.uint8)  # whole bytes, so that padding keeps lines
            bits[at] = 0
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        n = [len(at) for at in b.column("at").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("text_key"), pa.array(n, pa.int64()), pa.array(maps, pa.binary())], names=["doc", "text_key", "n_dropped", "keep_bitmap"])


def kept_lines(lines: list[str], bitmap: bytes | None) -> list[str]:
    """The lines that a keep bitmap leaves."""
    if bitmap is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]


def _applied(batches):
    for b in batches:
        text, n = [], []
        for t, bitmap in zip(b.column("text").to_pylist(), b.column("keep_bitmap").to_pylist(), strict=True):
            lines = t.split("\n")
            n.append(len(lines))
            text.append(t if bitmap is None else "\n".join(kept_lines(lines, bitmap)))
        kept = b.column("doc").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int64()), b.column("text_key"), pa.array(n, pa.int64()), b.column("n_dropped"), pa.array(text, pa.large_string()).cast(pa.string())],
            names=["doc", "text_key", "n_lines", "n_dropped", "kept_text"],
        )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_key, n_lines, n_dropped, kept_text), one row per input row."""
    joined = _keyed(docs, id_col, text_col).join(bitmaps, ["doc", "text_key"], "left").select("doc", "text_key", "text", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep_bitmap")
    return joined.mapInArrow(_applied, "doc long, text_key long, n_lines long, n_dropped long, kept_text string")


@F.pandas_udf(StringType())
def cut_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    """The text without the lines that the bitmap drops; null where either is null."""
    both = zip(text, bitmap, strict=True)
    return pd.Series([None if t is None or m is None else "\n".join(kept_lines(t.split("\n"), m)) for t, m in both], dtype=object)


def null_id(col: str = "doc"):
    return F.when(F.col(col) != NO_ID, F.col(col))
