"""Vector table, upsert and cosine top-k search (one query, batches, a text), and
search enrichment with the gold tables.

Scoring never materializes query x point pairs as rows:
* one query: the query vector is a literal inside the score expression and
  ``orderBy().limit(k)`` becomes a per-partition top-k (TakeOrderedAndProject);
* a batch of queries: queries and points are packed into blocks of a fixed
  size, blocks meet in a grid whose sides follow from both row counts, and each
  pair of blocks gives the k best points of every query (numpy on Arrow
  batches), which are then ranked.

``vector_index`` holds the stored index, ``collection`` the stored vectors.
"""

from __future__ import annotations

import ctypes
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.vectors import dot_literal, l2_normalize, norm

#: Bytes of vectors in a block of points or queries.
BLOCK_BYTES = 2 << 20
#: Scores that one cell of the batch grid computes.
CELL_SCORES = 1 << 28


def _check_k(k: int) -> None:
    """limits must be positive."""
    if not isinstance(k, int) or k <= 0:
        raise ValueError(f"k must be a positive integer, got {k!r}")


# ------------------------------------------------------------- vector table
def vector_table(
    df: DataFrame,
    id_col: str,
    vec_col: str = "embedding",
    payload: Sequence[str] = (),
    dim: int | None = None,
) -> DataFrame:
    """(point_id, embedding, payload...). Integral ids are kept as
    point ids; other ids are hashed (xxhash64), so ids never depend on row
    order (K21). With ``dim`` every vector must have that length; a wrong one
    fails the job."""
    idt = df.schema[id_col].dataType
    pid = F.col(id_col).cast("long") if isinstance(idt, (T.LongType, T.IntegerType, T.ShortType)) else F.xxhash64(id_col)
    vec = F.col(vec_col)
    if dim is not None:
        vec = F.when(F.size(vec) == dim, vec).otherwise(
            F.raise_error(F.concat(F.lit(f"vector dimension is not {dim}: "), F.col(id_col).cast("string"))))
    return df.select(pid.alias("point_id"), vec.alias("embedding"), *payload)


def upsert(base: DataFrame, updates: DataFrame, key: str = "point_id", version: str = "version") -> DataFrame:
    """S14 SO1: union both tables and keep, per key, the row with the highest
    version (ties resolved by the remaining columns, so the result is
    deterministic). One aggregation: partial max on the map side."""
    cols = [c for c in base.columns if c not in (key, version)]
    both = base.unionByName(updates)
    best = F.max(F.struct(F.col(version), *[F.col(c) for c in cols])).alias("_best")
    return both.groupBy(key).agg(best).select(key, F.col(f"_best.{version}").alias(version),
                                               *[F.col(f"_best.{c}").alias(c) for c in cols])


# --------------------------------------------------------------- centroids
def centroids(df: DataFrame, vec_col: str = "embedding", by: Sequence[str] = ()) -> DataFrame:
    """Unit-length mean vector of each group (or of all rows), computed by
    the ML ``Summarizer`` aggregate: one partial mean per group and task, no
    explode of the vector elements."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vecs = df.select(*by, array_to_vector(F.col(vec_col)).alias("_v"))
    mean = Summarizer.mean(F.col("_v")).alias("_m")
    grouped = vecs.groupBy(*by).agg(mean) if by else vecs.agg(mean)
    return grouped.select(*by, l2_normalize(vector_to_array(F.col("_m")), "double").alias("centroid"))


def query_vector(df: DataFrame, vec_col: str = "embedding") -> list[float]:
    """The centroid of all vectors as a Python list (its size is the vector
    dimension, independent of the row count)."""
    row = centroids(df, vec_col).first()
    return [float(x) for x in row["centroid"]]


# ------------------------------------------------------------------ top-k
def cosine_literal(vec_col: str, q: Sequence[float]) -> F.Column:
    qn = float(np.linalg.norm(np.asarray(q, dtype=np.float64)))
    size = norm(vec_col) * F.lit(qn)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot_literal(vec_col, q) / size)


def topk_exact(
    points: DataFrame,
    query: Sequence[float],
    k: int = 10,
    id_col: str = "point_id",
    vec_col: str = "embedding",
    payload: Sequence[str] = (),
) -> DataFrame:
    """Exact cosine top-k for one query, ranked from 1 (scores are
    compared at 9 places, ties by id). The vector is not returned."""
    _check_k(k)
    scored = points.select(F.col(id_col), *payload, F.round(cosine_literal(vec_col, query), 9).alias("score"))
    top = scored.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k)
    # k rows only: a global window over them is bounded
    w = Window.orderBy(F.col("score").desc(), F.col(id_col).asc())
    return top.select(F.row_number().over(w).alias("rank"), id_col, *payload, "score")


_BLOCK = "block long, ids binary, vectors binary, missing binary"


def unit_matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, which are NULL) of an array column; zero vectors stay zero."""
    missing = column.is_null().to_numpy(zero_copy_only=False)
    size = set(np.diff(column.drop_null().offsets.to_numpy()).tolist()) if not missing.all() else set()
    if len(size) > 1:
        raise ValueError(f"vectors of different dimensions: {sorted(size)}")
    dim = size.pop() if size else 0
    m = np.zeros((len(column), dim))
    m[~missing] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(length == 0, 1.0, length), missing


def releasing(run):
    """The batch function ``run``; when its task ends, memory it has freed goes back to
    the system. A task of a chain of Python operators has a worker for each, idle workers
    live on, and allocators keep what they once had: the peaks of all of them would add up."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim is not None:
                trim(0)

    return wrapped


def packed_rows(block_bytes: int, key: str | None = None):
    """mapInArrow body: rows (id, vec) to blocks of at most ``block_bytes`` of vectors, or one
    vector; with ``key``, a column of integers, each block holds rows of one key and names it."""

    def run(batches):
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            m, missing = unit_matrix(b.column("vec"))
            step = max(1, block_bytes // max(8, 8 * m.shape[1]))
            keys = b.column(key).to_numpy() if key else np.zeros(len(ids), np.int64)
            for k in np.unique(keys):
                mine = np.flatnonzero(keys == k)
                for i in range(0, len(mine), step):
                    at = mine[i : i + step]
                    order = at[np.argsort(ids[at], kind="stable")]
                    row = [pa.array([k]), *(pa.array([x[order].tobytes()]) for x in (ids, m, missing))]
                    yield pa.RecordBatch.from_arrays(row, names=[key or "block", "ids", "vectors", "missing"])

    return releasing(run)


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest of each row; among equals the first columns."""
    n = score.shape[1]
    if n > k:
        cut = np.partition(score, n - k, axis=1)[:, n - k, None]
        more, tie = score > cut, score == cut
        free = k - more.sum(1, keepdims=True)
        return np.nonzero(more | (tie & (np.cumsum(tie, axis=1) <= free)))
    return np.nonzero(np.ones_like(score, bool))


def best_of_blocks(k: int):
    """mapInArrow body: for each pair of blocks the k best points of every query.
    Scores are compared at 9 places, so copies of a vector tie wherever they lie.
    A NULL point scores below all others (-inf here, NULL in the result)."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                part = {c: b.column(c)[r].as_buffer() for c in b.schema.names}
                qid, pid = np.frombuffer(part["q_ids"], np.int64), np.frombuffer(part["ids"], np.int64)
                q = np.frombuffer(part["q_vectors"], np.float64).reshape(len(qid), -1)
                p = np.frombuffer(part["vectors"], np.float64).reshape(len(pid), -1)
                gone = np.frombuffer(part["missing"], bool)
                for i in range(0, len(qid), 128):
                    score = np.round(q[i : i + 128] @ p.T, 9) if p.shape[1] else np.zeros((len(qid[i : i + 128]), len(pid)))
                    score[:, gone] = -np.inf
                    x, y = _best(score, k)
                    yield pa.RecordBatch.from_arrays([pa.array(qid[i + x]), pa.array(pid[y]), pa.array(score[x, y])], names=["query_id", "id", "score"])

    return releasing(run)


def grid(n_points: int, n_queries: int, cell_scores: int = CELL_SCORES, least: int = 1) -> tuple[int, int]:
    """(slots of points, slots of queries): so many that a cell computes about
    ``cell_scores`` scores, and so parted that both sides are copied least: points
    go to every slot of queries and queries to every slot of points, so replication
    grows with the square root of the work."""
    cells = max(least, -(-n_points * n_queries // cell_scores), 1)
    queries = min(max(1, round((cells * n_queries / max(1, n_points)) ** 0.5)), max(1, n_queries), cells)
    return -(-cells // queries), queries


def _copies(slots: int):
    return F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))


def ranked_hits(hits: DataFrame, k: int, query_id: str, id_col: str) -> DataFrame:
    """The k best of each query's (query_id, id, score), ranked from 1, ties by id."""
    # the rank filter also limits each task's rows of a query before the shuffle
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = hits.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)
    score = F.when(F.col("score") != float("-inf"), F.col("score")).alias("score")
    return ranked.select(F.col("query_id").alias(query_id), "rank", F.col("id").alias(id_col), score)


def topk_batch(
    points: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "point_id",
    vec_col: str = "embedding",
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    block_bytes: int = BLOCK_BYTES,
    slots: tuple[int, int] | None = None,
) -> DataFrame:
    """Exact cosine top-k for any number of queries (ids must be integral;
    ties by id).

    Both sides are packed into blocks that meet in a grid of ``slots`` (of
    points, of queries), by default chosen from both row counts; a task holds
    one pair of blocks at a time and nothing is collected. As in ``topk_exact``
    a zero vector scores 0 and a NULL point comes last with a NULL score. NULL
    queries have no hits; no queries or no points give no rows; all non-NULL
    vectors of a block and of both sides must have one dimension."""
    _check_k(k)
    queries = queries.where(F.col(query_vec).isNotNull())
    if slots is None:
        parallel = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slots = grid(points.count(), queries.count(), least=parallel)
    of_points, of_queries = slots
    if of_points <= 0 or of_queries <= 0 or block_bytes <= 0:
        raise ValueError("slots and block_bytes must be positive")

    def blocks(df, key, vec):
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vec).alias("vec"))
        return rows.mapInArrow(packed_rows(block_bytes), _BLOCK)

    def slot(n):
        return F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")

    pts = blocks(points, id_col, vec_col).select(slot(of_points).alias("p"), _copies(of_queries).alias("q"), "ids", "vectors", "missing")
    qs = blocks(queries, query_id, query_vec).select(
        _copies(of_points).alias("p"), slot(of_queries).alias("q"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    pairs = pts.join(qs, ["p", "q"]).select("ids", "vectors", "missing", "q_ids", "q_vectors")
    return ranked_hits(pairs.mapInArrow(best_of_blocks(k), "query_id long, id long, score double"), k, query_id, id_col)


def topk_text(points: DataFrame, text: str, k: int = 10, id_col: str = "point_id", vec_col: str = "embedding", payload: Sequence[str] = (), **encoder) -> DataFrame:
    """One query string to its k best points. ``encoder`` are the
    arguments of ``embed_text`` that the points were embedded with; a blank text
    is refused."""
    from lakeloom.operators.embed import embed_query

    return topk_exact(points, embed_query(points.sparkSession, text, **encoder), k, id_col, vec_col, payload)


# ------------------------------------------------------------- enrichment
def restrict_to_hits(df: DataFrame, hits: DataFrame, key: str, df_key: str | None = None) -> DataFrame:
    """Rows of a large table whose key is among the hit keys (semi join): use
    it before aggregating statistics for the hits only."""
    ids = hits.select(F.col(key).alias("_hit_key"))
    return df.join(ids, df[df_key or key] == ids["_hit_key"], "left_semi")


def enriched_search(hits: DataFrame, summary: DataFrame, stats: DataFrame,
                    key: str = "canonical_product_id") -> DataFrame:
    """Hits left-joined to the product summary and review statistics.

    The hits stay a DataFrame of any size. ``limit(k)`` tells Catalyst how
    few a top-k has, so it broadcasts them by itself; the hits of a large
    batch are shuffled. The gold tables are reduced to the hit keys first
    (Catalyst pushes the semi join below the statistics aggregation).
    Missing statistics become 0 counts and ratio 0; the average rating stays
    NULL."""
    s = restrict_to_hits(summary, hits, key)
    st = restrict_to_hits(stats, hits, key).drop(*[c for c in ("asin",) if c in stats.columns])
    out = hits.join(s, key, "left").join(st, key, "left")
    return out.select(
        *[c for c in out.columns if c not in ("review_count", "verified_review_count", "verified_review_ratio")],
        F.coalesce(F.col("review_count"), F.lit(0)).alias("review_count"),
        F.coalesce(F.col("verified_review_count"), F.lit(0)).alias("verified_review_count"),
        F.coalesce(F.col("verified_review_ratio"), F.lit(0.0)).alias("verified_review_ratio"),
    )
