"""Stored inverted-cell index over vectors (T2): build, search, recall.

Build: cell centres are fitted by Spark ML's KMeans on a bounded sample (the
``sample_rows`` rows of least hash of their id, whatever the table's size);
every vector is assigned to its nearest centre and written below
``path/vectors/cell=<c>``, so a search reads only the cells it probes. A hot
cell (copies of one vector) is written by as many tasks as its bytes ask for.
How many cells a query has to probe for the recall asked for is measured at
build time: bounded sample queries are answered exactly over all vectors, and
the rank of the cell that each true neighbour lies in is counted.

Search: queries meet the cells they probe in an equi-join of blocks; numpy
scores one pair of blocks at a time exactly (a re-rank with the vectors
themselves, no codes). Queries that find fewer than k points probe on, twice as
many cells each time, until they have k or no cell is left. With ``probes`` set
to the number of cells the result is exact: every query meets every stored vector,
so blocks of both meet in the grid of the batch search, and no query is dealt to
each of the cells.

Reaching the driver: centres (``cells`` rows), histograms by cell, and the set of
probed cells, all bounded by ``MOST_CELLS``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.vectors import l2_normalize, norm
from lakeloom.operators.search import BLOCK_BYTES, best_of_blocks, packed_rows, ranked_hits, releasing, topk_batch, unit_matrix

#: Bounds of what the driver and each task hold: cells, and rows that centres are fitted on.
MOST_CELLS = 65_536
SAMPLE_ROWS = 100_000
#: Queries that the number of probes is measured with.
PROBE_QUERIES = 256


@dataclass(frozen=True)
class Index:
    path: str
    id_col: str
    dimension: int
    probes: int  # cells that reach the recall asked for
    recall: float  # as measured with these probes on the sample queries
    schema: str  # of the indexed rows, as JSON
    centres: np.ndarray  # unit vectors, one row a cell

    @property
    def cells(self) -> int:
        return len(self.centres)


# ---------------------------------------------------------------- cells
def sample_by_hash(df: DataFrame, id_col: str, rows: int, seed: int = 0) -> DataFrame:
    """The ``rows`` rows of least hash of their id: the same ones on any partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), id_col), id_col).limit(rows)


def fit_cells(vectors: DataFrame, id_col: str, vec_col: str, cells: int, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> np.ndarray:
    """Unit centres of at most ``cells`` cells, from a sample of at most ``sample_rows`` vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = vectors.where((norm(vec_col) > 0) & F.col(id_col).isNotNull())
    sample = sample_by_hash(usable, id_col, sample_rows, seed).select(array_to_vector(l2_normalize(vec_col, "double")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=15, distanceMeasure="cosine").fit(sample) if cells > 1 else None
    centres = np.array(model.clusterCenters()) if model else np.array([[1.0]])
    length = np.linalg.norm(centres, axis=1, keepdims=True)
    return centres / np.where(length == 0, 1.0, length)


def _nearest(unit: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest cells of each row, nearest first, ties by number."""
    out = np.empty((len(unit), n), np.int32)
    for i in range(0, len(unit), 1024):
        score = np.round(unit[i : i + 1024] @ centres.T, 9) if centres.shape[1] == unit.shape[1] else np.zeros((len(unit[i : i + 1024]), len(centres)))
        out[i : i + 1024] = np.argsort(-score, axis=1, kind="stable")[:, :n]
    return out


def _assigned(centres):
    """mapInArrow body: adds the cell of each row's vector (the first cell where it is NULL)."""

    def run(batches):
        for b in batches:
            unit, _ = unit_matrix(b.column("vec"))
            cell = _nearest(unit, centres.value, 1)[:, 0] if unit.shape[1] else np.zeros(len(unit), np.int32)
            at = b.schema.get_field_index("vec")
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(cell)], names=[*(n for n in b.schema.names if n != "vec"), "cell"])

    return releasing(run)


def assign(spark: SparkSession, vectors: DataFrame, vec_col: str, centres: np.ndarray) -> DataFrame:
    """The rows with the number of their nearest cell as ``cell``."""
    shared = spark.sparkContext.broadcast(centres)  # MOST_CELLS rows at most
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.withColumn("vec", F.col(vec_col)).mapInArrow(_assigned(shared), f"{schema}, cell int")


# ---------------------------------------------------------------- build
def build(spark: SparkSession, vectors: DataFrame, path: str, id_col: str, vec_col: str = "embedding", payload: Sequence[str] = (), cells: int | None = None, recall: float = 0.95, k: int = 10, sample_rows: int = SAMPLE_ROWS) -> Index:
    """Write the index of all ``vectors`` below ``path`` and return it.

    ``cells`` defaults to the square root of the number of vectors. NULL
    vectors are not indexed; zero vectors are, and score 0."""
    if not 0 < recall <= 1 or k <= 0 or sample_rows <= 0:
        raise ValueError("recall must be within 0 and 1, k and sample_rows positive")
    rows = vectors.select(F.col(id_col), F.col(vec_col).alias("embedding"), *payload).where(F.col(vec_col).isNotNull())
    n, shortest, longest = rows.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if n and shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} dimensions")
    cells = max(1, min(cells or int(n**0.5), MOST_CELLS, n or 1))
    centres = fit_cells(rows, id_col, "embedding", cells, sample_rows) if n else np.zeros((1, 1))
    assigned = assign(spark, rows, "embedding", centres)
    assigned.hint("rebalance", "cell").write.mode("error").partitionBy("cell").parquet(f"{path}/vectors")

    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())]).json()
    index = Index(path, id_col, longest or 0, len(centres), 1.0, schema, centres)
    probes, reached = _probes_for(spark, index, recall, k) if n else (1, 1.0)
    lines = [(i, [float(x) for x in row]) for i, row in enumerate(centres)]
    spark.createDataFrame(lines, "cell int, centre array<double>").coalesce(1).write.mode("error").parquet(f"{path}/centres")
    config = json.dumps({"id_col": id_col, "dimension": longest or 0, "probes": probes, "recall": reached, "schema": schema})
    # written last: an index without it has not been finished
    spark.createDataFrame([(config,)], "config string").coalesce(1).write.mode("error").parquet(f"{path}/config")
    return Index(path, id_col, longest or 0, probes, reached, schema, centres)


def open_index(spark: SparkSession, path: str) -> Index:
    config = json.loads(spark.read.parquet(f"{path}/config").first().config)
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    return Index(path, centres=np.array([r.centre for r in rows]), **config)


def points(spark: SparkSession, index: Index) -> DataFrame:
    """All indexed rows: the id, embedding, payload and cell."""
    return spark.read.schema(T.StructType.fromJson(json.loads(index.schema))).parquet(f"{index.path}/vectors")


def _probes_for(spark: SparkSession, index: Index, recall: float, k: int) -> tuple[int, float]:
    """(fewest probes with which sample queries find ``recall`` of their true neighbours, the share found)."""
    all_points = points(spark, index)
    sample = sample_by_hash(all_points, index.id_col, PROBE_QUERIES, seed=1)
    queries = sample.select(F.monotonically_increasing_id().alias("query_id"), F.col("embedding").alias("query_vec")).collect()
    asked = spark.createDataFrame([(i, [float(x) for x in r.query_vec]) for i, r in enumerate(queries)], "query_id long, query_vec array<double>")
    numbered = all_points.select(F.xxhash64(index.id_col).alias("point"), "embedding", "cell")
    true = topk_batch(numbered, asked, k=k, id_col="point").join(numbered.select("point", "cell"), "point").groupBy("query_id", "cell").count().collect()
    unit, _ = unit_matrix(pa.array([list(map(float, r.query_vec)) for r in queries], pa.list_(pa.float64())))
    order = _nearest(unit, index.centres, index.cells)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(index.cells, dtype=np.int32)[None, :], axis=1)
    found = np.zeros(index.cells, np.int64)
    for r in true:
        found[rank[r.query_id, r.cell]] += r["count"]
    share = np.cumsum(found) / max(1, found.sum())
    probes = int(np.searchsorted(share, min(recall, share[-1]) - 1e-12)) + 1
    return probes, float(share[probes - 1])


# --------------------------------------------------------------- search
def _probing(centres, first: int, last: int):
    """mapInArrow body: (cell, id, vec) for the cells ``first`` to ``last`` of each query's order."""

    def run(batches):
        for b in batches:
            unit, _ = unit_matrix(b.column("vec"))
            cells = _nearest(unit, centres.value, last)[:, first:]
            row = np.repeat(np.arange(len(unit)), cells.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), b.column("id").take(pa.array(row)), b.column("vec").take(pa.array(row))], names=["cell", "id", "vec"])

    return releasing(run)


def search(spark: SparkSession, index: Index, queries: DataFrame, k: int = 10, query_id: str = "query_id", query_vec: str = "query_vec", probes: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, id, score): the k best points among the cells each query probes, ties by id.

    Query and point ids must be integral. A query gets min(k, points) hits
    whatever ``probes`` is. NULL queries have no hits."""
    if k <= 0 or (probes is not None and probes <= 0):
        raise ValueError("k and probes must be positive")
    now = min(index.cells, probes or index.probes)
    stored = points(spark, index)
    if now == index.cells:
        asked = queries.select(F.col(query_id).cast("long").alias(query_id), F.col(query_vec).cast("array<double>").alias(query_vec))
        return topk_batch(stored, asked, k, index.id_col, query_id=query_id, query_vec=query_vec, block_bytes=block_bytes)
    shared = spark.sparkContext.broadcast(index.centres)
    open_queries = queries.where(F.col(query_vec).isNotNull()).select(F.col(query_id).cast("long").alias("id"), F.col(query_vec).cast("array<double>").alias("vec"))
    found, before = None, 0
    while True:
        asked = open_queries.mapInArrow(_probing(shared, before, now), "cell int, id long, vec array<double>")
        wanted = [r.cell for r in asked.select("cell").distinct().collect()]  # the index' cells at most
        if not wanted:
            break
        chosen = stored.where(F.col("cell").isin(wanted)) if len(wanted) < index.cells else stored
        left = chosen.select("cell", F.col(index.id_col).cast("long").alias("id"), F.col("embedding").alias("vec"))
        pairs = _in_cells(left, block_bytes).join(_in_cells(asked, block_bytes, "q_"), "cell")
        hits = pairs.select("ids", "vectors", "missing", "q_ids", "q_vectors").mapInArrow(best_of_blocks(k), "query_id long, id long, score double")
        found = hits if found is None else found.union(hits)
        if now == index.cells:
            break
        few = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        short = open_queries.join(few, open_queries["id"] == few["query_id"], "left_anti")
        if short.isEmpty():
            break
        open_queries, before, now = short, now, min(index.cells, 2 * now)
    if found is None:
        found = spark.createDataFrame([], "query_id long, id long, score double")
    return ranked_hits(found, k, query_id, index.id_col)


def _in_cells(rows: DataFrame, block_bytes: int, prefix: str = "") -> DataFrame:
    """Rows (cell, id, vec) packed into blocks of one cell each, a cell's blocks in as many tasks as there are."""
    packed = rows.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("cell").mapInArrow(packed_rows(block_bytes, "cell"), "cell int, ids binary, vectors binary, missing binary")
    return packed.select("cell", *[F.col(c).alias(prefix + c) for c in ("ids", "vectors", "missing")])


def recall_of(approximate: DataFrame, exact: DataFrame, query_id: str = "query_id", id_col: str = "point_id") -> DataFrame:
    """(query_id, true_hits, found): of each query's exact hits how many the approximate ones hold."""
    seen = approximate.select(F.col(query_id).alias("_q"), F.col(id_col).alias("_p"), F.lit(True).alias("_seen"))
    both = exact.join(seen, (F.col(query_id) == F.col("_q")) & (F.col(id_col) == F.col("_p")), "left")
    return both.groupBy(query_id).agg(F.count(F.lit(1)).alias("true_hits"), F.count_if(F.col("_seen")).alias("found"))

