"""Vector collection (S14 S15): a table of vectors on shared storage with a
manifest, create-if-absent, upsert and delete.

Layout below the collection's path::

    manifest/version=<n>/   one row a bucket: the commit that holds it, and
                            dimension, model, bucket count and payload columns
    data/commit=<id>/bucket=<b>/   Parquet files of one bucket

Points are dealt to buckets by the hash of their id. A write reads the buckets
that its points fall into, merges them, writes them below a commit of its own
and then adds the next manifest version, which names that commit for these
buckets and the earlier ones for all others. Readers follow the newest manifest,
so they see a write wholly or not at all; files of a write that failed are
named by no manifest. Two writers that start from one version both try to add
the same next one: the second fails and can be repeated.

What reaches the driver is one row a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.search import vector_table

_MANIFEST = "bucket int, commit string, rows long, config string"


class Conflict(RuntimeError):
    """Another write has added the manifest version this one was to add."""


@dataclass(frozen=True)
class Collection:
    """A collection as of one manifest version."""

    path: str
    version: int
    dimension: int
    model: str
    buckets: int
    payload: dict[str, str]
    commits: dict[int, str]  # bucket -> commit, only buckets that hold rows

    @property
    def schema(self) -> T.StructType:
        columns = [("point_id", "bigint"), ("version", "bigint"), ("embedding", "array<float>"), *self.payload.items()]
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in columns))


def _newest(spark: SparkSession, path: str) -> int | None:
    try:
        row = spark.read.schema(_MANIFEST + ", version long").parquet(f"{path}/manifest").agg(F.max("version")).first()
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row[0]


def _commit(spark: SparkSession, c: Collection, rows: dict[int, int]) -> Collection:
    """Adds the manifest of ``c``; its files become visible by one rename."""
    config = json.dumps({"dimension": c.dimension, "model": c.model, "buckets": c.buckets, "payload": c.payload})
    lines = [(b, commit, rows.get(b, 0), config) for b, commit in sorted(c.commits.items())] or [(-1, None, 0, config)]
    try:
        spark.createDataFrame(lines, _MANIFEST).coalesce(1).write.mode("error").parquet(f"{c.path}/manifest/version={c.version}")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise Conflict(f"version {c.version} of {c.path} has been written meanwhile") from ex
    return c


def open_collection(spark: SparkSession, path: str, version: int | None = None) -> Collection:
    """The newest version, or the one asked for (earlier ones stay readable)."""
    version = _newest(spark, path) if version is None else version
    if version is None:
        raise ValueError(f"there is no collection at {path}")
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/version={version}").collect()
    config = json.loads(rows[0].config)
    return Collection(path, version, commits={r.bucket: r.commit for r in rows if r.commit is not None}, **config)


def create_collection(spark: SparkSession, path: str, dimension: int, model: str, payload: dict[str, str] | None = None, buckets: int = 64) -> Collection:
    """Create the collection, or open it where it exists already; one of
    another dimension, model or payload is refused."""
    if dimension <= 0 or buckets <= 0:
        raise ValueError("dimension and buckets must be positive")
    if _newest(spark, path) is None:
        try:
            return _commit(spark, Collection(path, 0, dimension, model, buckets, dict(payload or {}), {}), {})
        except Conflict:  # created by another job at the same time
            pass
    there = open_collection(spark, path)
    if (there.dimension, there.model, there.payload) != (dimension, model, dict(payload or {})):
        raise ValueError(f"{path} holds vectors of {there.dimension} dimensions of {there.model!r} with payload {there.payload}")
    return there


def read(spark: SparkSession, c: Collection, buckets: Sequence[int] | None = None) -> DataFrame:
    """Points of a version: (point_id, version, embedding, payload...), of all
    buckets or of some."""
    wanted = [b for b in sorted(c.commits) if buckets is None or b in set(buckets)]
    if not wanted:
        return spark.createDataFrame([], c.schema)
    return spark.read.schema(c.schema).parquet(*[f"{c.path}/data/commit={c.commits[b]}/bucket={b}" for b in wanted])


def _bucket(c: Collection):
    return F.pmod(F.xxhash64("point_id"), F.lit(c.buckets)).cast("int")


def _rewrite(spark: SparkSession, c: Collection, touched: list[int], merged: DataFrame) -> Collection:
    commit = uuid.uuid4().hex
    out = merged.select(*c.schema.fieldNames()).withColumn("bucket", _bucket(c))
    # AQE splits a bucket that is large and keeps small ones in one file each
    out.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{c.path}/data/commit={commit}")
    written = spark.read.schema(T.StructType([*c.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{c.path}/data/commit={commit}")
    rows = dict(written.groupBy("bucket").count().collect())
    kept = {b: x for b, x in c.commits.items() if b not in set(touched)}
    config = Collection(c.path, c.version + 1, c.dimension, c.model, c.buckets, c.payload, kept | dict.fromkeys(rows, commit))
    return _commit(spark, config, rows)


def _newest_rows(both: DataFrame) -> DataFrame:
    """Per point the row of the highest version; of equal ones the least by its digest.

    The rank limit drops all but one row a point in each task before the shuffle."""
    digest = F.xxhash64(*[c for c in both.columns if c != "point_id"])
    newest = Window.partitionBy("point_id").orderBy(F.col("version").desc(), F.col("_digest"))
    return both.withColumn("_digest", digest).withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_digest", "_nth")


def upsert(spark: SparkSession, c: Collection, updates: DataFrame, id_col: str, vec_col: str = "embedding", version: int | str = 0) -> Collection:
    """Insert or replace points; returns the collection's next version.

    ``version`` is a column or a number: per point the highest one stays, so a
    write that is repeated, or arrives late, changes nothing. Only buckets that
    the updates fall into are read and rewritten. A vector of another dimension
    or a missing id fails the write before anything becomes visible. Without
    updates no version is added."""
    number = F.col(version) if isinstance(version, str) else F.lit(version)
    given = updates.withColumn("_version", number.cast("bigint")).where(F.col(id_col).isNotNull() | F.raise_error(F.lit("a point has no id")).isNotNull())
    points = vector_table(given, id_col, vec_col, [*c.payload, "_version"], dim=c.dimension).withColumnRenamed("_version", "version")
    points = points.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in c.schema.fields])
    touched = [r[0] for r in points.select(_bucket(c).alias("b")).distinct().collect()]  # a row a bucket at most
    if not touched:
        return c
    return _rewrite(spark, c, touched, _newest_rows(read(spark, c, touched).unionByName(points)))


def delete(spark: SparkSession, c: Collection, ids: DataFrame, id_col: str = "point_id") -> Collection:
    """Remove points by id; only their buckets are rewritten."""
    gone = vector_table(ids.withColumn("_none", F.array().cast("array<float>")), id_col, "_none").select("point_id").distinct()
    touched = [r[0] for r in gone.select(_bucket(c).alias("b")).distinct().collect() if r[0] in c.commits]
    if not touched:
        return c
    return _rewrite(spark, c, touched, read(spark, c, touched).join(gone, "point_id", "left_anti"))
