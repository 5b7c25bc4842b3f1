"""Committed runs (S12 S13): a long job whose finished buckets survive, with a
commit log, resume and compaction.

Layout below ``path``::

    staged/run=<r>/_bucket=<b>/    the run's pending rows, written in one scan of the input
    data/run=<r>/bucket=<b>/attempt=<id>/   what the job made of a bucket
    log/generation=<g>/            one row a commit: run, bucket, where its rows are, how many;
                                   also one when a run has been staged

A bucket is committed by adding its row to the newest generation of the log,
after its files have been written; readers follow the log only, so files of an
attempt that was killed are never read. A run that is started again finds its
staged rows and its commits, and goes on with the buckets that are left.
Compaction writes the newest row of every key as one more attempt and then adds
a generation of the log that names nothing else: readers see the old rows or the
compacted ones, never both. One writer works on a path at a time.

The log is what the driver reads: a row a bucket and run, until compaction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "run_id long, bucket int, location string, n_rows long"
#: Bucket numbers of log rows that are no bucket: a run's rows are staged, compacted rows.
_STAGED, _COMPACTED = -2, -1


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(generation, run_id, bucket, location, n_rows) of the newest generation."""
    try:
        log = spark.read.schema(f"{_LOG}, generation long").parquet(f"{path}/log")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"generation long, {_LOG}")
    newest = log.agg(F.max("generation")).first()[0]
    return log.where(F.col("generation") == newest).select("generation", "run_id", "bucket", "location", "n_rows")


def _commit(spark: SparkSession, path: str, generation: int, run_id: int, bucket: int, location: str | None, rows: int) -> None:
    line = spark.createDataFrame([(run_id, bucket, location, rows)], _LOG).coalesce(1)
    line.write.mode("append").parquet(f"{path}/log/generation={generation}")  # one file, by one rename


def read_committed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All committed rows with their ``run_id``, None while nothing is committed."""
    done = [r for r in commits(spark, path).collect() if r.n_rows]
    if not done:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{path}/{r.location}" for r in done])


def latest(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """Per key the row of its newest run; the rank limit drops all but one row a key in each task."""
    rows = read_committed(spark, path)
    if rows is None:
        return None
    newest = Window.partitionBy(key).orderBy(F.col("run_id").desc(), F.xxhash64(*[c for c in rows.columns if c not in (key, "run_id")]))
    return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def run_committed(todo: DataFrame, key: str, job: Callable[[DataFrame], DataFrame], path: str, run_id: int, buckets: int = 16) -> DataFrame | None:
    """Run ``job`` over the rows of ``todo`` whose key no committed row has, bucket
    by bucket, and return the newest row of every key.

    ``todo`` is scanned once: pending rows are staged by the hash of their key, and
    each bucket is read from there. Started again with the same ``run_id`` after a
    failure, the staged rows are used as they are, committed buckets are left alone
    and the others are done anew."""
    if buckets <= 0:
        raise ValueError("buckets must be positive")
    spark = todo.sparkSession
    staged = f"{path}/staged/run={run_id}"
    log = commits(spark, path).collect()
    generation = log[0].generation if log else 0
    mine = {r.bucket for r in log if r.run_id == run_id}
    if _STAGED not in mine:
        before = read_committed(spark, path)
        rest = todo if before is None else todo.join(before.select(F.col(key).alias("_done")).distinct(), F.col(key) == F.col("_done"), "left_anti")
        rest = rest.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        rest.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(staged)
        _commit(spark, path, generation, run_id, _STAGED, None, 0)
    table = spark.read.schema(T.StructType([*todo.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(staged)
    pending = sorted(r[0] for r in table.select("_bucket").distinct().collect() if r[0] not in mine)  # a row a bucket
    for bucket in pending:
        location = f"data/run={run_id}/bucket={bucket}/attempt={uuid.uuid4().hex}"
        rows = table.where(F.col("_bucket") == bucket).drop("_bucket")
        job(rows).withColumn("run_id", F.lit(run_id).cast("long")).write.parquet(f"{path}/{location}")
        _commit(spark, path, generation, run_id, bucket, location, spark.read.parquet(f"{path}/{location}").count())
    return latest(spark, path, key)


def compact(spark: SparkSession, path: str, key: str) -> int:
    """Merge all committed runs into one attempt, the newest row of each key, and
    make the log name only that; returns its rows. Runs keep their numbers."""
    rows = latest(spark, path, key)
    if rows is None:
        return 0
    log = commits(spark, path).collect()
    location = f"data/compacted/attempt={uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(f"{path}/{location}")
    n = spark.read.parquet(f"{path}/{location}").count()
    # the buckets of finished runs stay in the log, without rows, so that their runs are still known as done
    lines = [(r.run_id, r.bucket, None, 0) for r in log if r.bucket != _COMPACTED] + [(-1, _COMPACTED, location, n)]
    spark.createDataFrame(lines, _LOG).coalesce(1).write.mode("error").parquet(f"{path}/log/generation={log[0].generation + 1}")
    return n
