"""Sinks: Parquet tables with row counts, JSON reports, layer publishing
(S6-S11).

Row counts come from ``DataFrame.observe`` during the write, so no second
pass over the data is needed. Distinct counts cannot be observed (K29); they
belong in the report aggregations instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> int:
    """Write Parquet (zstd by default, snappy for the raw layer)
    and return the number of rows written, observed in the same job."""
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """``n_rows`` of a Parquet table. The scan reads no column, so each
    task takes the row count of its row groups from the footer."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))


def write_quarantine(invalid: DataFrame, path: str, run_id: str, entity: str) -> int:
    """S9 (K25 fixed): quarantine rows (error, record) as JSON lines under
    ``entity=.../run_id=...``; re-running a run replaces only that run."""
    obs = Observation("quarantined")
    out = invalid.observe(obs, F.count(F.lit(1)).alias("rows"))
    # the run's folder is replaced as a whole, also when it has no rows now
    out.write.mode("overwrite").json(f"{path}/entity={entity}/run_id={run_id}")
    return int(obs.get["rows"])


def write_report(report: DataFrame, path: str) -> None:
    """A report is a small DataFrame (one row or a short list of checks);
    it is written as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def publish(spark: SparkSession, source: str, destination: str, schema: T.StructType | None = None) -> int:
    """S11 (re-aimed): check that the source layer exists and has the
    expected columns, then write it to the next layer."""
    try:
        df = spark.read.parquet(source)
    except Exception as ex:  # noqa: BLE001
        raise FileNotFoundError(f"source layer is missing: {source}") from ex
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"{source} lacks columns {missing}")
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return write_parquet(df, destination)
