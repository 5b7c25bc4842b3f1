"""Structured Streaming ingest (stage 7).

The raw parser and the normalizers are stateless column expressions, so the
same functions run on ``readStream``. Each micro-batch is written with
``foreachBatch`` into the routed silver/quarantine layout; duplicates are
removed with a watermark (``dropDuplicatesWithinWatermark``), so the state
only holds keys seen within the allowed lateness. The checkpoint location
makes the stream restartable after a driver or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources.raw import parse_records


def read_raw_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new files in ``path`` as they arrive (text source)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("value").alias("line"))


def dedupe_within_watermark(df: DataFrame, key: str | list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def parse_stream(lines: DataFrame) -> DataFrame:
    """S1 on a stream: ``record`` VARIANT and ``parse_error`` per line."""
    return parse_records(lines, "line")


def start_to_parquet(
    df: DataFrame,
    out_path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    available_now: bool = True,
):
    """Write every micro-batch as Parquet into its own ``batch_id``
    partition (dynamic overwrite: a replayed batch replaces its output);
    returns the query."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", *(partition_by or []))
            .parquet(out_path)
        )

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_ingest(
    spark: SparkSession,
    source_path: str,
    entity: str,
    out_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Raw files arriving in ``source_path`` -> canonical rows and quarantine
    rows (error code, raw line) under ``out_path``. Parsing and normalization
    are the batch functions; each micro-batch is written by
    ``silver.write_routed`` into the partition ``run_id=batch-<id>`` with
    dynamic overwrite, so a micro-batch replayed after a failure replaces its
    own output instead of duplicating it."""
    from lakeloom.operators.ingest import ingest
    from lakeloom.operators.silver import write_routed

    lines = read_raw_stream(spark, source_path, max_files_per_trigger)
    normalized = ingest(lines, entity)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_routed(batch, out_path, run_id=f"batch-{batch_id:09d}")

    writer = normalized.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
