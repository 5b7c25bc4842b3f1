"""Raw JSON-lines source (S1 S2) and record parsing.

Lines are read as text, never with ``spark.read.json``: the JSON reader
accepts trailing junk and explodes top-level arrays into rows (K7). Each line
is parsed once into a VARIANT; bad lines become rows of a second DataFrame
instead of log messages (K8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.frames import boundary
from lakeloom.functions.text import strip

MALFORMED = "malformed_json"
NOT_OBJECT = "not_object"
BLANK = "blank"


#: Columns that order raw lines: file, byte at which the line's split of the file starts, row in the scan.
POSITION = ("source_file", "block", "seq")


def read_lines(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Lines of one or more text files with their position, taken from the
    scan's metadata before any shuffle: ordered by ``POSITION`` they come as in
    the files, whatever the size of splits and however splits are packed into
    tasks (``seq`` alone ascends within a split only). Input keeps the scan's
    splits unless ``partitions`` is given: gzip files are one task each, so few
    large ones want it (the position is taken before the rows move)."""
    df = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    return df if partitions is None else spread(df, partitions)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """``lines`` of ``read_lines`` with ``line_no``, a line's number in its file
    from 0. One row a split is aggregated (its first ``seq`` and its lines), and
    the lines of a file's earlier splits are summed; no line is sorted."""
    splits = lines.groupBy("source_file", "block").agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = splits.select(F.col("source_file").alias("_f"), F.col("block").alias("_b"), "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    joined = lines.join(base, (F.col("source_file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    return joined.select(*lines.columns, (F.col("_base") + F.col("seq") - F.col("_first")).alias("line_no"))


def _parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Tasks that the lines of one split of the scan are dealt to.
TASKS_A_SPLIT = 8


def _splits(lines: DataFrame) -> int:
    try:
        return lines.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDDs (Spark Connect)
        return 1


def spread(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin the raw lines, as scanned, over ``partitions`` tasks (default:
    ``TASKS_A_SPLIT`` for each split of the scan, whose size is bounded, so that
    more input makes more tasks and not longer ones; at least the cluster's
    parallelism). Raw sources arrive in few splits (a gzip file is
    one task, a single Parquet row group is one task), while parsing and
    cleaning are CPU-bound per line; one shuffle of the raw text lets every
    core work on them."""
    n = partitions or max(_parallelism(lines.sparkSession), TASKS_A_SPLIT * _splits(lines))
    if n <= 0:
        raise ValueError("partitions must be positive")
    return lines.repartition(n)


def parse_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds ``record`` (VARIANT) and ``parse_error``; blank lines are dropped.

    A line is malformed when it does not parse or carries text after its
    first value; it is 'not_object' when it parses to anything but an
    object. ``NaN`` literals are malformed (Python would accept them).

    The variant parser stops after the first value, so ``{"a":1}{"b":2}``
    parses. A line whose only ``}`` is its last character cannot have text
    after its object. Any other line is parsed as the first element
    of an array whose second one is the line's own hash: text after the value
    breaks the array or moves the hash from its place. Each line is parsed once;
    every step is a column of its own, as Catalyst copies the tree of a test
    into each CASE that asks for it.
    """
    s, plain, mark, parsed, whole, err = (F.col(x) for x in ("_stripped", "_plain", "_mark", "_parsed", "_whole", "_err"))
    staged = lines.withColumn("_stripped", strip(line))
    before_last = F.substring(s.cast("binary"), F.lit(1), F.octet_length(s) - 1).cast("string")
    staged = staged.withColumn("_plain", s.startswith("{") & s.endswith("}") & ~before_last.contains("}"))
    staged = staged.withColumn("_mark", F.when(~plain, F.xxhash64(line)))
    wrapped = F.concat(F.lit("["), F.col(line), F.lit(","), mark.cast("string"), F.lit("]"))
    staged = staged.withColumn("_parsed", F.try_parse_json(F.when(plain, F.col(line)).otherwise(wrapped)))
    staged = staged.withColumn("_whole", F.when(plain, parsed.isNotNull()).otherwise(F.coalesce(F.to_json(F.try_variant_get(parsed, "$[1]", "variant")) == mark.cast("string"), F.lit(False))))
    staged = staged.withColumn("_err", F.when(s == "", F.lit(BLANK)).when(~whole, F.lit(MALFORMED)).when(~s.startswith("{"), F.lit(NOT_OBJECT)))
    record = F.when(err.isNull(), F.when(plain, parsed).otherwise(F.try_variant_get(parsed, "$[0]", "variant")))
    out = boundary(staged.select(*lines.columns, record.alias("record"), err.alias("parse_error")))
    return out.where(F.col("parse_error").isNull() | (F.col("parse_error") != BLANK))


def split_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects, bad lines) from ``parse_records``."""
    good = parsed.where(F.col("parse_error").isNull()).drop("parse_error")
    bad = parsed.where(F.col("parse_error").isNotNull()).drop("record")
    return good, bad


def head(records: DataFrame, n: int, order_by: str | Sequence[str] = POSITION) -> DataFrame:
    """T1 (``--max-records``): the first ``n`` good records in source order,
    file by file; columns of the order that the records don't have are left out.
    The plan is a per-partition top-n (TakeOrderedAndProject), so only n rows per
    task move to the final merge."""
    if n <= 0:
        raise ValueError("n must be positive")
    given = [order_by] if isinstance(order_by, str) else list(order_by)
    there = [c for c in given if c in records.columns]
    if not there:
        raise ValueError(f"records have none of the columns {given}")
    return records.orderBy(*there).limit(n)
