"""Helpers shared by the training-data operators: written tables, registry."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed value: the code points of White_Space in ASCII that the contracts split words at.
SPACE = " \t\n\x0b\x0c\r"
#: Fixed value: the smallest long stands in for a null id where ids are compared.
NO_ID = -(2**63)


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{root.rstrip('/')}/lakeloom-llm/{uuid.uuid4().hex}-{label}"


def written(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    Cuts the lineage: what follows survives the loss of any executor, and row
    numbers or partition ids in ``df`` are evaluated once and then stay.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def releasing(run):
    """The batch function ``run``; when its task ends, memory it has freed goes back to the system.

    Python workers live on for other stages, and allocators keep what they once
    had, so a stage's peak would stay with the next one's.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_of(col: str = "doc_id") -> Column:
    return F.col(col).cast("long")


def lower_ascii(c: Column) -> Column:
    upper = "".join(chr(x) for x in range(65, 91))
    return F.translate(c, upper, upper.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


