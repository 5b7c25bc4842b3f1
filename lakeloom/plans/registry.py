"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracles.

A query is a function (spark, sf_dir) -> DataFrame that builds a role view
(plans.roles) and calls library operators on it. The oracle is independent
SQL over the same parquet tables. Floats are rounded to 6 places on both
sides, arrays are rendered as text, and column names agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double/float column so both engines hash the same text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
