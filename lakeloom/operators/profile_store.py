"""Profile state that is stored per ingest run and merged without rereading
the runs (AG4, AG9, AG12).

A run leaves three small tables below ``path``: ``fields`` (field partials of
``profile.field_partial``), ``texts`` (sums of ``profile.text_partial``) and
``keys`` (a HyperLogLog sketch of each key column with the number of its
non-blank values). With ``exact`` the run also leaves its distinct keys, so that
distinct counts and orphans over any choice of runs are exact. A run that is
repeated replaces its own state.

Sketches are Apache DataSketches HLL, built in the executors and merged by
union; with ``lg_k`` bits of buckets their relative standard error is about
1.04 / 2 ** (lg_k / 2).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.frames import skew_join, with_one_row
from lakeloom.operators.profile import clean_key, field_partial, fields_of, text_partial, texts_of

LG_K = 14


def key_partial(df: DataFrame, keys: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(key_name, n, sketch): values and HLL sketch of each key column, blank keys ignored."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), clean_key(k).alias("value")) for k in keys])).alias("k")).select("k.*")
    known = F.when(F.col("value").isNotNull(), F.col("value"))
    return rows.groupBy("key_name").agg(F.count("value").alias("n"), F.hll_sketch_agg(known, lg_k).alias("sketch"))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_name, value, n): the distinct non-blank values of each key column."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), clean_key(k).alias("value")) for k in keys])).alias("k")).select("k.*")
    return rows.where(F.col("value").isNotNull()).groupBy("key_name", "value").agg(F.count(F.lit(1)).alias("n"))


def save_run(path: str, run_id: str, records: DataFrame | None = None, tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]] | None = None, exact: bool = False, lg_k: int = LG_K) -> None:
    """Profile one run into the store. ``records`` are VARIANT objects for the
    field profile; ``tables`` names typed tables with their text and key columns."""

    def put(df, kind, *parts):
        df.write.mode("overwrite").parquet("/".join([path, kind, f"run_id={run_id}", *parts]))

    if records is not None:
        put(field_partial(records), "fields")
    for name, (df, texts, keys) in (tables or {}).items():
        if texts:
            put(text_partial(df, texts), "texts", f"table_name={name}")
        if keys:
            put(key_partial(df, keys, lg_k), "keys", f"table_name={name}")
            if exact:
                put(distinct_keys(df, keys), "key_values", f"table_name={name}")


def _stored(spark: SparkSession, path: str, kind: str, runs: Sequence[str] | None) -> DataFrame:
    df = spark.read.option("basePath", f"{path}/{kind}").parquet(f"{path}/{kind}")
    return df if runs is None else df.where(F.col("run_id").cast("string").isin(list(runs)))


def merged_fields(spark: SparkSession, path: str, required: Sequence[str] = (), places: int | None = 4, runs: Sequence[str] | None = None) -> DataFrame:
    """The field profile over all runs, or some, as ``profile.field_profile`` over their input."""
    return fields_of(_stored(spark, path, "fields", runs), required, places)


def merged_texts(spark: SparkSession, path: str, table: str, fields: Sequence[str], places: int | None = 2, runs: Sequence[str] | None = None) -> DataFrame:
    """Text counts and average lengths of a table over the runs, as ``profile.text_lengths``."""
    return texts_of(_stored(spark, path, "texts", runs).where(F.col("table_name") == table), fields, places=places)


def merged_keys(spark: SparkSession, path: str, exact: bool = False, runs: Sequence[str] | None = None) -> DataFrame:
    """(table_name, key_name, n, distinct_keys) over the runs: estimated from the
    sketches' union, or counted over the runs' distinct keys."""
    keys = ["table_name", "key_name"]
    if exact:
        values = _stored(spark, path, "key_values", runs).groupBy(*keys, "value").agg(F.sum("n").alias("n"))
        return values.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_keys"))
    sketches = _stored(spark, path, "keys", runs).groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))
    return sketches.select(*keys, "n", F.hll_sketch_estimate("sketch").alias("distinct_keys"))


def merged_orphans(spark: SparkSession, path: str, child: tuple[str, str], parent: tuple[str, str], exact: bool = False, runs: Sequence[str] | None = None) -> DataFrame:
    """One row (keys, orphans): distinct keys of the ``child`` (table, column) and how
    many of them no ``parent`` has; from sketches as union less parent."""

    def of(df, side):
        return df.where((F.col("table_name") == side[0]) & (F.col("key_name") == side[1]))

    if exact:
        values = _stored(spark, path, "key_values", runs)
        c = of(values, child).select("value").distinct()
        p = of(values, parent).select(F.col("value").alias("_pv"), F.lit(True).alias("_known")).distinct()
        joined = skew_join(c, p, "value", "_pv", "left")
        return joined.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_known").isNull()).alias("orphans"))
    sketches = _stored(spark, path, "keys", runs)
    one = of(sketches, child).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"))
    other = of(sketches, parent).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("parents"))
    both = of(sketches, child).unionByName(of(sketches, parent)).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("either"))
    row = with_one_row(with_one_row(one, other), both)
    orphans = F.greatest(F.lit(0).cast("long"), F.coalesce("either", F.lit(0)) - F.coalesce("parents", F.lit(0)))
    return row.select(F.coalesce("keys", F.lit(0)).alias("keys"), F.least(F.coalesce("keys", F.lit(0)), orphans).alias("orphans"))
