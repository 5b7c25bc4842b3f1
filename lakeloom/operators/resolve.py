"""Entity resolution: canonical products, mapping, review linking, duplicate
diagnosis.

First-occurrence rules are aggregates (``min_by`` over an explicit order),
not windows: the partial aggregate shrinks a key that holds a large share of
all rows map-side, where a window would put the whole group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.frames import skew_join
from lakeloom.functions.text import normalize_lower, strip
from lakeloom.sources.raw import POSITION

# Mapping labels (match types, confidence, status).
CANONICAL = "canonical"
EXACT_ASIN_DUPLICATE = "exact_asin_duplicate"
CONFIDENCE = 1.0
RESOLVED = "resolved"
MISSING_KEY = "missing_key"
UNRESOLVED = "unresolved"


def missing_key_count(products: DataFrame, key: str = "asin") -> int:
    """F7 helper: NULL and blank keys both count (K15 fixed)."""
    k = F.col(key)
    return products.agg(F.count_if(k.isNull() | (strip(k) == "")).alias("n")).first()["n"]


def require_keys(products: DataFrame, key: str = "asin") -> None:
    """F7 as a job of its own: refuse to resolve when any key is missing."""
    n = missing_key_count(products, key)
    if n:
        raise ValueError(f"{n} products have a missing {key}; resolve silver data only")


def is_missing(key: str):
    return F.col(key).isNull() | (strip(F.col(key)) == "")


def guarded(products: DataFrame, key: str = "asin") -> DataFrame:
    """F7 inside the plan: the rows as they are; a job that meets a missing key
    (NULL or blank) fails. Nothing is counted beforehand, and the check can't be
    optimized away, as the key itself goes through it."""
    bad = F.raise_error(F.lit(f"a product has a missing {key}; resolve silver data only")).cast(products.schema[key].dataType)
    return products.withColumn(key, F.when(is_missing(key), bad).otherwise(F.col(key)))


def _order(order_by: str | Sequence[str]):
    return F.col(order_by) if isinstance(order_by, str) else F.struct(*[F.col(c) for c in order_by])


def canonical_products(products: DataFrame, key: str = "asin", order_by: str | Sequence[str] = POSITION) -> DataFrame:
    """The first row of every key in the order of ``order_by`` (by default
    the position in the source files), whole row."""
    others = [c for c in products.columns if c != key]
    first = F.min_by(F.struct(*[F.col(c) for c in others]), _order(order_by)).alias("_row")
    return products.groupBy(key).agg(first).select(key, "_row.*").select(*products.columns)


def canonical_ids(products: DataFrame, key: str = "asin", product_id: str = "product_id",
                  order_by: str | Sequence[str] = POSITION) -> DataFrame:
    """key -> canonical product id (the id of the first row)."""
    return products.groupBy(key).agg(F.min_by(F.col(product_id), _order(order_by)).alias("canonical_product_id"))


def entity_mapping(products: DataFrame, key: str = "asin", product_id: str = "product_id",
                   order_by: str | Sequence[str] = POSITION, on_missing: str = "fail") -> DataFrame:
    """Every source row with its canonical id, match type, confidence and
    status. The canonical table has one row per key; AQE broadcasts it or
    splits a hot key.

    F7: a row whose key is missing (NULL or blank) has nothing to resolve to.
    With ``on_missing="fail"`` the job that meets one fails; with "unresolved" it
    is returned without a canonical id, as ``missing_key``, confidence 0 and
    status ``unresolved``. No row is ever left out."""
    if on_missing not in ("fail", "unresolved"):
        raise ValueError(f"on_missing must be 'fail' or 'unresolved', got {on_missing!r}")
    if on_missing == "fail":
        source = guarded(products, key)
    else:
        source = products.withColumn(key, F.when(~is_missing(key), F.col(key)))
    canon = canonical_ids(source.where(F.col(key).isNotNull()), key, product_id, order_by).withColumnRenamed(key, "_ckey")
    src = source.select(F.col(product_id).alias("source_product_id"), F.col(key))
    found = F.col("_ckey").isNotNull()
    return skew_join(src, canon, key, "_ckey", "left").select(
        "source_product_id",
        F.col(key).alias("asin"),
        "canonical_product_id",
        F.when(~found, MISSING_KEY)
        .when(F.col("source_product_id") == F.col("canonical_product_id"), CANONICAL)
        .otherwise(EXACT_ASIN_DUPLICATE)
        .alias("match_type"),
        F.when(found, F.lit(CONFIDENCE)).otherwise(F.lit(0.0)).alias("confidence_score"),
        F.when(found, RESOLVED).otherwise(UNRESOLVED).alias("resolution_status"),
    )


def attach_canonical(reviews: DataFrame, mapping: DataFrame, review_key: str = "asin",
                     mapping_key: str = "asin", canonical: str = "canonical_product_id") -> DataFrame:
    """Reviews left-joined to a key-unique mapping. Duplicated mapping
    keys are reduced first so the join cannot fan out; a hot product key is
    split by AQE (see ``skew_join``)."""
    m = mapping.groupBy(F.col(mapping_key).alias("_mkey")).agg(F.max(canonical).alias("canonical_product_id"))
    return skew_join(reviews, m, review_key, "_mkey").drop("_mkey")


def split_resolved(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F8."""
    return (
        linked.where(F.col("canonical_product_id").isNotNull()),
        linked.where(F.col("canonical_product_id").isNull()),
    )


def resolution_totals(products: DataFrame, key: str = "asin") -> DataFrame:
    """AG17 (products): input, canonical, duplicates removed, percentage."""
    return products.agg(F.count(F.lit(1)).alias("input_products"), F.countDistinct(key).alias("canonical_products")).select(
        "input_products",
        "canonical_products",
        (F.col("input_products") - F.col("canonical_products")).alias("duplicates_removed"),
        F.coalesce(
            F.try_divide((F.col("input_products") - F.col("canonical_products")) * 100.0, F.col("input_products")),
            F.lit(0.0),
        ).alias("duplicate_percentage"),
    )


def review_resolution_totals(linked: DataFrame) -> DataFrame:
    """AG17 (reviews): resolved, unresolved, resolution rate."""
    ok = F.col("canonical_product_id").isNotNull()
    return linked.agg(F.count_if(ok).alias("resolved_reviews"), F.count_if(~ok).alias("unresolved_reviews")).select(
        "resolved_reviews",
        "unresolved_reviews",
        F.coalesce(
            F.try_divide(F.col("resolved_reviews") * 100.0, F.col("resolved_reviews") + F.col("unresolved_reviews")),
            F.lit(0.0),
        ).alias("resolution_rate"),
    )


def duplicate_groups(df: DataFrame, key, min_count: int = 2) -> DataFrame:
    """AG15 F10: keys with at least ``min_count`` rows (``cnt``)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)


def diagnose_duplicates(
    df: DataFrame,
    key,
    order_by: str,
    compare: Mapping[str, str],
) -> DataFrame:
    """J8 AG16: over groups of exactly two rows, count exact duplicates and
    per-field differences. ``compare`` maps field -> 'text' (P16 normalized
    equality) or 'value' (null-safe equality). Two rows agree in a field where the
    least and the greatest of two independent 64-bit hashes of it are the same, so
    the aggregation state is a few longs a group: it is hash-aggregated, no group
    is collected, nothing is sorted or joined with itself and texts are not
    shuffled. As the two rows are alike, ``order_by`` does not matter to the counts.
    Groups of three or more are counted as skipped (K17)."""
    k = F.col(key) if isinstance(key, str) else key
    hashes = {}
    for name, kind in compare.items():
        value = normalize_lower(name) if kind == "text" else F.col(name)
        hashes |= {f"{name}.1": F.xxhash64(value), f"{name}.2": F.xxhash64(F.lit(1), value)}
    rows = df.select(k.alias("_key"), *[h.alias(f"_{i}") for i, h in enumerate(hashes.values())])
    ends = [f(f"_{i}").alias(f"{n}_{i}") for i in range(len(hashes)) for n, f in (("lo", F.min), ("hi", F.max))]
    g = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), *ends)
    equal = lambda i: F.col(f"lo_{i}") == F.col(f"hi_{i}")
    same = {name: equal(2 * i) & equal(2 * i + 1) for i, name in enumerate(compare)}
    pair = F.col("_n") == 2
    all_same = None
    for v in same.values():
        all_same = v if all_same is None else (all_same & v)
    aggs = [
        F.count_if(pair).alias("total_groups"),
        F.count_if(F.col("_n") > 2).alias("skipped_groups"),
        F.count_if(pair & all_same).alias("exact_duplicates"),
    ]
    aggs += [F.count_if(pair & ~v).alias(f"{name}_differences") for name, v in same.items()]
    return g.agg(*aggs)
