"""Silver layer: validation split, quarantine routing and quality profiles.

One flagged DataFrame feeds both sinks. ``write_routed`` writes silver and
quarantine rows in a single job (partitioned by route), so the source is
scanned once and nothing is persisted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.frames import skew_join, with_one_row

from lakeloom.functions.text import is_blank

ROUTE = "_route"
# Fixed value: the product error code shared with normalization.
MISSING_ASIN = "missing_asin"
# Review quarantine codes, in the order the checks run.
UNKNOWN_PRODUCT = "unknown_product"
INVALID_RATING = "invalid_rating"


def present_key(c) -> F.Column:
    """Key is usable: not NULL and not ''."""
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


# ------------------------------------------------------------------ products
def flag_products(products: DataFrame, asin: str = "asin") -> DataFrame:
    """error column 'missing_asin' for NULL or '' keys, NULL otherwise."""
    return products.withColumn("error", F.when(~present_key(asin), F.lit(MISSING_ASIN)))


def split_products(products: DataFrame, asin: str = "asin") -> tuple[DataFrame, DataFrame]:
    flagged = flag_products(products, asin)
    return flagged.where("error IS NULL").drop("error"), flagged.where("error IS NOT NULL")


def product_key_set(products: DataFrame, asin: str = "asin") -> DataFrame:
    """Distinct usable product keys (one column named ``asin``)."""
    return products.where(present_key(asin)).select(F.col(asin).alias("_key")).distinct()


# ------------------------------------------------------------------- reviews
def flag_reviews(
    reviews: DataFrame,
    key_set: DataFrame,
    asin: str = "asin",
    rating: str = "rating",
    min_rating: float = 1.0,
    max_rating: float = 5.0,
) -> DataFrame:
    """Left join on the distinct key set adds ``error``:
    'unknown_product' (NULL keys included, K11) first, then 'invalid_rating'
    (NULL or outside [min_rating, max_rating]). Spark picks broadcast or
    shuffled join from the key set's runtime size (AQE); a hot review key is
    split by the skew-join rule (see ``skew_join``)."""
    keys = key_set.select(F.col("_key"), F.lit(True).alias("_known"))
    joined = skew_join(reviews, keys, asin, "_key")
    r = F.col(rating)
    error = (
        F.when(F.col("_known").isNull(), F.lit(UNKNOWN_PRODUCT))
        .when(r.isNull() | ~r.between(min_rating, max_rating), F.lit(INVALID_RATING))
    )
    return joined.withColumn("error", error).drop("_key", "_known")


def split_reviews(reviews: DataFrame, key_set: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    flagged = flag_reviews(reviews, key_set, **kw)
    return flagged.where("error IS NULL").drop("error"), flagged.where("error IS NOT NULL")


def write_routed(flagged: DataFrame, path: str, run_id: str, compression: str = "zstd") -> dict[str, int]:
    """One pass writes ``route=silver`` and ``route=quarantine``
    under ``path/run_id=...``; re-running a run id replaces all
    its rows and no others. The counts per route are observed during the same write."""
    from pyspark.sql import Observation

    obs = Observation(f"routed-{run_id}")
    ok = F.col("error").isNull()
    out = flagged.withColumn(ROUTE, F.when(ok, "silver").otherwise("quarantine")).observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ok).alias("silver"),
        F.count_if(~ok).alias("quarantine"),
    )
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # also clears a route that has no rows this time
        .option("compression", compression)
        .partitionBy(ROUTE)
        .parquet(f"{path}/run_id={run_id}")
    )
    return {k: int(v) for k, v in obs.get.items()}


# ------------------------------------------------------------------ profiles
def product_quality(products: DataFrame, asin: str = "asin", title: str = "title", exact: bool = True) -> DataFrame:
    """AG1 AG3: one row. Missing counts NULL or '' once (K3 fixed);
    duplicate rows = total - distinct usable keys (K12)."""
    distinct = F.countDistinct if exact else F.approx_count_distinct
    key = F.when(present_key(asin), F.col(asin))
    missing = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))
    return products.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct(key).alias("unique_asin"),
        missing(asin).alias("missing_asin"),
        missing(title).alias("missing_title"),
    ).select(
        "total_records",
        "unique_asin",
        (F.col("total_records") - F.col("unique_asin")).alias("duplicate_asin_records"),
        "missing_asin",
        "missing_title",
        F.coalesce(
            F.try_divide((F.col("total_records") - F.col("unique_asin")) * 100.0, F.col("total_records")),
            F.lit(0.0),
        ).alias("duplicate_percentage"),
    )


def review_quality(
    reviews: DataFrame,
    key_set: DataFrame,
    asin: str = "asin",
    review_id: str = "review_id",
    reviewer: str = "reviewer_id",
    rating: str = "rating",
    text: str = "review_text",
    min_rating: float = 1.0,
    max_rating: float = 5.0,
    exact: bool = True,
) -> DataFrame:
    """AG2: one row of review counts; orphans as in F5.

    Reviews are reduced to one row per key before they meet the key set, so
    the join carries no hot key, and each distinct count is an aggregate of
    its own: no review row is expanded once per distinct column."""
    truthy = lambda c: F.when(present_key(c), F.col(c))
    r = F.col(rating)

    def distinct(c, name):
        if not exact:
            return reviews.agg(F.approx_count_distinct(truthy(c)).alias(name))
        return reviews.select(truthy(c).alias("_d")).distinct().agg(F.count("_d").alias(name))

    rows = reviews.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(r.isNull() | ~r.between(min_rating, max_rating)).alias("invalid_rating"),
        F.count_if(is_blank(text)).alias("missing_review_text"),
    )
    counts = reviews.groupBy(F.col(asin).alias("_asin")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = counts.join(key_set, counts["_asin"] == key_set["_key"], "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_reviews"),
        F.count(truthy("_asin")).alias("orphan_asin_count"),
    )
    out = rows
    for part in (distinct(review_id, "unique_review_id"), distinct(reviewer, "unique_reviewers"), orphans):
        out = with_one_row(out, part)
    return out.select("total_records", "unique_review_id", "unique_reviewers", "invalid_rating", "orphan_reviews",
                      "orphan_asin_count", "missing_review_text")


def silver_status(product_q: DataFrame, review_q: DataFrame) -> DataFrame:
    """AG20: both quality rows side by side plus PASS/WARN."""
    p = product_q.select([F.col(c).alias(f"product_{c}") for c in product_q.columns])
    r = review_q.select([F.col(c).alias(f"review_{c}") for c in review_q.columns])
    both = with_one_row(p, r)
    warn = (F.col("product_missing_asin") > 0) | (F.col("review_invalid_rating") > 0) | (F.col("review_orphan_reviews") > 0)
    return both.withColumn("status", F.when(warn, "WARN").otherwise("PASS"))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent (usable keys only)."""
    c = child.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("key")).distinct()
    p = parent.select(F.col(parent_key).alias("key"))
    return c.join(p, "key", "left_anti")
