"""Gold tables: product summary, product review statistics, reviewer statistics.

Both statistics are one ``groupBy().agg()`` each: Spark runs a partial
(map-side) aggregate, so a product or reviewer holding a large share of all
reviews is reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_string, has_text


def _nonempty(c) -> F.Column:
    return F.coalesce(F.size(F.col(c)) > 0, F.lit(False))


def product_summary(
    products: DataFrame,
    product_id: str = "product_id",
    asin: str = "asin",
    title: str = "title",
    brand: str = "brand",
    main_category: str = "main_category",
    price: str = "price",
    description: str = "description",
    image_urls: str = "image_urls",
) -> DataFrame:
    """One row per product with the has_description / has_image flags."""
    return products.select(
        F.col(product_id).alias("canonical_product_id"),
        F.col(asin).alias("asin"),
        F.col(title).alias("title"),
        F.col(brand).alias("brand"),
        F.col(main_category).alias("main_category"),
        F.col(price).alias("price"),
        clean_string(description).isNotNull().alias("has_description"),
        _nonempty(image_urls).alias("has_image"),
    )


def product_review_stats(
    reviews: DataFrame,
    key: str = "canonical_product_id",
    rating: str = "rating",
    verified: str = "verified",
    text: str = "review_text",
    images: str = "image_urls",
) -> DataFrame:
    """AG13. Rows with a NULL key are left out. ``avg_rating`` divides the sum
    of known ratings by all rows (K16); ``avg_review_length`` divides the
    length of non-blank texts by their number (0 when there is none)."""
    t = has_text(text)
    agg = (
        reviews.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.sum(F.coalesce(F.col(rating).cast("double"), F.lit(0.0))).alias("_rating_sum"),
            F.count_if(F.coalesce(F.col(verified), F.lit(False))).alias("verified_review_count"),
            F.count_if(t).alias("review_with_text_count"),
            F.count_if(_nonempty(images)).alias("review_with_image_count"),
            F.sum(F.when(t, F.length(text))).alias("_length_sum"),
        )
    )
    return agg.select(
        F.col(key).alias("canonical_product_id"),
        "review_count",
        (F.col("_rating_sum") / F.col("review_count")).alias("avg_rating"),
        "verified_review_count",
        (F.col("verified_review_count") / F.col("review_count")).alias("verified_review_ratio"),
        "review_with_text_count",
        "review_with_image_count",
        F.when(F.col("review_with_text_count") > 0, F.col("_length_sum") / F.col("review_with_text_count"))
        .otherwise(F.lit(0.0))
        .alias("avg_review_length"),
    )


def reviewer_stats(
    reviews: DataFrame,
    key: str = "reviewer_id",
    rating: str = "rating",
    verified: str = "verified",
    text: str = "review_text",
) -> DataFrame:
    """AG14: as AG13 per reviewer, but the average length divides by the
    review count (K16)."""
    t = has_text(text)
    agg = (
        reviews.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.sum(F.coalesce(F.col(rating).cast("double"), F.lit(0.0))).alias("_rating_sum"),
            F.count_if(F.coalesce(F.col(verified), F.lit(False))).alias("verified_review_count"),
            F.sum(F.when(t, F.length(text)).otherwise(F.lit(0))).alias("_length_sum"),
        )
    )
    return agg.select(
        F.col(key).alias("reviewer_id"),
        "review_count",
        (F.col("_rating_sum") / F.col("review_count")).alias("avg_rating"),
        "verified_review_count",
        (F.col("_length_sum") / F.col("review_count")).alias("avg_review_length"),
    )
