"""Multimodal product features (J5 P20-P24 AG18) and image tasks (P25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_string, has_text, labeled


def _nonempty(c) -> F.Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def multimodal_features(
    summary: DataFrame,
    products: DataFrame,
    summary_id: str = "canonical_product_id",
    product_id: str = "product_id",
    order_by: str | None = None,
) -> DataFrame:
    """Inner join of the product summary with product metadata (one metadata
    row per id: duplicates are reduced on the join key, which shares the
    join's partitioning; the last by ``order_by`` stays, without it the
    greatest by value) and assembly of the labeled text:

        Title: ...\\nBrand: ...\\nCategory: ...\\nDescription: ...\\nFeatures:\\n- a\\n- b

    Blank parts are left out (no leading newline, K22). Images are the
    high-resolution list when non-empty, else the normal list (P23)."""
    meta = (
        products.select(
            F.col(product_id).alias("_pid"),
            F.col("description").alias("_description"),
            F.col("features").alias("_features"),
            F.col("image_urls").alias("_images"),
            F.col("high_res_image_urls").alias("_hi_images"),
            *([F.col(order_by).alias("_order")] if order_by else []),
        )
    )
    # a struct compares by its first fields, so the order comes first and equal orders are told apart by value
    others = sorted((c for c in meta.columns if c != "_pid"), key=lambda c: c != "_order")
    meta = meta.groupBy("_pid").agg(F.max(F.struct(*others)).alias("_m")).select("_pid", *[F.col(f"_m.{c}").alias(c) for c in others])
    j = summary.join(meta, summary[summary_id] == meta["_pid"], "inner")
    feats = F.filter(F.transform(F.col("_features"), lambda x: clean_string(x)), lambda x: x.isNotNull())
    feature_text = F.array_join(F.transform(feats, lambda x: F.concat(F.lit("- "), x)), "\n")
    desc = clean_string("_description")
    text = F.concat_ws(
        "\n",
        labeled("Title", "title"),
        labeled("Brand", "brand"),
        labeled("Category", "main_category"),
        F.when(desc.isNotNull(), F.concat(F.lit("Description: "), desc)),
        F.when(F.coalesce(F.size(feats) > 0, F.lit(False)), F.concat(F.lit("Features:\n"), feature_text)),
    )
    images = (
        F.when(_nonempty(F.col("_hi_images")), F.col("_hi_images"))
        .when(_nonempty(F.col("_images")), F.col("_images"))
        .otherwise(F.array().cast("array<string>"))
    )
    return j.select(
        F.col(summary_id).alias("canonical_product_id"),
        "asin",
        "title",
        "brand",
        "main_category",
        "price",
        text.alias("text_content"),
        images.alias("image_urls"),
    ).select("*", has_text("text_content").alias("has_text"), _nonempty(F.col("image_urls")).alias("has_image"))


def feature_totals(features: DataFrame) -> DataFrame:
    """AG18."""
    return features.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if("has_text").alias("with_text"),
        F.count_if("has_image").alias("with_image"),
        F.count_if(F.col("has_text") & F.col("has_image")).alias("with_text_and_image"),
    )


def image_tasks(features: DataFrame, id_col: str = "canonical_product_id", images: str = "image_urls",
                keep: tuple[str, ...] = ("asin",)) -> DataFrame:
    """P25: one task per product with a non-empty first image URL."""
    first = F.get(F.col(images), 0)
    return features.where(F.coalesce(first != "", F.lit(False))).select(id_col, *keep, first.alias("image_url"))
