"""g*: gold tables on the review view of lineitem and the product view of part."""

from __future__ import annotations

from lakeloom.operators import gold
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.roles import PRODUCTS_SQL, reviews_sql, sql_clean, sql_has_text

_HT = sql_has_text("review_text")

G1_SQL = f"""
WITH reviews AS ({reviews_sql()})
SELECT product_key AS canonical_product_id,
       count(*) AS review_count,
       round(sum(coalesce(rating, 0)) / count(*), 6) AS avg_rating,
       count(*) FILTER (WHERE coalesce(verified, FALSE)) AS verified_review_count,
       round(count(*) FILTER (WHERE coalesce(verified, FALSE)) / count(*), 6) AS verified_review_ratio,
       count(*) FILTER (WHERE {_HT}) AS review_with_text_count,
       count(*) FILTER (WHERE coalesce(len(image_urls) > 0, FALSE)) AS review_with_image_count,
       round(coalesce(sum(length(review_text)) FILTER (WHERE {_HT})
             / nullif(count(*) FILTER (WHERE {_HT}), 0), 0), 6) AS avg_review_length
FROM reviews WHERE product_key IS NOT NULL
GROUP BY product_key
"""


@register("g1_product_review_stats", G1_SQL)
def g1_product_review_stats(spark, sf_dir):
    r = roles.reviews(spark, sf_dir)
    return rounded(gold.product_review_stats(r, key="product_key"))


G2_SQL = f"""
WITH reviews AS ({reviews_sql()})
SELECT reviewer_key AS reviewer_id,
       count(*) AS review_count,
       round(sum(coalesce(rating, 0)) / count(*), 6) AS avg_rating,
       count(*) FILTER (WHERE coalesce(verified, FALSE)) AS verified_review_count,
       round(coalesce(sum(CASE WHEN {_HT} THEN length(review_text) ELSE 0 END), 0) / count(*), 6)
           AS avg_review_length
FROM reviews WHERE reviewer_key IS NOT NULL
GROUP BY reviewer_key
"""


@register("g2_reviewer_stats", G2_SQL)
def g2_reviewer_stats(spark, sf_dir):
    r = roles.reviews(spark, sf_dir)
    return rounded(gold.reviewer_stats(r, key="reviewer_key"))


G3_SQL = f"""
WITH products AS ({PRODUCTS_SQL})
SELECT product_key AS canonical_product_id, asin, title, brand, main_category,
       round(price, 6) AS price,
       {sql_clean('description')} IS NOT NULL AS has_description,
       coalesce(len(image_urls) > 0, FALSE) AS has_image
FROM products
"""


@register("g3_product_summary", G3_SQL)
def g3_product_summary(spark, sf_dir):
    p = roles.products(spark, sf_dir)
    return rounded(gold.product_summary(p, product_id="product_key"))

