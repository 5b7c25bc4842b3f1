"""v*: silver split, quarantine, orphan keys and the quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import silver
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.roles import KEYED_DOCUMENTS_SQL, PRODUCT_KEYS_SQL, PRODUCTS_SQL, reviews_sql, sql_has_text

# whole rows; the list column is rendered as text at the end
_REVIEW_COLS = ["l_orderkey", "l_linenumber", "product_key", "reviewer_key", "rating", "verified", "review_text", "review_id"]


def _images():
    return F.array_join("image_urls", "|").alias("image_urls")


def _flagged_reviews(spark, sf_dir):
    r = roles.reviews(spark, sf_dir, rating_mod=7)
    keys = silver.product_key_set(roles.product_keys(spark, sf_dir), asin="p_partkey")
    return silver.flag_reviews(r, keys, asin="product_key", rating="rating")


_FLAGGED_SQL = f"""
WITH reviews AS ({reviews_sql(7)}),
     keys AS (SELECT DISTINCT p_partkey AS k FROM ({PRODUCT_KEYS_SQL}) WHERE p_partkey IS NOT NULL),
     flagged AS (
       SELECT l_orderkey, l_linenumber, product_key, reviewer_key, rating, verified, review_text, review_id,
              array_to_string(image_urls, '|') AS image_urls,
              CASE WHEN k IS NULL THEN 'unknown_product'
                   WHEN rating IS NULL OR NOT (rating BETWEEN 1 AND 5) THEN 'invalid_rating' END AS error
       FROM reviews LEFT JOIN keys ON product_key = k)
"""


@register("v1_silver_reviews", _FLAGGED_SQL + "SELECT * EXCLUDE (error) FROM flagged WHERE error IS NULL")
def v1_silver_reviews(spark, sf_dir):
    f = _flagged_reviews(spark, sf_dir)
    return rounded(f.where("error IS NULL").select(*_REVIEW_COLS, _images()))


@register("v2_quarantine_reviews", _FLAGGED_SQL + "SELECT * FROM flagged WHERE error IS NOT NULL")
def v2_quarantine_reviews(spark, sf_dir):
    f = _flagged_reviews(spark, sf_dir)
    return rounded(f.where("error IS NOT NULL").select(*_REVIEW_COLS, _images(), "error"))


V3_SQL = """
SELECT DISTINCT d.doc_id AS key FROM documents d
WHERE d.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""


@register("v3_orphan_keys", V3_SQL)
def v3_orphan_keys(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    labels = roles.table(spark, sf_dir, "labels")
    return silver.orphan_keys(docs, labels, "doc_id", "doc_id")


_KD = f"WITH kd AS ({KEYED_DOCUMENTS_SQL}) "


@register("v4_silver_products", _KD + "SELECT * FROM kd WHERE asin IS NOT NULL AND asin <> ''")
def v4_silver_products(spark, sf_dir):
    valid, _ = silver.split_products(roles.keyed_documents(spark, sf_dir), asin="asin")
    return valid


@register("v5_quarantine_products",
          _KD + "SELECT *, 'missing_asin' AS error FROM kd WHERE asin IS NULL OR asin = ''")
def v5_quarantine_products(spark, sf_dir):
    _, invalid = silver.split_products(roles.keyed_documents(spark, sf_dir), asin="asin")
    return invalid


V6_SQL = f"""
WITH products AS ({PRODUCTS_SQL}),
     reviews AS ({reviews_sql(7)}),
     keys AS (SELECT DISTINCT p_partkey AS k FROM ({PRODUCT_KEYS_SQL})),
     pq AS (
       SELECT count(*) AS product_total_records,
              count(DISTINCT CASE WHEN asin IS NOT NULL AND asin <> '' THEN asin END) AS product_unique_asin,
              count(*) FILTER (WHERE asin IS NULL OR asin = '') AS product_missing_asin,
              count(*) FILTER (WHERE title IS NULL OR title = '') AS product_missing_title
       FROM products),
     rq AS (
       SELECT count(*) AS review_total_records,
              count(DISTINCT review_id) AS review_unique_review_id,
              count(DISTINCT reviewer_key) AS review_unique_reviewers,
              count(*) FILTER (WHERE rating IS NULL OR NOT (rating BETWEEN 1 AND 5)) AS review_invalid_rating,
              count(*) FILTER (WHERE k IS NULL) AS review_orphan_reviews,
              count(DISTINCT CASE WHEN k IS NULL THEN product_key END) AS review_orphan_asin_count,
              count(*) FILTER (WHERE NOT {sql_has_text('review_text')}) AS review_missing_review_text
       FROM reviews LEFT JOIN keys ON product_key = k)
SELECT product_total_records, product_unique_asin,
       product_total_records - product_unique_asin AS product_duplicate_asin_records,
       product_missing_asin, product_missing_title,
       round(coalesce((product_total_records - product_unique_asin) * 100.0 / nullif(product_total_records, 0), 0), 6)
           AS product_duplicate_percentage,
       rq.*,
       CASE WHEN product_missing_asin > 0 OR review_invalid_rating > 0 OR review_orphan_reviews > 0
            THEN 'WARN' ELSE 'PASS' END AS status
FROM pq, rq
"""


@register("v6_quality_report", V6_SQL)
def v6_quality_report(spark, sf_dir):
    products = roles.products(spark, sf_dir, with_description=False)
    reviews = roles.reviews(spark, sf_dir, rating_mod=7)
    keys = silver.product_key_set(roles.product_keys(spark, sf_dir), asin="p_partkey")
    pq = silver.product_quality(products, asin="asin", title="title")
    rq = silver.review_quality(reviews, keys, asin="product_key", review_id="review_id",
                               reviewer="reviewer_key", rating="rating", text="review_text")
    return rounded(silver.silver_status(pq, rq))
