"""r*: canonical products, entity mapping, review linking, duplicate diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.text import normalize_lower
from lakeloom.functions.values import sha256_hex
from lakeloom.operators import resolve
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.roles import PRODUCT_KEYS_SQL, PRODUCTS_SQL, reviews_sql, sql_normalize

_PCOLS = ["product_key", "asin", "title", "brand", "main_category", "price"]

R1_SQL = f"""
WITH products AS ({PRODUCTS_SQL})
SELECT product_key, asin, title, brand, main_category, round(price, 6) AS price
FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY product_key) AS rn FROM products)
WHERE rn = 1
"""


@register("r1_canonical_products", R1_SQL)
def r1_canonical_products(spark, sf_dir):
    p = roles.products(spark, sf_dir, with_description=False).select(*_PCOLS)
    return rounded(resolve.canonical_products(p, key="asin", order_by="product_key"))


R2_SQL = """
SELECT p_partkey AS source_product_id, p_name AS asin,
       min(p_partkey) OVER (PARTITION BY p_name) AS canonical_product_id,
       CASE WHEN p_partkey = min(p_partkey) OVER (PARTITION BY p_name) THEN 'canonical'
            ELSE 'exact_asin_duplicate' END AS match_type,
       1.0::DOUBLE AS confidence_score, 'resolved' AS resolution_status
FROM part
"""


@register("r2_entity_mapping", R2_SQL)
def r2_entity_mapping(spark, sf_dir):
    p = roles.products(spark, sf_dir, with_description=False)
    return resolve.entity_mapping(p, key="asin", product_id="product_key", order_by="product_key")


@register("r9_missing_keys", """
WITH k AS (SELECT doc_id, CASE WHEN lang IN ('de', 'es') THEN NULL ELSE 'D' || (doc_id // 2) END AS asin FROM documents),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY asin) AS first FROM k)
SELECT doc_id AS source_product_id, asin, CASE WHEN asin IS NOT NULL THEN first END AS canonical_product_id,
       CASE WHEN asin IS NULL THEN 'missing_key' WHEN doc_id = first THEN 'canonical' ELSE 'exact_asin_duplicate' END AS match_type,
       CASE WHEN asin IS NULL THEN 0.0::DOUBLE ELSE 1.0 END AS confidence_score,
       CASE WHEN asin IS NULL THEN 'unresolved' ELSE 'resolved' END AS resolution_status FROM f""")
def r9_missing_keys(spark, sf_dir):
    """NULL and blank keys come back as unresolved rows."""
    d = roles.keyed_documents(spark, sf_dir)
    key = F.when(F.col("asin").isin("", " \t") | F.col("asin").isNull(), F.when(F.col("asin") == "", " \t")).otherwise(
        F.concat(F.lit("D"), F.floor(F.col("doc_id") / 2).cast("string")))
    return resolve.entity_mapping(d.withColumn("asin", key), product_id="doc_id", order_by="doc_id", on_missing="unresolved")


_LINK_SQL = f"""
WITH m AS (SELECT p_partkey AS source_product_id,
                  min(p_partkey) OVER (PARTITION BY p_name) AS canonical_product_id
           FROM ({PRODUCT_KEYS_SQL})),
     linked AS (SELECT r.* EXCLUDE (image_urls), array_to_string(image_urls, '|') AS image_urls, canonical_product_id
                FROM ({reviews_sql()}) r LEFT JOIN m ON product_key = source_product_id)
"""


def _linked(spark, sf_dir):
    parts = roles.product_keys(spark, sf_dir)
    mapping = resolve.entity_mapping(parts, key="p_name", product_id="p_partkey", order_by="p_partkey")
    # whole rows; the list column is rendered as text
    reviews = roles.reviews(spark, sf_dir).withColumn("image_urls", F.array_join("image_urls", "|"))
    return resolve.attach_canonical(reviews, mapping, review_key="product_key", mapping_key="source_product_id")


@register("r3_resolved_reviews", _LINK_SQL + "SELECT * FROM linked WHERE canonical_product_id IS NOT NULL")
def r3_resolved_reviews(spark, sf_dir):
    return resolve.split_resolved(_linked(spark, sf_dir))[0]


@register("r4_unresolved_reviews", _LINK_SQL + "SELECT * FROM linked WHERE canonical_product_id IS NULL")
def r4_unresolved_reviews(spark, sf_dir):
    return resolve.split_resolved(_linked(spark, sf_dir))[1]


R5_SQL = """
SELECT sha256(text) AS text_sha256, count(*) AS dup_count, min(doc_id) AS first_doc_id
FROM documents GROUP BY text HAVING count(*) >= 2
"""


@register("r5_duplicate_groups", R5_SQL)
def r5_duplicate_groups(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    # group on the digest of the whole text: the shuffle carries 64 characters
    # per group instead of the text itself
    g = docs.groupBy(sha256_hex("text").alias("text_sha256")).agg(
        F.count(F.lit(1)).alias("dup_count"), F.min("doc_id").alias("first_doc_id"))
    return g.where(F.col("dup_count") >= 2)


def _sql_eq_text(a: str, b: str) -> str:
    return f"lower({sql_normalize(a)}) = lower({sql_normalize(b)})"


R6_SQL = f"""
WITH d AS (SELECT doc_id, text, lang, source, n_chars, lower({sql_normalize('text')}) AS k FROM documents),
     g AS (SELECT k, count(*) AS n,
                  arg_min(text, doc_id) AS a_text, arg_max(text, doc_id) AS b_text,
                  arg_min(lang, doc_id) AS a_lang, arg_max(lang, doc_id) AS b_lang,
                  arg_min(source, doc_id) AS a_source, arg_max(source, doc_id) AS b_source,
                  arg_min(n_chars, doc_id) AS a_n, arg_max(n_chars, doc_id) AS b_n
           FROM d GROUP BY k),
     c AS (SELECT n, a_text IS NOT DISTINCT FROM b_text AS s_text,
                  {_sql_eq_text('a_lang', 'b_lang')} AS s_lang,
                  {_sql_eq_text('a_source', 'b_source')} AS s_source,
                  a_n IS NOT DISTINCT FROM b_n AS s_n FROM g)
SELECT count(*) FILTER (WHERE n = 2) AS total_groups,
       count(*) FILTER (WHERE n > 2) AS skipped_groups,
       count(*) FILTER (WHERE n = 2 AND s_text AND s_lang AND s_source AND s_n) AS exact_duplicates,
       count(*) FILTER (WHERE n = 2 AND NOT s_text) AS text_differences,
       count(*) FILTER (WHERE n = 2 AND NOT s_lang) AS lang_differences,
       count(*) FILTER (WHERE n = 2 AND NOT s_source) AS source_differences,
       count(*) FILTER (WHERE n = 2 AND NOT s_n) AS n_chars_differences
FROM c
"""


@register("r6_duplicate_diagnosis", R6_SQL)
def r6_duplicate_diagnosis(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    key = sha256_hex(normalize_lower("text"))
    return resolve.diagnose_duplicates(
        docs, key, order_by="doc_id",
        compare={"text": "value", "lang": "text", "source": "text", "n_chars": "value"})


R7_SQL = """
SELECT count(*) AS input_products, count(DISTINCT p_name) AS canonical_products,
       count(*) - count(DISTINCT p_name) AS duplicates_removed,
       round((count(*) - count(DISTINCT p_name)) * 100.0 / count(*), 6) AS duplicate_percentage
FROM part
"""


@register("r7_resolution_totals", R7_SQL)
def r7_resolution_totals(spark, sf_dir):
    return rounded(resolve.resolution_totals(roles.table(spark, sf_dir, "part"), key="p_name"))


R8_SQL = _LINK_SQL + """
SELECT count(canonical_product_id) AS resolved_reviews,
       count(*) - count(canonical_product_id) AS unresolved_reviews,
       round(count(canonical_product_id) * 100.0 / count(*), 6) AS resolution_rate
FROM linked
"""


@register("r8_review_resolution_totals", R8_SQL)
def r8_review_resolution_totals(spark, sf_dir):
    return rounded(resolve.review_resolution_totals(_linked(spark, sf_dir)))


T1_SQL = """
SELECT sha256(text) AS text_sha256, count(*) AS dup_count, min(doc_id) AS first_doc_id
FROM documents GROUP BY text HAVING count(*) >= 2 ORDER BY first_doc_id LIMIT 10
"""


@register("t1_limit_examples", T1_SQL)
def t1_limit_examples(spark, sf_dir):
    """The first ten duplicate groups (by first document id)."""
    return r5_duplicate_groups(spark, sf_dir).orderBy("first_doc_id").limit(10)
