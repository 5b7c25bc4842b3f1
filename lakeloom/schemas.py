"""Fixed table schemas of the canonical and derived layers."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
SA = T.ArrayType(T.StringType())
FA = T.ArrayType(T.FloatType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRODUCTS = _struct(
    ("product_id", S), ("asin", S), ("title", S), ("brand", S), ("category", S), ("main_category", S),
    ("description", S), ("features", SA), ("price", D), ("image_urls", SA), ("high_res_image_urls", SA),
    ("also_buy", SA), ("also_view", SA), ("similar_items", SA), ("product_date", S), ("raw_source", S),
    ("schema_version", S),
)
REVIEWS = _struct(
    ("review_id", S), ("product_id", S), ("asin", S), ("reviewer_id", S), ("reviewer_name", S), ("rating", D),
    ("verified", B), ("review_text", S), ("summary", S), ("review_time", S), ("review_timestamp", L),
    ("vote", L), ("image_urls", SA), ("style", S), ("raw_source", S), ("schema_version", S),
)
ENTITY_MAPPING = _struct(
    ("source_product_id", S), ("asin", S), ("canonical_product_id", S), ("match_type", S),
    ("confidence_score", D), ("resolution_status", S),
)
PRODUCT_SUMMARY = _struct(
    ("canonical_product_id", S), ("asin", S), ("title", S), ("brand", S), ("main_category", S), ("price", D),
    ("has_description", B), ("has_image", B),
)
PRODUCT_REVIEW_STATS = _struct(
    ("canonical_product_id", S), ("review_count", L), ("avg_rating", D), ("verified_review_count", L),
    ("verified_review_ratio", D), ("review_with_text_count", L), ("review_with_image_count", L),
    ("avg_review_length", D),
)
REVIEWER_STATS = _struct(
    ("reviewer_id", S), ("review_count", L), ("avg_rating", D), ("verified_review_count", L),
    ("avg_review_length", D),
)
MULTIMODAL_PRODUCTS = _struct(
    ("canonical_product_id", S), ("asin", S), ("title", S), ("brand", S), ("main_category", S), ("price", D),
    ("text_content", S), ("image_urls", SA), ("has_text", B), ("has_image", B),
)
TEXT_EMBEDDINGS = _struct(
    ("canonical_product_id", S), ("asin", S), ("embedding_model", S), ("embedding_dimension", I),
    ("embedding", FA),
)
IMAGE_EMBEDDINGS = _struct(
    ("canonical_product_id", S), ("asin", S), ("image_url", S), ("embedding_model", S),
    ("embedding_dimension", I), ("embedding", FA),
)
VECTOR_POINTS = _struct(("point_id", L), ("embedding", FA), ("canonical_product_id", S), ("asin", S))

PRODUCT_COLUMNS = PRODUCTS.fieldNames()
REVIEW_COLUMNS = REVIEWS.fieldNames()
