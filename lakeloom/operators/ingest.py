"""Normalization of raw records into canonical products and reviews.

``normalize_products`` / ``normalize_reviews`` take the object rows of
``sources.raw.parse_records`` (a VARIANT ``record`` column) and return the
canonical columns plus ``error`` (NULL for valid rows). The checks run in the
reference's order inside one CASE, so the first failing rule names the row.
``split_valid`` turns that into the canonical table and the quarantine table
(error, raw record).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.frames import boundary
from lakeloom.functions.text import clean_string
from lakeloom.functions.values import (
    clean_list,
    clean_number,
    clean_parts,
    clean_value_string,
    falsy_text,
    json_number,
    json_text,
    json_type,
    list_parts,
    number_text,
    parse_timestamp,
    parse_vote,
    product_id_from_key,
    review_id_from_parts,
    style_json,
)
from lakeloom.schemas import PRODUCT_COLUMNS, REVIEW_COLUMNS

SCHEMA_VERSION = "v1"
# Source labels stored with every canonical row.
PRODUCT_SOURCE = "amazon_electronics_metadata"
REVIEW_SOURCE = "amazon_electronics_reviews"
# Error codes, in the order the checks run.
MISSING_ASIN = "missing_asin"
MISSING_REVIEWER_ID = "missing_reviewer_id"
MISSING_REVIEW_TIMESTAMP = "missing_review_timestamp"
INVALID_REVIEW_TIMESTAMP = "invalid_review_timestamp"
MISSING_RATING = "missing_rating"
INVALID_RATING = "invalid_rating"
# Separators used when a list field is stored as one text (K9).
CATEGORY_SEP = " > "
DESCRIPTION_SEP = "\n"


def _fields(records: DataFrame, record: str, names, keep, typed) -> DataFrame:
    """Project the raw fields into their own VARIANT columns, with one
    navigation of the object (a cast to a struct of variants), with their JSON text,
    written once, plus a type tag for each ``typed`` field. Later expressions refer to these
    columns, which keeps the generated code small and evaluates each extraction once."""
    struct = "struct<" + ",".join(f"`{n}`: variant" for n in names) + ">"
    staged = records.select(*keep, F.variant_get(F.col(record), "$", struct).alias("_fields"))
    staged = staged.select(*keep, *[F.col("_fields").getField(n).alias(f"_v_{n}") for n in names])
    staged = boundary(staged.select("*", *[F.to_json(_v(n)).alias(f"_j_{n}") for n in names]))
    staged = staged.select("*", *[F.ascii(_j(n)).alias(f"_b_{n}") for n in typed])
    staged = staged.select("*", *[json_type(_v(n), _j(n), f"_b_{n}").alias(f"_t_{n}") for n in typed])
    return boundary(staged.drop(*[f"_b_{n}" for n in typed]))


def _v(name: str) -> F.Column:
    return F.col(f"_v_{name}")


def _j(name: str) -> F.Column:
    return F.col(f"_j_{name}")


def _t(name: str) -> F.Column:
    return F.col(f"_t_{name}")


def _texts(staged: DataFrame, names) -> DataFrame:
    """``_s_<field>`` instead of ``_v_<field>``: the cleaned text of the raw value,
    which is read from its JSON text once (``clean_string`` reads it several times).
    Each boundary ends a method of the code Spark generates: one of over 8,000
    bytes of bytecode is never compiled by the JVM."""
    texts = staged.select("*", *[json_text(_v(n), _j(n)).alias(f"_s_{n}") for n in names])
    texts = boundary(texts.drop(*[f"_{x}_{n}" for n in names for x in "vj"]))
    return boundary(texts.withColumns({f"_s_{n}": clean_string(f"_s_{n}") for n in names}))


def _read(staged: DataFrame, *names: str) -> DataFrame:
    """The end of a step: ``staged`` without the raw fields that were read."""
    return boundary(staged.drop(*[f"_{x}_{n}" for n in names for x in "vjt"]))


def _s(name: str) -> F.Column:
    return F.col(f"_s_{name}")


PRODUCT_FIELDS = ("asin", "title", "brand", "category", "main_cat", "description", "feature", "price",
                  "imageURL", "imageURLHighRes", "also_buy", "also_view", "similar_item", "date")
#: Fields that are texts whatever their JSON type, and those cleaned by type.
PRODUCT_TEXTS = ("asin", "title", "brand", "main_cat", "date")
PRODUCT_TYPED = tuple(n for n in PRODUCT_FIELDS if n not in PRODUCT_TEXTS)
REVIEW_FIELDS = ("asin", "reviewerID", "unixReviewTime", "overall", "reviewText", "summary", "reviewerName",
                 "verified", "reviewTime", "vote", "image", "style")
REVIEW_TEXTS = ("asin", "reviewerID", "reviewText", "summary", "reviewerName", "reviewTime")
REVIEW_TYPED = tuple(n for n in REVIEW_FIELDS if n not in REVIEW_TEXTS)


def normalize_products(records: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """P1-P5 P10 F1. ``keep`` names extra input columns to carry (ids, raw line)."""
    staged = _texts(_fields(records, record, PRODUCT_FIELDS, keep, PRODUCT_TYPED), PRODUCT_TEXTS)
    asin = _s("asin")
    cols = {
        "product_id": product_id_from_key(asin),
        "asin": asin,
        "title": _s("title"),
        "brand": _s("brand"),
        "category": clean_value_string(_v("category"), CATEGORY_SEP, _t("category")),
        "main_category": _s("main_cat"),
        "description": clean_value_string(_v("description"), DESCRIPTION_SEP, _t("description")),
        "features": clean_list(_v("feature"), _t("feature")),
        "price": clean_number(_v("price"), _t("price"), _j("price")),
        "image_urls": clean_list(_v("imageURL"), _t("imageURL")),
        "high_res_image_urls": clean_list(_v("imageURLHighRes"), _t("imageURLHighRes")),
        "also_buy": clean_list(_v("also_buy"), _t("also_buy")),
        "also_view": clean_list(_v("also_view"), _t("also_view")),
        "similar_items": clean_list(_v("similar_item"), _t("similar_item")),
        "product_date": _s("date"),
        "raw_source": F.lit(PRODUCT_SOURCE),
        "schema_version": F.lit(SCHEMA_VERSION),
    }
    assert list(cols) == PRODUCT_COLUMNS
    error = F.when(asin.isNull(), F.lit(MISSING_ASIN))
    return boundary(staged.select(*keep, *[c.alias(n) for n, c in cols.items()], error.alias("error")))


def normalize_reviews(
    records: DataFrame,
    record: str = "record",
    keep: tuple[str, ...] = (),
    min_rating: float = 0.0,
    max_rating: float = 5.0,
) -> DataFrame:
    """P6-P9 P11 F2. Errors in order: missing_asin, missing_reviewer_id,
    missing_review_timestamp, invalid_review_timestamp, missing_rating,
    invalid_rating (outside [min_rating, max_rating], NaN included)."""
    staged = _texts(_fields(records, record, REVIEW_FIELDS, keep, REVIEW_TYPED), REVIEW_TEXTS)
    # step by step, each within the size that the JVM compiles; a field's VARIANT goes when it was read
    v, t, j = _v("unixReviewTime"), _t("unixReviewTime"), _j("unixReviewTime")
    seconds, _ = parse_timestamp(v, t, j)
    n_time = F.when(~t.isin("STRING", "VOID"), json_number(v, j))
    staged = boundary(staged.select("*", seconds.alias("_seconds"), n_time.alias("_n_time"), (v.isNull() | (t == "VOID")).alias("_no_time")))
    staged = staged.select("*", number_text(v, t, F.col("_n_time"), j).alias("_time_text"))
    staged = _read(staged.select("*", falsy_text(v, "_time_text", t, F.col("_n_time"), j).alias("_time_key")), "unixReviewTime")
    elems, one = list_parts(_v("image"), _t("image"), _j("image"))
    staged = staged.select(
        "*",
        elems.alias("_elems"),
        one.alias("_one"),
        F.when(_t("verified") == "BOOLEAN", _j("verified") == "true").alias("_verified"),
        parse_vote(_v("vote"), _t("vote"), _j("vote")).alias("_votes"),
        style_json(_v("style"), _t("style"), _j("style")).alias("_styles"),
    )
    staged = _read(staged, "image", "verified", "vote", "style")
    v, t, j = _v("overall"), _t("overall"), _j("overall")
    staged = boundary(staged.select("*", clean_number(v, t, j).alias("_rating")))
    staged = staged.select("*", number_text(v, t, F.col("_rating"), j).alias("_rating_text"))
    staged = _read(staged.select("*", falsy_text(v, "_rating_text", t, F.col("_rating"), j).alias("_rating_key")), "overall")
    asin, reviewer, rating = _s("asin"), _s("reviewerID"), F.col("_rating")
    error = (
        F.when(asin.isNull(), F.lit(MISSING_ASIN))
        .when(reviewer.isNull(), F.lit(MISSING_REVIEWER_ID))
        .when(F.col("_no_time"), F.lit(MISSING_REVIEW_TIMESTAMP))
        .when(F.col("_seconds").isNull(), F.lit(INVALID_REVIEW_TIMESTAMP))
        .when(rating.isNull(), F.lit(MISSING_RATING))
        .when(F.isnan(rating) | ~rating.between(min_rating, max_rating), F.lit(INVALID_RATING))
    )
    cols = {
        "review_id": review_id_from_parts(reviewer, asin, F.col("_time_key"), F.col("_rating_key"), _s("reviewText"), _s("summary")),
        "product_id": product_id_from_key(asin),
        "asin": asin,
        "reviewer_id": reviewer,
        "reviewer_name": _s("reviewerName"),
        "rating": rating,
        "verified": F.col("_verified"),
        "review_text": _s("reviewText"),
        "summary": _s("summary"),
        "review_time": _s("reviewTime"),
        "review_timestamp": F.col("_seconds"),
        "vote": F.col("_votes"),
        "image_urls": F.col("_elems"),
        "style": F.col("_styles"),
        "raw_source": F.lit(REVIEW_SOURCE),
        "schema_version": F.lit(SCHEMA_VERSION),
    }
    assert list(cols) == REVIEW_COLUMNS
    out = boundary(staged.select(*keep, *[c.alias(n) for n, c in cols.items()], "_one", error.alias("error")))
    # a lambda is no part of a generated stage: it comes last, so that no VARIANT is copied into a row between two stages
    return out.withColumn("image_urls", clean_parts("image_urls", "_one")).drop("_one")


def split_valid(normalized: DataFrame, raw: str = "line") -> tuple[DataFrame, DataFrame]:
    """(canonical rows, quarantine rows with error and raw record)."""
    valid = normalized.where(F.col("error").isNull()).drop("error")
    invalid = normalized.where(F.col("error").isNotNull()).select("error", F.col(raw).alias("record"))
    return valid, invalid


def ingest(lines: DataFrame, entity: str, line: str = "line") -> DataFrame:
    """S1 + P10/P11 in one plan: every non-blank line comes out once, either
    canonical (error NULL) or with an error code (parse errors included)."""
    from lakeloom.sources.raw import parse_records

    parsed = parse_records(lines, line)
    keep = tuple(c for c in lines.columns) + ("parse_error",)
    norm = normalize_products if entity == "products" else normalize_reviews
    out = norm(parsed, keep=keep)
    return out.withColumn("error", F.coalesce(F.col("parse_error"), F.col("error"))).drop("parse_error")
