"""Profiling of raw records and typed tables (AG4-AG12, AG19, F11).

Every profile is a single aggregation (partial on the map side, then one
small shuffle), so its cost grows linearly with the input and its state with
the number of distinct fields / types / keys, never with the row count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.frames import skew_join, with_one_row
from lakeloom.functions.text import normalize_text, strip
from lakeloom.functions.values import clean_value_string, field, is_empty, number_text, type_of_schema, value_type, variant_text


# Check names in report order, and the three statuses.
CHECKS = (
    "product_asin_uniqueness",
    "product_required_fields",
    "review_required_fields",
    "review_product_referential_integrity",
    "malformed_json",
)
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


def _pct(n: Column, d: Column, places: int | None) -> Column:
    v = F.coalesce(F.try_divide(n.cast("double") * 100.0, d), F.lit(0.0))
    return F.round(v, places) if places is not None else v


# ------------------------------------------------------------ field profile
def field_partial(records: DataFrame, record: str = "record") -> DataFrame:
    """(field, type, n, e): records and empty values per field and type of the
    VARIANT objects; the row without a field carries the record count. Partials
    of parts of the input add up to the partial of the whole. The input is parsed
    once."""
    # one entry without a name per record carries the record count in the same aggregation
    fields = F.map_entries(F.try_variant_get(F.col(record), "$", "map<string,variant>"))
    counter = F.array(F.lit(None).cast("struct<key:string,value:variant>"))
    entries = records.select(F.explode(F.concat(counter, F.coalesce(fields, F.array().cast("array<struct<key:string,value:variant>>")))).alias("f"))
    entries = entries.select(F.col("f.key").alias("field"), F.col("f.value").alias("v"))
    # schema, type and a string's text are columns: each test of the CASEs below would work them out again
    entries = entries.select("field", "v", F.schema_of_variant("v").alias("_sch"))
    entries = entries.select("*", type_of_schema("_sch").alias("_t"))
    entries = entries.select("*", F.when(F.col("_t") == "STRING", variant_text("v")).alias("_s"))
    v, sch, t = F.col("v"), F.col("_sch"), F.col("_t")
    typed = entries.select("field", value_type(v, sch, t).alias("type"), is_empty(v, t, sch, strip("_s")).alias("empty"))
    return typed.groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"), F.count_if("empty").alias("e"))


def fields_of(partials: DataFrame, required: Sequence[str] = (), places: int | None = 4) -> DataFrame:
    """The field profile of one or several partials (see ``field_profile``)."""
    by_type = partials.select("field", "type", "n", "e")
    if required:
        # names alone, with zero rows
        names = partials.sparkSession.createDataFrame([(f,) for f in required], "field string")
        by_type = by_type.unionByName(names.select("field", F.lit(None).cast("string").alias("type"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e")))
    by_type = by_type.groupBy("field", "type").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    by_field = by_type.groupBy("field").agg(
        F.sum("n").alias("present_records"),
        F.sum("e").alias("empty_records"),
        F.map_from_entries(F.collect_list(F.when(F.col("n") > 0, F.struct(F.coalesce("type", F.lit("")).alias("type"), "n")))).alias("types"),
    )
    # one row per field name is left here
    total = F.coalesce(F.max(F.when(F.col("field").isNull(), F.col("present_records"))).over(Window.partitionBy()), F.lit(0))
    by_field = by_field.withColumn("_total", total).where(F.col("field").isNotNull())
    present = F.coalesce(F.col("present_records"), F.lit(0)).cast("long")
    return (
        by_field.select(
            "field",
            present.alias("present_records"),
            (F.col("_total") - present).alias("missing_records"),
            F.coalesce(F.col("empty_records"), F.lit(0)).cast("long").alias("empty_records"),
            _pct(F.col("_total") - present, F.col("_total"), places).alias("missing_percentage"),
            _pct(F.coalesce(F.col("empty_records"), F.lit(0)), F.col("_total"), places).alias("empty_percentage"),
            F.coalesce(F.col("types"), F.create_map().cast("map<string,bigint>")).alias("types"),
        )
        .orderBy("field")
    )


def field_profile(
    records: DataFrame,
    record: str = "record",
    required: Sequence[str] = (),
    places: int | None = 4,
) -> DataFrame:
    """AG4 P12 P13: per top-level field of the VARIANT objects: present,
    missing, empty counts, percentages and a type histogram (map type ->
    count). Required fields that never occur are listed with zero presence
    (SO2). Sorted by field (T3)."""
    return fields_of(field_partial(records, record), required, places)


def required_violations(profile: DataFrame, required: Iterable[str]) -> DataFrame:
    """required fields with missing or empty records."""
    return profile.where(
        F.col("field").isin(list(required)) & ((F.col("missing_records") > 0) | (F.col("empty_records") > 0))
    ).select("field", F.col("missing_records").alias("missing"), F.col("empty_records").alias("empty"))


# ------------------------------------------------------- typed emptiness
def present(c: str, dtype: T.DataType) -> Column:
    """``not is_empty(value)`` for a typed column."""
    col = F.col(c)
    if isinstance(dtype, T.StringType):
        return F.coalesce(strip(col) != "", F.lit(False))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(col) > 0, F.lit(False))
    return col.isNotNull()


def availability(
    products: DataFrame,
    fields: Sequence[str] = ("description", "features", "brand", "price", "image_urls", "high_res_image_urls"),
    text_fields: Sequence[str] = ("title", "description", "features"),
    image_fields: Sequence[str] = ("image_urls", "high_res_image_urls"),
    places: int | None = 4,
) -> DataFrame:
    """AG6 AG7: per-field availability counts and multimodal readiness
    (text = any text field present; text and image = text and any image)."""
    types = {f.name: f.dataType for f in products.schema.fields}
    has = {c: present(c, types[c]) for c in set(fields) | set(text_fields) | set(image_fields)}
    text = F.lit(False)
    for c in text_fields:
        text = text | has[c]
    image = F.lit(False)
    for c in image_fields:
        image = image | has[c]
    agg = products.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(has[c]).alias(f"with_{c}") for c in fields],
        F.count_if(text).alias("with_text"),
        F.count_if(text & image).alias("with_text_and_image"),
    )
    return agg.select(
        "*",
        _pct(F.col("with_text"), F.col("records"), places).alias("text_percentage"),
        _pct(F.col("with_text_and_image"), F.col("records"), places).alias("text_and_image_percentage"),
    )


def text_partial(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., text_field, with_text, length): per text field, rows with non-blank
    text and the length of their whitespace-normalized texts; partials add up."""
    aggs = []
    for c in fields:
        n = normalize_text(c)
        ok = n != ""
        aggs += [F.count_if(ok).alias(f"with_{c}"), F.coalesce(F.sum(F.when(ok, F.length(n))), F.lit(0)).alias(f"len_{c}")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    each = F.array(*[F.struct(F.lit(c).alias("text_field"), F.col(f"with_{c}").alias("with_text"), F.col(f"len_{c}").cast("long").alias("length")) for c in fields])
    return g.select(*by, F.inline(each))


def texts_of(partials: DataFrame, fields: Sequence[str], by: Sequence[str] = (), places: int | None = 2) -> DataFrame:
    """The text lengths of one or several partials (see ``text_lengths``)."""
    aggs, cols = [], [F.col(b) for b in by]
    for c in fields:
        mine = F.col("text_field") == c
        aggs += [F.sum(F.when(mine, F.col(x)).otherwise(0)).alias(f"{x}_{c}") for x in ("with_text", "length")]
        avg = F.coalesce(F.try_divide(F.col(f"length_{c}").cast("double"), F.col(f"with_text_{c}")), F.lit(0.0))
        with_text = F.coalesce(F.col(f"with_text_{c}"), F.lit(0)).alias(f"with_{c}")
        cols += [with_text, (F.round(avg, places) if places is not None else avg).alias(f"avg_{c}_length")]
    g = partials.groupBy(*by).agg(*aggs) if by else partials.agg(*aggs)
    return g.select(*cols)


def text_lengths(df: DataFrame, fields: Sequence[str], by: Sequence[str] = (), places: int | None = 2) -> DataFrame:
    """AG8 AG9: per text field, rows with non-blank text and the average
    length of the whitespace-normalized text over those rows (0 if none)."""
    return texts_of(text_partial(df, fields, by), fields, by, places)


def histogram(df: DataFrame, c: str, python_bool: bool = True) -> DataFrame:
    """AG10 AG11: rows per value text (``str(value)``); NULL values skipped."""
    col = F.col(c)
    dtype = df.schema[c].dataType
    if isinstance(dtype, T.BooleanType) and python_bool:
        key = F.when(col, "True").otherwise("False")
    else:
        key = col.cast("string")
    return df.where(col.isNotNull()).groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("count"))


def raw_availability(
    records: DataFrame,
    text_fields: Sequence[str] = ("reviewText", "summary"),
    fields: Sequence[str] = ("style", "vote", "image"),
    record: str = "record",
    places: int | None = 2,
) -> DataFrame:
    """AG8: one row over VARIANT records: per text field, records with
    non-blank text and its average normalized length; per other field, records
    where the raw value is not empty (P12)."""
    names = [*text_fields, *fields]
    staged = records.select(*[field(record, c).alias(c) for c in names])
    texts = {c: normalize_text(clean_value_string(F.col(c))) for c in text_fields}
    staged = staged.select(*[texts.get(c, ~is_empty(F.col(c))).alias(c) for c in names])
    aggs = [F.count(F.lit(1)).alias("records")]
    for c in text_fields:
        aggs += [F.count_if(F.col(c) != "").alias(f"with_{c}"), F.sum(F.length(c)).alias(f"_len_{c}")]
    out = staged.agg(*aggs, *[F.count_if(c).alias(f"with_{c}") for c in fields])
    cols = ["records"]
    for c in text_fields:
        avg = F.coalesce(F.try_divide(F.col(f"_len_{c}").cast("double"), F.col(f"with_{c}")), F.lit(0.0))
        cols += [f"with_{c}", (F.round(avg, places) if places is not None else avg).alias(f"avg_{c}_length")]
    return out.select(*cols, *[f"with_{c}" for c in fields])


def raw_histogram(records: DataFrame, name: str, record: str = "record") -> DataFrame:
    """AG10: records per text of the raw value as Python prints it (``5.0``,
    ``4``, ``abc``); missing and null values are skipped."""
    v = records.select(field(record, name).alias("v")).where(F.col("v").isNotNull())
    text = number_text("v")
    return v.select(text.alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------- cardinality
def clean_key(c: str) -> Column:
    """A key as text without white space around it; blank keys are NULL."""
    s = strip(F.col(c).cast("string"))
    return F.when(s != "", s)


def cardinality(
    products: DataFrame,
    reviews: DataFrame,
    product_key: str,
    review_key: str,
    reviewer: str,
    key_set: DataFrame | None = None,
    places: int | None = 4,
    exact: bool = True,
) -> DataFrame:
    """AG5 AG12 P17: unique and duplicate product keys (a repeat counts once
    per extra row, blank keys ignored), unique review keys and reviewers,
    distinct orphan review keys and their share of the review keys. Orphans
    are judged against ``key_set`` (distinct product keys by default)."""
    distinct, clean = F.countDistinct if exact else F.approx_count_distinct, clean_key
    pk = products.select(clean(product_key).alias("k"))
    prod = pk.agg(distinct("k").alias("unique_asin"), (F.count("k") - distinct("k")).alias("duplicate_asin_records"))
    keys = key_set if key_set is not None else pk.where(F.col("k").isNotNull()).distinct()
    rk = reviews.select(clean(review_key).alias("k"), clean(reviewer).alias("r"))
    # distinct review keys meet the key set, never the review rows: a hot key is one row
    rkeys = rk.where(F.col("k").isNotNull()).select("k").distinct()
    flagged = skew_join(rkeys, keys.select(F.col("k").alias("_pk"), F.lit(True).alias("_known")), "k", "_pk")
    rev = flagged.agg(
        F.count("k").alias("unique_review_asins"),
        F.count_if(F.col("_known").isNull()).alias("orphan_asins"),
    )
    rev = with_one_row(rev, rk.agg(distinct("r").alias("unique_reviewers")))
    return with_one_row(prod, rev).select(
        "unique_asin", "duplicate_asin_records", "unique_review_asins", "unique_reviewers", "orphan_asins",
        _pct(F.col("orphan_asins"), F.col("unique_review_asins"), places).alias("orphan_asin_percentage"),
    )


# ---------------------------------------------------------------- checks
def checks(metrics: DataFrame) -> DataFrame:
    """AG19: the five checks as rows (check, status, value) plus the overall
    row (worst status). ``metrics`` is one row with duplicate_asin_records,
    product_required_violations, review_required_violations,
    orphan_asin_percentage, product_malformed and review_malformed."""
    values = [
        F.col("duplicate_asin_records"),
        F.col("product_required_violations"),
        F.col("review_required_violations"),
        F.col("orphan_asin_percentage"),
        F.col("product_malformed") + F.col("review_malformed"),
    ]
    m = metrics.select(*[v.cast("double").alias(name) for name, v in zip(CHECKS, values)])
    rows = m.unpivot([], m.columns, "check", "value")
    status = F.when(F.col("value") == 0, PASS).when(F.col("check") == CHECKS[-1], FAIL).otherwise(WARN)
    rows = rows.select("check", status.alias("status"), "value")
    severity = F.when(F.col("status") == FAIL, 2).when(F.col("status") == WARN, 1).otherwise(0)
    overall = rows.agg(F.max(severity).alias("s")).select(
        F.lit("overall").alias("check"),
        F.when(F.col("s") == 2, FAIL).when(F.col("s") == 1, WARN).otherwise(PASS).alias("status"),
        F.lit(None).cast("double").alias("value"),
    )
    return rows.unionByName(overall)


# What the report says of each check.
DESCRIPTIONS = {
    "product_asin_uniqueness": "Checks duplicate ASIN records in product metadata.",
    "product_required_fields": "Checks required product fields.",
    "review_required_fields": "Checks required review fields.",
    "review_product_referential_integrity": "Checks whether review ASINs exist in product metadata.",
    "malformed_json": "Checks malformed JSON records.",
}


def check_list(keys: DataFrame, product_violations: DataFrame, review_violations: DataFrame, malformed: DataFrame) -> DataFrame:
    """AG19 with what each check found: (check, status, description, details)
    and the overall row. ``details`` maps names to numbers: the violated fields
    with their missing and empty records, malformed lines of products and of
    reviews. ``keys`` and ``malformed`` are one row each (duplicate_asin_records,
    orphan_asin_percentage; products, reviews), violations are rows of
    ``required_violations``."""
    entry = "array<struct<key:string,value:double>>"

    def one(df, check, *columns):
        return df.select(F.lit(check).alias("check"), F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in columns]).cast(entry).alias("found"))

    def violated(df, check):
        each = F.array(*[F.struct(F.concat_ws(".", "field", F.lit(c)).alias("key"), F.col(c).cast("double").alias("value")) for c in ("missing", "empty")])
        return df.agg(F.flatten(F.collect_list(each)).cast(entry).alias("found")).select(F.lit(check).alias("check"), "found")

    rows = one(keys, CHECKS[0], "duplicate_asin_records")
    rows = rows.unionByName(violated(product_violations, CHECKS[1])).unionByName(violated(review_violations, CHECKS[2]))
    rows = rows.unionByName(one(keys, CHECKS[3], "orphan_asin_percentage")).unionByName(one(malformed, CHECKS[4], "products", "reviews"))
    bad = F.exists("found", lambda e: e["value"] > 0)
    status = F.when(~bad, PASS).when(F.col("check") == CHECKS[-1], FAIL).otherwise(WARN)
    text = F.lit(None).cast("string")
    for check, description in DESCRIPTIONS.items():
        text = F.when(F.col("check") == check, F.lit(description)).otherwise(text)
    rows = rows.select("check", status.alias("status"), text.alias("description"), F.map_from_entries("found").alias("details"))
    severity = F.when(F.col("status") == FAIL, 2).when(F.col("status") == WARN, 1).otherwise(0)
    worst = rows.agg(F.max(severity).alias("s"))
    overall = worst.select(
        F.lit("overall").alias("check"), F.when(F.col("s") == 2, FAIL).when(F.col("s") == 1, WARN).otherwise(PASS).alias("status"),
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("map<string,double>").alias("details"))
    return rows.unionByName(overall)
