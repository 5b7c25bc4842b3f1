"""p*: field profile of rendered JSON, availability, text lengths,
histograms, cardinality and the check list."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lakeloom.frames import with_one_row
from lakeloom.operators import profile, profile_store
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.jsontext import kv, obj, q, s
from lakeloom.plans.q_ingest import _EVENT_LINES_SQL, _event_lines, _review_lines
from lakeloom.plans.roles import PRODUCTS_SQL, reviews_sql, sql_normalize, sql_strip
from lakeloom.session import checkpoint_dir
from lakeloom.sources.raw import parse_records, spread

c, lit = F.col, F.lit


# ------------------------------------------------------------------ p1
def _doc_records(spark, sf_dir):
    d = roles.table(spark, sf_dir, "documents")
    lab = roles.table(spark, sf_dir, "labels").select(c("doc_id").alias("l_doc"), "quality", "toxic")
    j = d.join(lab, d.doc_id == lab.l_doc, "left")
    i = c("doc_id")
    labeled = c("l_doc").isNotNull()
    line = obj(
        kv("doc_id", s("doc_id")),
        kv("lang", F.when(c("lang") == "es", lit('""')).otherwise(q(c("lang")))),
        kv("source", q(c("source"))),
        kv("n_chars", F.when(i % 7 == 0, q(s("n_chars"))).otherwise(s("n_chars"))),
        F.when(labeled, kv("quality", s("quality"))),
        kv("toxic", F.when(labeled, s("toxic")).otherwise(lit("null"))),
        F.when(i % 3 == 0, kv("tags", lit("[]"))).when(i % 3 == 1, kv("tags", F.concat(lit("["), q(c("lang")), lit("]")))),
        F.when(i % 4 == 0, kv("meta", lit("{}"))).when(i % 4 == 1, kv("meta", lit('{"a":1}')))
        .when(i % 4 == 2, kv("meta", lit("true"))),
        F.when(i % 5 == 0, kv("score", F.concat(s("n_chars"), lit(".5")))),
    )
    return parse_records(spread(j.select(line.alias("line"))))


P1_SQL = f"""
WITH d AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.doc_id IS NOT NULL AS labeled
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
rec AS (
  SELECT '{{' || concat_ws(',',
      '"doc_id":' || doc_id,
      '"lang":' || CASE WHEN lang = 'es' THEN '""' ELSE '"' || lang || '"' END,
      '"source":"' || source || '"',
      '"n_chars":' || CASE WHEN doc_id % 7 = 0 THEN '"' || n_chars || '"' ELSE CAST(n_chars AS VARCHAR) END,
      CASE WHEN labeled THEN '"quality":' || quality END,
      '"toxic":' || CASE WHEN labeled THEN CAST(toxic AS VARCHAR) ELSE 'null' END,
      CASE doc_id % 3 WHEN 0 THEN '"tags":[]' WHEN 1 THEN '"tags":["' || lang || '"]' END,
      CASE doc_id % 4 WHEN 0 THEN '"meta":{{}}' WHEN 1 THEN '"meta":{{"a":1}}' WHEN 2 THEN '"meta":true' END,
      CASE WHEN doc_id % 5 = 0 THEN '"score":' || n_chars || '.5' END) || '}}' AS line
  FROM d),
kv AS (SELECT line, unnest(json_keys(line)) AS k FROM rec),
t AS (SELECT k, json_type(line, '$.' || k) AS jt, json_extract(line, '$.' || k) AS jv FROM kv),
typed AS (
  SELECT k AS field,
         CASE jt WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' WHEN 'DOUBLE' THEN 'float'
                 WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'null'
                 WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' END AS type,
         jt = 'NULL'
           OR (jt = 'VARCHAR' AND {sql_strip("json_extract_string(jv, '$')")} = '')
           OR (jt = 'ARRAY' AND json_array_length(jv) = 0)
           OR (jt = 'OBJECT' AND len(json_keys(jv)) = 0) AS empty
  FROM t),
by_type AS (SELECT field, type, count(*) AS n, count(*) FILTER (WHERE empty) AS e FROM typed GROUP BY 1, 2),
by_field AS (SELECT field, sum(n) AS p, sum(e) AS e, string_agg(type || ':' || n, ',' ORDER BY type) AS types
             FROM by_type GROUP BY 1),
names AS (SELECT field FROM by_field UNION SELECT 'doc_id' UNION SELECT 'title'),
total AS (SELECT count(*) AS total FROM rec)
SELECT names.field, CAST(coalesce(p, 0) AS BIGINT) AS present_records,
       CAST(total - coalesce(p, 0) AS BIGINT) AS missing_records, CAST(coalesce(e, 0) AS BIGINT) AS empty_records,
       round((total - coalesce(p, 0)) * 100.0 / total, 6) AS missing_percentage,
       round(coalesce(e, 0) * 100.0 / total, 6) AS empty_percentage,
       coalesce(types, '') AS types
FROM names LEFT JOIN by_field USING (field), total
"""


def _types_text(m):
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], lit(":"), e["value"].cast("string"))), ",")


@register("p1_field_profile", P1_SQL)
def p1_field_profile(spark, sf_dir):
    recs = _doc_records(spark, sf_dir).where("parse_error IS NULL")
    prof = profile.field_profile(recs, required=("doc_id", "title"), places=None)
    return rounded(prof.withColumn("types", _types_text(c("types"))))


# ------------------------------------------------------------------ p2
def _has(expr, kind):
    if kind == "text":
        return f"coalesce({sql_strip(expr)} <> '', FALSE)"
    if kind == "list":
        return f"coalesce(len({expr}) > 0, FALSE)"
    return f"{expr} IS NOT NULL"


_TXT = f"({_has('title', 'text')} OR {_has('description', 'text')} OR {_has('features', 'list')})"
_IMG = f"({_has('image_urls', 'list')} OR {_has('high_res_image_urls', 'list')})"
P2_SQL = f"""
WITH products AS ({PRODUCTS_SQL})
SELECT count(*) AS records,
       count(*) FILTER (WHERE {_has('description', 'text')}) AS with_description,
       count(*) FILTER (WHERE {_has('features', 'list')}) AS with_features,
       count(*) FILTER (WHERE {_has('brand', 'text')}) AS with_brand,
       count(*) FILTER (WHERE {_has('price', 'num')}) AS with_price,
       count(*) FILTER (WHERE {_has('image_urls', 'list')}) AS with_image_urls,
       count(*) FILTER (WHERE {_has('high_res_image_urls', 'list')}) AS with_high_res_image_urls,
       count(*) FILTER (WHERE {_TXT}) AS with_text,
       count(*) FILTER (WHERE {_TXT} AND {_IMG}) AS with_text_and_image,
       round(count(*) FILTER (WHERE {_TXT}) * 100.0 / count(*), 6) AS text_percentage,
       round(count(*) FILTER (WHERE {_TXT} AND {_IMG}) * 100.0 / count(*), 6) AS text_and_image_percentage
FROM products
"""


@register("p2_availability", P2_SQL)
def p2_availability(spark, sf_dir):
    return rounded(profile.availability(roles.products(spark, sf_dir), places=None))


# ------------------------------------------------------------------ p3
_N = sql_normalize("text")
P3_SQL = f"""
SELECT lang, count(*) FILTER (WHERE {_N} <> '') AS with_text,
       round(coalesce(sum(length({_N})) FILTER (WHERE {_N} <> '') / nullif(count(*) FILTER (WHERE {_N} <> ''), 0), 0), 6)
           AS avg_text_length
FROM documents GROUP BY lang
"""


@register("p3_text_lengths", P3_SQL)
def p3_text_lengths(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    return rounded(profile.text_lengths(docs, ["text"], by=["lang"], places=None))


# ------------------------------------------------------------- p4 / p5
@register("p4_rating_histogram", f"""
WITH reviews AS ({reviews_sql()})
SELECT CAST(rating AS VARCHAR) AS value, count(*) AS count FROM reviews WHERE rating IS NOT NULL GROUP BY 1""")
def p4_rating_histogram(spark, sf_dir):
    return profile.histogram(roles.reviews(spark, sf_dir), "rating")


@register("p5_flag_histogram", f"""
WITH reviews AS ({reviews_sql()})
SELECT CASE WHEN verified THEN 'True' ELSE 'False' END AS value, count(*) AS count
FROM reviews WHERE verified IS NOT NULL GROUP BY 1""")
def p5_flag_histogram(spark, sf_dir):
    return profile.histogram(roles.reviews(spark, sf_dir), "verified")


# ------------------------------------------------------------------ p6
_CARD_SQL = """
prod AS (SELECT count(DISTINCT p_name) AS unique_asin, count(p_name) - count(DISTINCT p_name) AS duplicate_asin_records
         FROM part),
rev AS (SELECT count(DISTINCT l_partkey) AS unique_review_asins, count(DISTINCT l_suppkey) AS unique_reviewers,
               count(DISTINCT CASE WHEN k IS NULL THEN l_partkey END) AS orphan_asins
        FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_partkey % 10 <> 0) ON l_partkey = k),
card AS (SELECT unique_asin, duplicate_asin_records, unique_review_asins, unique_reviewers, orphan_asins,
                round(orphan_asins * 100.0 / unique_review_asins, 6) AS orphan_asin_percentage FROM prod, rev)
"""


def _cardinality(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part")
    keys = roles.product_keys(spark, sf_dir).select(c("p_partkey").cast("string").alias("k")).distinct()
    return profile.cardinality(part, roles.reviews(spark, sf_dir), "p_name", "product_key", "reviewer_key",
                               key_set=keys, places=None)


@register("p6_cardinality_integrity", "WITH " + _CARD_SQL + "SELECT * FROM card")
def p6_cardinality_integrity(spark, sf_dir):
    return rounded(_cardinality(spark, sf_dir))


# ------------------------------------------------------------------ p7
def _violations(df, fields):
    types = {f.name: f.dataType for f in df.schema.fields}
    return sum((F.count_if(~profile.present(f, types[f])) > 0).cast("long") for f in fields)


def _review_lines_sql() -> str:
    """The raw review lines of i4/i5, rendered by DuckDB."""
    return """
    SELECT '{' || concat_ws(',',
      CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE '"reviewerID":"R' || l_suppkey || '"' END,
      CASE WHEN l_orderkey % 89 = 0 THEN '"asin":"   "' ELSE '"asin":"A' || l_partkey || '"' END,
      CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 79 = 0 THEN '"unixReviewTime":"x"'
           ELSE '"unixReviewTime":' || CAST(floor(epoch(l_shipdate)) AS BIGINT) END,
      CASE WHEN l_orderkey % 73 = 0 THEN '"overall":"abc"' WHEN l_orderkey % 71 = 0 THEN '"overall":-1'
           WHEN l_orderkey % 67 = 0 THEN '"overall":5.5' WHEN l_quantity > 45 THEN '"overall":"4"'
           ELSE '"overall":' || CAST(floor(l_quantity) % 6 AS BIGINT) || '.0' END,
      '"verified":' || CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END,
      CASE WHEN l_linenumber % 3 = 0 THEN '"reviewText":"  "' ELSE '"reviewText":"' || repeat('x', l_linenumber) || '"' END,
      '"summary":" S' || l_linenumber || ' "',
      CASE l_linenumber WHEN 1 THEN '"vote":"1,234"' WHEN 2 THEN '"vote":""' WHEN 3 THEN '"vote":"x"'
           WHEN 4 THEN '"vote":3' WHEN 5 THEN '"vote":3.5' END,
      CASE l_orderkey % 4 WHEN 0 THEN '"style":{}' WHEN 1 THEN '"style":{"b":1,"a":"' || l_returnflag || '"}'
           WHEN 2 THEN '"style":"s"' END,
      CASE WHEN l_orderkey % 5 = 0 THEN '"image":["u' || l_partkey || '","  ",null]' END) || '}' AS line
    FROM lineitem"""


P7_SQL = f"""
WITH products AS ({PRODUCTS_SQL}), reviews AS ({reviews_sql()}),
{_CARD_SQL},
{_EVENT_LINES_SQL.strip().removeprefix("WITH ")},
raw AS (SELECT line FROM ev UNION ALL SELECT line FROM ({_review_lines_sql()})),
m AS (
  SELECT CAST(duplicate_asin_records AS DOUBLE) AS product_asin_uniqueness,
         CAST((SELECT (count(*) FILTER (WHERE NOT {_has('asin', 'text')}) > 0)::INT
                    + (count(*) FILTER (WHERE NOT {_has('title', 'text')}) > 0)::INT FROM products) AS DOUBLE)
             AS product_required_fields,
         CAST((SELECT (count(*) FILTER (WHERE product_key IS NULL) > 0)::INT
                    + (count(*) FILTER (WHERE reviewer_key IS NULL) > 0)::INT
                    + (count(*) FILTER (WHERE rating IS NULL) > 0)::INT
                    + (count(*) FILTER (WHERE verified IS NULL) > 0)::INT FROM reviews) AS DOUBLE)
             AS review_required_fields,
         orphan_asin_percentage AS review_product_referential_integrity,
         CAST((SELECT count(*) FROM raw WHERE trim(line) <> ''
                 AND CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT' ELSE TRUE END) AS DOUBLE)
             AS malformed_json
  FROM card),
rows AS (
  SELECT * FROM (UNPIVOT m ON product_asin_uniqueness, product_required_fields, review_required_fields,
                 review_product_referential_integrity, malformed_json INTO NAME "check" VALUE value))
SELECT "check", CASE WHEN value = 0 THEN 'PASS' WHEN "check" = 'malformed_json' THEN 'FAIL' ELSE 'WARN' END AS status,
       round(value, 6) AS value FROM rows
UNION ALL
SELECT 'overall', CASE WHEN max(CASE WHEN value = 0 THEN 0 WHEN "check" = 'malformed_json' THEN 2 ELSE 1 END) = 2
                       THEN 'FAIL'
                       WHEN max(CASE WHEN value = 0 THEN 0 WHEN "check" = 'malformed_json' THEN 2 ELSE 1 END) = 1
                       THEN 'WARN' ELSE 'PASS' END, NULL FROM rows
"""


@register("p7_checks", P7_SQL)
def p7_checks(spark, sf_dir):
    card = _cardinality(spark, sf_dir)
    products = roles.products(spark, sf_dir, with_description=False)
    reviews = roles.reviews(spark, sf_dir)
    pv = products.agg(_violations(products, ["asin", "title"]).alias("product_required_violations"))
    rv = reviews.agg(_violations(reviews, ["product_key", "reviewer_key", "rating", "verified"])
                     .alias("review_required_violations"))
    # lines that are no JSON object count as malformed, like lines that do not parse
    bad = parse_records(_event_lines(spark, sf_dir)).agg(F.count("parse_error").alias("product_malformed"))
    bad_reviews = parse_records(_review_lines(spark, sf_dir)).agg(F.count("parse_error").alias("review_malformed"))
    metrics = card
    for part in (pv, rv, bad, bad_reviews):
        metrics = with_one_row(metrics, part)
    return rounded(profile.checks(metrics))


# The review fields the reference treats as required.
REVIEW_REQUIRED = ("reviewerID", "asin", "overall", "verified", "unixReviewTime", "reviewTime")

P8_SQL = P1_SQL.replace(
    P1_SQL[P1_SQL.index("WITH d AS"):P1_SQL.index("kv AS")],
    f"WITH rec AS ({_review_lines_sql()}),\n",
).replace(
    "names AS (SELECT field FROM by_field UNION SELECT 'doc_id' UNION SELECT 'title')",
    "names AS (SELECT field FROM by_field " + " ".join(f"UNION SELECT '{f}'" for f in REVIEW_REQUIRED) + ")",
)


@register("p8_review_field_profile", P8_SQL)
def p8_review_field_profile(spark, sf_dir):
    recs = parse_records(_review_lines(spark, sf_dir)).where("parse_error IS NULL")
    prof = profile.field_profile(recs, required=REVIEW_REQUIRED, places=None)
    return rounded(prof.withColumn("types", _types_text(c("types"))))


# ------------------------------------------------------------------ p9
_PRODUCT_LINES_SQL = r"""
    SELECT '{' || concat_ws(',',
      CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN '"asin":"  ' || p_name || '\t"'
           ELSE '"asin":"' || p_name || '"' END,
      '"title":"' || p_name || '\u00a0"',
      CASE WHEN p_size % 7 = 0 THEN '"brand":"   "' ELSE '"brand":"' || p_brand || '"' END,
      '"category":["' || p_type || '","' || p_brand || '"]',
      '"main_cat":"' || p_type || '"',
      CASE p_size % 3 WHEN 0 THEN '"description":[]' WHEN 1 THEN '"description":["' || p_name || '","  "]'
           ELSE '"description":"' || p_name || '"' END,
      '"feature":["' || p_type || '",null," ","' || p_brand || '"]',
      CASE p_size % 4 WHEN 0 THEN '"price":"$' || format('{:,.2f}', p_retailprice) || '"'
           WHEN 1 THEN '"price":' || CAST(p_retailprice AS VARCHAR)
           WHEN 2 THEN '"price":"' || CAST(p_retailprice AS VARCHAR) || 'd"' ELSE '"price":""' END,
      CASE p_partkey % 3 WHEN 0 THEN '"imageURL":"http://i/' || p_partkey || '"'
           WHEN 1 THEN '"imageURL":["http://i/' || p_partkey || '",""]' END,
      '"date":"' || p_size || ' Jan"') || '}' AS line
    FROM part"""

# The product fields the reference treats as required.
PRODUCT_REQUIRED = ("asin",)

P9_SQL = P1_SQL.replace(
    P1_SQL[P1_SQL.index("WITH d AS"):P1_SQL.index("kv AS")],
    f"WITH rec AS ({_PRODUCT_LINES_SQL}),\n",
).replace(
    "names AS (SELECT field FROM by_field UNION SELECT 'doc_id' UNION SELECT 'title')",
    "names AS (SELECT field FROM by_field " + " ".join(f"UNION SELECT '{f}'" for f in PRODUCT_REQUIRED) + ")",
)


@register("p9_product_field_profile", P9_SQL)
def p9_product_field_profile(spark, sf_dir):
    from lakeloom.plans.q_ingest import _product_lines

    recs = parse_records(_product_lines(spark, sf_dir)).where("parse_error IS NULL")
    prof = profile.field_profile(recs, required=PRODUCT_REQUIRED, places=None)
    return rounded(prof.withColumn("types", _types_text(c("types"))))


# ------------------------------------------------------------ p10 / p12
P10_SQL = """
SELECT count(*) AS records,
       count(*) FILTER (WHERE l_linenumber % 3 <> 0) AS "with_reviewText",
       round(sum(l_linenumber) FILTER (WHERE l_linenumber % 3 <> 0) / count(*) FILTER (WHERE l_linenumber % 3 <> 0), 6) AS "avg_reviewText_length",
       count(*) AS with_summary,
       round(sum(length('S' || l_linenumber)) / count(*), 6) AS avg_summary_length,
       count(*) FILTER (WHERE l_orderkey % 4 IN (1, 2)) AS with_style,
       count(*) FILTER (WHERE l_linenumber IN (1, 3, 4, 5)) AS with_vote,
       count(*) FILTER (WHERE l_orderkey % 5 = 0) AS with_image
FROM lineitem
"""


@register("p10_review_availability", P10_SQL)
def p10_review_availability(spark, sf_dir):
    recs = parse_records(_review_lines(spark, sf_dir)).where("parse_error IS NULL")
    return rounded(profile.raw_availability(recs, places=None))


@register("p12_raw_rating_histogram", f"""
WITH lines AS ({_review_lines_sql()}), v AS (SELECT json_extract_string(line, '$.overall') AS value FROM lines)
SELECT value, count(*) AS count FROM v WHERE value IS NOT NULL GROUP BY 1""")
def p12_raw_rating_histogram(spark, sf_dir):
    recs = parse_records(_review_lines(spark, sf_dir)).where("parse_error IS NULL")
    return profile.raw_histogram(recs, "overall")


# ------------------------------------------------------------------ p11
P11_SQL = f"""
SELECT field, missing_records AS missing, empty_records AS empty FROM ({P8_SQL})
WHERE field IN ({", ".join(repr(f) for f in REVIEW_REQUIRED)}) AND (missing_records > 0 OR empty_records > 0)
"""


@register("p11_required_violations", P11_SQL)
def p11_required_violations(spark, sf_dir):
    recs = parse_records(_review_lines(spark, sf_dir)).where("parse_error IS NULL")
    return profile.required_violations(profile.field_profile(recs, required=REVIEW_REQUIRED), REVIEW_REQUIRED)


# ------------------------------------------------- p13 / p14 / p15 merged runs
_RUNS = 3


def _three_runs(spark, sf_dir, records=False, exact=True):
    """The profile state of three ingest runs: raw review lines, and reviews and products as typed tables."""
    path = os.path.join(checkpoint_dir(spark), f"profile-{uuid.uuid4().hex}")
    reviews, products = roles.reviews(spark, sf_dir), roles.products(spark, sf_dir, with_description=False)
    for run in range(_RUNS):
        if records:
            lines = _review_lines(spark, sf_dir).where(F.pmod(F.xxhash64("line"), lit(_RUNS)) == run)
            profile_store.save_run(path, f"r{run}", parse_records(lines).where("parse_error IS NULL"))
        else:
            mine = reviews.where(c("l_orderkey") % _RUNS == run)
            others = products.where(c("product_key") % _RUNS == run)
            profile_store.save_run(path, f"r{run}", tables={
                "reviews": (mine, ["review_text"], ["review_id", "reviewer_key", "product_key"]),
                "products": (others, ["title", "brand"], ["product_key", "asin"])}, exact=exact)
    return path


@register("p13_merged_field_profile", P8_SQL)
def p13_merged_field_profile(spark, sf_dir):
    """AG4: the field profile of three runs' stored partials, no line read again."""
    prof = profile_store.merged_fields(spark, _three_runs(spark, sf_dir, records=True), REVIEW_REQUIRED, places=None)
    return rounded(prof.withColumn("types", _types_text(c("types"))))


_P14_KEYS = [("reviews", "review_id"), ("reviews", "reviewer_key"), ("reviews", "product_key"), ("products", "product_key"), ("products", "asin")]
P14_SQL = f"""
WITH products AS ({PRODUCTS_SQL}), reviews AS ({reviews_sql()})
""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_name, count({k}) AS n, count(DISTINCT {k}) AS distinct_keys, TRUE AS estimate_close FROM {t}" for t, k in _P14_KEYS)


@register("p14_merged_keys", P14_SQL)
def p14_merged_keys(spark, sf_dir):
    """AG12: distinct keys of three runs, exact from stored keys and estimated
    from stored sketches (within 5 %, over six standard errors)."""
    path = _three_runs(spark, sf_dir)
    exact = profile_store.merged_keys(spark, path, exact=True)
    guess = profile_store.merged_keys(spark, path).select(c("table_name").alias("_t"), c("key_name").alias("_k"), c("distinct_keys").alias("_d"))
    both = exact.join(guess, (c("table_name") == c("_t")) & (c("key_name") == c("_k")))
    close = F.abs(c("_d") - c("distinct_keys")) <= F.greatest(lit(1.0), 0.05 * c("distinct_keys"))
    return both.select("table_name", "key_name", "n", "distinct_keys", close.alias("estimate_close"))


@register("p15_merged_texts_and_orphans", f"""
WITH products AS ({PRODUCTS_SQL}), reviews AS ({reviews_sql()}),
t AS (SELECT count(*) FILTER (WHERE {sql_normalize('review_text')} <> '') AS with_review_text,
             round(coalesce(avg(length({sql_normalize('review_text')})) FILTER (WHERE {sql_normalize('review_text')} <> ''), 0), 6) AS avg_review_text_length FROM reviews),
o AS (SELECT count(DISTINCT r.product_key) AS keys, count(DISTINCT r.product_key) FILTER (WHERE p.product_key IS NULL) AS orphans
      FROM reviews r LEFT JOIN products p ON p.product_key = r.product_key)
SELECT * FROM t, o""")
def p15_merged_texts_and_orphans(spark, sf_dir):
    """AG9 AG12: text lengths and orphan keys over three runs' stored state."""
    path = _three_runs(spark, sf_dir)
    texts = profile_store.merged_texts(spark, path, "reviews", ["review_text"], places=None)
    orphans = profile_store.merged_orphans(spark, path, ("reviews", "product_key"), ("products", "product_key"), exact=True)
    return rounded(with_one_row(texts, orphans))


# ------------------------------------------------------------------ p16
def _violations_sql(profile_sql, required):
    names = ", ".join(repr(f) for f in required)
    return f"""(SELECT field || '.missing' AS k, missing_records::DOUBLE AS v FROM ({profile_sql}) WHERE field IN ({names}) AND (missing_records > 0 OR empty_records > 0)
     UNION ALL SELECT field || '.empty', empty_records::DOUBLE FROM ({profile_sql}) WHERE field IN ({names}) AND (missing_records > 0 OR empty_records > 0))"""


P16_SQL = f"""
WITH products AS ({PRODUCTS_SQL}), reviews AS ({reviews_sql()}),
{_CARD_SQL},
{_EVENT_LINES_SQL.strip().removeprefix("WITH ")},
bad AS (SELECT (SELECT count(*) FROM ev WHERE trim(line) <> '' AND CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT' ELSE TRUE END) AS p,
               (SELECT count(*) FROM ({_review_lines_sql()}) WHERE trim(line) <> '' AND CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT' ELSE TRUE END) AS r),
found AS (
  SELECT '{profile.CHECKS[0]}' AS "check", 'duplicate_asin_records' AS k, duplicate_asin_records::DOUBLE AS v FROM card
  UNION ALL SELECT '{profile.CHECKS[1]}', k, v FROM {_violations_sql(P9_SQL, PRODUCT_REQUIRED)}
  UNION ALL SELECT '{profile.CHECKS[2]}', k, v FROM {_violations_sql(P8_SQL, REVIEW_REQUIRED)}
  UNION ALL SELECT '{profile.CHECKS[3]}', 'orphan_asin_percentage', orphan_asin_percentage FROM card
  UNION ALL SELECT '{profile.CHECKS[4]}', 'products', p FROM bad UNION ALL SELECT '{profile.CHECKS[4]}', 'reviews', r FROM bad),
names AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, '{d}' AS description" for c, d in profile.DESCRIPTIONS.items())}),
rows AS (SELECT c AS "check", CASE WHEN coalesce(max(v), 0) <= 0 THEN 'PASS' WHEN c = '{profile.CHECKS[4]}' THEN 'FAIL' ELSE 'WARN' END AS status, description,
    coalesce(string_agg(k || '=' || round(v * 1e6)::BIGINT, ',' ORDER BY k), '') AS details
  FROM names LEFT JOIN found ON "check" = c GROUP BY c, description)
SELECT * FROM rows
UNION ALL SELECT 'overall', CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (WHERE status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END, NULL, NULL FROM rows
"""


@register("p16_check_list", P16_SQL)
def p16_check_list(spark, sf_dir):
    """AG19: the check list with descriptions, violated fields and both malformed counts."""
    from lakeloom.plans.q_ingest import _product_lines

    def violations(lines, required):
        return profile.required_violations(profile.field_profile(parse_records(lines).where("parse_error IS NULL"), required=required), required)

    malformed = with_one_row(
        parse_records(_event_lines(spark, sf_dir)).agg(F.count("parse_error").alias("products")),
        parse_records(_review_lines(spark, sf_dir)).agg(F.count("parse_error").alias("reviews")))
    out = profile.check_list(
        _cardinality(spark, sf_dir), violations(_product_lines(spark, sf_dir), PRODUCT_REQUIRED), violations(_review_lines(spark, sf_dir), REVIEW_REQUIRED), malformed)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], lit("="), F.round(e["value"] * 1e6).cast("bigint").cast("string"))), ",")
    return out.select("check", "status", "description", shown.alias("details"))
