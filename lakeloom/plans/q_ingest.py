"""i*: raw JSON lines rendered from the driver tables, then parsed and
normalized by the library. Faults are injected by rules on key columns; the
oracle computes the expected canonical values directly from the source."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lakeloom.functions.values import clean_list, clean_number, field, style_json
from lakeloom.operators import ingest, resolve
from lakeloom.plans import jsontext, roles
from lakeloom.plans.registry import register, rounded
from lakeloom.session import checkpoint_dir
from lakeloom.sources.raw import head, parse_records, read_lines, split_records, spread, with_line_numbers

c, lit = F.col, F.lit


_s, _q, _kv, _obj = jsontext.s, jsontext.q, jsontext.kv, jsontext.obj


# ------------------------------------------------------------ i1 / i2 lines
def _event_lines(spark, sf_dir):
    e = spread(roles.table(spark, sf_dir, "events"))
    m = c("event_id") % 50
    line = (
        F.when(m == 3, lit("{bad"))
        .when(m == 7, lit("[1,2]"))
        .when(m == 11, lit(""))
        .when(m == 13, lit('"text"'))
        .when(m == 17, F.concat(c("props"), lit(" junk")))
        .when(m == 19, lit("  "))
        .when(m == 23, F.concat(c("props"), c("props")))
        .when(m == 29, F.concat(c("props"), lit(" junk}")))
        .when(m == 31, F.concat(c("props"), lit(","), c("props")))
        .when(m == 37, lit("12 abc"))
        .when(m == 41, lit("[1] x]"))
        .when(m == 43, lit('"t" junk"'))
        .when(m == 47, lit('{"k":1}] {}'))
        .when(m == 48, lit('{"k":{"n":[{"m":"}"}]},"j":"]"}  '))
        .otherwise(c("props"))
    )
    return e.select("event_id", line.alias("line"))


_EVENT_LINES_SQL = """
WITH ev AS (
  SELECT event_id,
         CASE event_id % 50 WHEN 3 THEN '{bad' WHEN 7 THEN '[1,2]' WHEN 11 THEN '' WHEN 13 THEN '"text"'
              WHEN 17 THEN props || ' junk' WHEN 19 THEN '  '
              WHEN 23 THEN props || props WHEN 29 THEN props || ' junk}' WHEN 31 THEN props || ',' || props
              WHEN 37 THEN '12 abc' WHEN 41 THEN '[1] x]' WHEN 43 THEN '"t" junk"' WHEN 47 THEN '{"k":1}] {}'
              WHEN 48 THEN '{"k":{"n":[{"m":"}"}]},"j":"]"}  ' ELSE props END AS line
  FROM events)
"""


@register("i1_raw_objects", _EVENT_LINES_SQL + """
SELECT event_id, TRY_CAST(json_extract(line, '$.k') AS BIGINT) AS k FROM ev
WHERE trim(line) <> '' AND json_valid(line) AND CASE WHEN json_valid(line) THEN json_type(line) END = 'OBJECT'""")
def i1_raw_objects(spark, sf_dir):
    good, _ = split_records(parse_records(_event_lines(spark, sf_dir)))
    return good.select("event_id", F.try_variant_get(field("record", "k"), "$", "bigint").alias("k"))


@register("i2_malformed", _EVENT_LINES_SQL + """
SELECT event_id, line,
       CASE WHEN NOT json_valid(line) THEN 'malformed_json' ELSE 'not_object' END AS parse_error
FROM ev WHERE trim(line) <> '' AND (NOT json_valid(line) OR CASE WHEN json_valid(line) THEN json_type(line) END <> 'OBJECT')""")
def i2_malformed(spark, sf_dir):
    _, bad = split_records(parse_records(_event_lines(spark, sf_dir)))
    return bad.select("event_id", "line", "parse_error")


# ------------------------------------------------------------------ i3
def _product_lines(spark, sf_dir):
    p = spread(roles.table(spark, sf_dir, "part"))
    k, size = c("p_partkey"), c("p_size")
    line = _obj(
        F.when(k % 10 == 0, lit(None))
        .when(k % 10 == 1, _kv("asin", _q("  ", c("p_name"), "\\t")))
        .otherwise(_kv("asin", _q(c("p_name")))),
        _kv("title", _q(c("p_name"), "\\u00a0")),
        F.when(size % 7 == 0, _kv("brand", _q("   "))).otherwise(_kv("brand", _q(c("p_brand")))),
        _kv("category", F.concat(lit("["), _q(c("p_type")), lit(","), _q(c("p_brand")), lit("]"))),
        _kv("main_cat", _q(c("p_type"))),
        F.when(size % 3 == 0, _kv("description", lit("[]")))
        .when(size % 3 == 1, _kv("description", F.concat(lit("["), _q(c("p_name")), lit(',"  "]'))))
        .otherwise(_kv("description", _q(c("p_name")))),
        _kv("feature", F.concat(lit("["), _q(c("p_type")), lit(',null," ",'), _q(c("p_brand")), lit("]"))),
        F.when(size % 4 == 0, _kv("price", _q("$", F.format_number(c("p_retailprice"), 2))))
        .when(size % 4 == 1, _kv("price", _s("p_retailprice")))
        .when(size % 4 == 2, _kv("price", _q(_s("p_retailprice"), "d")))
        .otherwise(_kv("price", lit('""'))),
        F.when(k % 3 == 0, _kv("imageURL", _q("http://i/", _s("p_partkey"))))
        .when(k % 3 == 1, _kv("imageURL", F.concat(lit("["), _q("http://i/", _s("p_partkey")), lit(',""]')))),
        _kv("date", _q(_s("p_size"), " Jan")),
    )
    return p.select(line.alias("line"))


I3_SQL = """
SELECT 'prod_' || left(sha256(p_name), 24) AS product_id, p_name AS asin, p_name AS title,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS brand,
       p_type || ' > ' || p_brand AS category, p_type AS main_category,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS description,
       p_type || '|' || p_brand AS features,
       round(CASE p_size % 4 WHEN 0 THEN round(p_retailprice, 2) WHEN 1 THEN p_retailprice END, 6) AS price,
       CASE WHEN p_partkey % 3 = 2 THEN '' ELSE 'http://i/' || p_partkey END AS image_urls,
       '' AS high_res_image_urls, '' AS also_buy, '' AS also_view, '' AS similar_items,
       p_size || ' Jan' AS product_date,
       'amazon_electronics_metadata' AS raw_source, 'v1' AS schema_version
FROM part WHERE p_partkey % 10 <> 0
"""

_LIST_COLS = ["features", "image_urls", "high_res_image_urls", "also_buy", "also_view", "similar_items"]


def _lists_as_text(df, cols):
    return df.select(*[F.array_join(c(x), "|").alias(x) if x in cols else c(x) for x in df.columns])


@register("i3_normalize_products", I3_SQL)
def i3_normalize_products(spark, sf_dir):
    out = ingest.ingest(_product_lines(spark, sf_dir), "products")
    valid, _ = ingest.split_valid(out)
    return rounded(_lists_as_text(valid.drop("line"), _LIST_COLS))


# ------------------------------------------------------------- i4 / i5
def _review_lines(spark, sf_dir):
    # the source rows are spread first, so the rendering itself runs on every core
    li = spread(roles.table(spark, sf_dir, "lineitem"))
    o, n, qty = c("l_orderkey"), c("l_linenumber"), c("l_quantity")
    line = _obj(
        F.when(o % 97 == 0, lit(None)).otherwise(_kv("reviewerID", _q("R", _s("l_suppkey")))),
        F.when(o % 89 == 0, _kv("asin", _q("   "))).otherwise(_kv("asin", _q("A", _s("l_partkey")))),
        F.when(o % 83 == 0, lit(None))
        .when(o % 79 == 0, _kv("unixReviewTime", _q("x")))
        .otherwise(_kv("unixReviewTime", F.unix_seconds(c("l_shipdate").cast("timestamp")).cast("string"))),
        F.when(o % 73 == 0, _kv("overall", _q("abc")))
        .when(o % 71 == 0, _kv("overall", lit("-1")))
        .when(o % 67 == 0, _kv("overall", lit("5.5")))
        .when(qty > 45, _kv("overall", _q("4")))
        .otherwise(_kv("overall", F.concat((F.floor(qty) % 6).cast("string"), lit(".0")))),
        _kv("verified", F.when(c("l_returnflag") == "R", lit("true")).otherwise(lit("false"))),
        F.when(n % 3 == 0, _kv("reviewText", _q("  "))).otherwise(_kv("reviewText", _q(F.repeat(lit("x"), n)))),
        _kv("summary", _q(" S", _s("l_linenumber"), " ")),
        F.when(n == 1, _kv("vote", _q("1,234")))
        .when(n == 2, _kv("vote", lit('""')))
        .when(n == 3, _kv("vote", _q("x")))
        .when(n == 4, _kv("vote", lit("3")))
        .when(n == 5, _kv("vote", lit("3.5"))),
        F.when(o % 4 == 0, _kv("style", lit("{}")))
        .when(o % 4 == 1, _kv("style", F.concat(lit('{"b":1,"a":'), _q(c("l_returnflag")), lit("}"))))
        .when(o % 4 == 2, _kv("style", _q("s"))),
        F.when(o % 5 == 0, _kv("image", F.concat(lit("["), _q("u", _s("l_partkey")), lit(',"  ",null]')))),
    )
    return li.select(line.alias("line"))


_REVIEW_ERR_SQL = """
CASE WHEN l_orderkey % 89 = 0 THEN 'missing_asin'
     WHEN l_orderkey % 97 = 0 THEN 'missing_reviewer_id'
     WHEN l_orderkey % 83 = 0 THEN 'missing_review_timestamp'
     WHEN l_orderkey % 79 = 0 THEN 'invalid_review_timestamp'
     WHEN l_orderkey % 73 = 0 THEN 'missing_rating'
     WHEN l_orderkey % 71 = 0 OR l_orderkey % 67 = 0 THEN 'invalid_rating' END"""

I4_SQL = f"""
WITH r AS (
  SELECT *, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts,
         CASE WHEN l_quantity > 45 THEN 4.0 ELSE floor(l_quantity) % 6 END AS rating_v,
         CASE WHEN l_quantity > 45 THEN '4' WHEN floor(l_quantity) % 6 = 0 THEN ''
              ELSE CAST(CAST(floor(l_quantity) % 6 AS BIGINT) AS VARCHAR) || '.0' END AS rating_text,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE repeat('x', l_linenumber) END AS text_v
  FROM lineitem WHERE ({_REVIEW_ERR_SQL}) IS NULL)
SELECT 'rev_' || left(sha256('R' || l_suppkey || '|' || 'A' || l_partkey || '|' || ts || '|' || rating_text
                             || '|' || coalesce(text_v, '') || '|' || 'S' || l_linenumber), 32) AS review_id,
       'prod_' || left(sha256('A' || l_partkey), 24) AS product_id,
       'A' || l_partkey AS asin, 'R' || l_suppkey AS reviewer_id, NULL::VARCHAR AS reviewer_name,
       round(CAST(rating_v AS DOUBLE), 6) AS rating, l_returnflag = 'R' AS verified,
       text_v AS review_text, 'S' || l_linenumber AS summary, NULL::VARCHAR AS review_time,
       ts AS review_timestamp,
       CASE l_linenumber WHEN 1 THEN 1234 WHEN 4 THEN 3 END::BIGINT AS vote,
       CASE WHEN l_orderkey % 5 = 0 THEN 'u' || l_partkey ELSE '' END AS image_urls,
       CASE l_orderkey % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN '{{"a": "' || l_returnflag || '", "b": 1}}' END AS style,
       'amazon_electronics_reviews' AS raw_source, 'v1' AS schema_version
FROM r
"""


@register("i4_normalize_reviews", I4_SQL)
def i4_normalize_reviews(spark, sf_dir):
    out = ingest.ingest(_review_lines(spark, sf_dir), "reviews")
    valid, _ = ingest.split_valid(out)
    return rounded(_lists_as_text(valid.drop("line"), ["image_urls"]))


@register("i5_review_errors", f"""
SELECT {_REVIEW_ERR_SQL} AS error, count(*) AS n FROM lineitem
WHERE ({_REVIEW_ERR_SQL}) IS NOT NULL GROUP BY 1""")
def i5_review_errors(spark, sf_dir):
    out = ingest.ingest(_review_lines(spark, sf_dir), "reviews")
    _, bad = ingest.split_valid(out)
    return bad.groupBy("error").agg(F.count(lit(1)).alias("n"))


# ------------------------------------------------------------ i6 / i7 / i8
def _event_values(spark, sf_dir, key, rule):
    e = spread(roles.table(spark, sf_dir, "events"))
    lines = e.select("event_id", _obj(_kv(key, rule(e))).alias("line"))
    return parse_records(lines)


def _price_text(e):
    m = c("event_id") % 8
    v = _s("value")
    return (
        F.when(m == 0, _q("$", v))
        .when(m == 1, _q(v, "d"))
        .when(m == 2, _q(" ", v, " "))
        .when(m == 3, _q("1_000"))
        .when(m == 4, lit("true"))
        .when(m == 5, _q("$", _s("user_id"), ",000.5"))
        .when(m == 6, lit('""'))
        .otherwise(v)
    )


@register("i6_clean_number", """
SELECT event_id, round(CASE event_id % 8 WHEN 0 THEN value WHEN 2 THEN value WHEN 4 THEN 1.0
                              WHEN 5 THEN user_id * 1000 + 0.5 WHEN 7 THEN value END, 6) AS price
FROM events""")
def i6_clean_number(spark, sf_dir):
    parsed = _event_values(spark, sf_dir, "price", _price_text)
    return rounded(parsed.select("event_id", clean_number(field("record", "price")).alias("price")))


def _list_text(e):
    m = c("event_id") % 6
    return (
        F.when(m == 0, F.concat(lit("["), _q(c("event_type")), lit(","), _q(" ", _s("user_id"), " "), lit(',null,""]')))
        .when(m == 1, _q(" ", c("event_type"), " "))
        .when(m == 2, _q("  "))
        .when(m == 3, lit("5"))
        .when(m == 4, lit("null"))
        .otherwise(F.concat(lit("[1,"), _q(c("event_type")), lit("]")))
    )


@register("i7_clean_list", """
SELECT event_id,
       CASE event_id % 6 WHEN 0 THEN event_type || '|' || user_id WHEN 1 THEN event_type
            WHEN 5 THEN '1|' || event_type ELSE '' END AS items,
       CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 5 THEN 2 ELSE 0 END AS n_items
FROM events""")
def i7_clean_list(spark, sf_dir):
    parsed = _event_values(spark, sf_dir, "items", _list_text)
    items = clean_list(field("record", "items"))
    return parsed.select("event_id", F.array_join(items, "|").alias("items"), F.size(items).alias("n_items"))


def _style_text(e):
    m = c("event_id") % 4
    return (
        F.when(m == 0, c("props"))
        .when(m == 1, F.concat(lit('{"z":'), _q(c("event_type")), lit(',"a":'), _s("user_id"), lit("}")))
        .when(m == 2, _q("s"))
        .otherwise(lit("{}"))
    )


@register("i8_style_json", """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN props
            WHEN 1 THEN '{"a": ' || user_id || ', "z": "' || event_type || '"}'
            WHEN 3 THEN '{}' END AS style
FROM events""")
def i8_style_json(spark, sf_dir):
    parsed = _event_values(spark, sf_dir, "style", _style_text)
    return parsed.select("event_id", style_json(field("record", "style")).alias("style"))


# ------------------------------------------------- i9 / i10 source positions
_FILES = 3


def _raw_files(spark, sf_dir):
    """Stand-in raw input: three files, the second one gzip, of lines in falling order of their number."""
    base = os.path.join(checkpoint_dir(spark), f"i9-{uuid.uuid4().hex}")
    part = roles.table(spark, sf_dir, "part").select("p_partkey")
    line = F.concat(lit('{"asin":"A'), (F.floor(c("p_partkey") / 7) % 40).cast("string"), lit('","n":'), c("p_partkey").cast("string"), lit("}"))
    for i in range(_FILES):
        mine = part.where(c("p_partkey") % _FILES == i).repartition(1).sortWithinPartitions(F.desc("p_partkey"))
        mine.select(line.alias("value")).write.option("compression", "gzip" if i == 1 else "none").text(f"{base}/f{i}")
    lines = with_line_numbers(read_lines(spark, [f"{base}/f{i}" for i in range(_FILES)]))
    good, _ = split_records(parse_records(lines))
    record = c("record")
    return good.select(
        F.try_variant_get(field(record, "asin"), "$", "string").alias("asin"), F.try_variant_get(field(record, "n"), "$", "bigint").alias("n"),
        F.regexp_extract("source_file", "/f([0-9]+)/[^/]*$", 1).cast("int").alias("file"), "line_no", "source_file", "block", "seq")


_POSITIONS_SQL = f"""
WITH p AS (SELECT 'A' || ((p_partkey // 7) % 40) AS asin, p_partkey AS n, (p_partkey % {_FILES})::INTEGER AS file,
                  row_number() OVER (PARTITION BY p_partkey % {_FILES} ORDER BY p_partkey DESC) - 1 AS line_no FROM part)
"""


@register("i9_first_in_files", _POSITIONS_SQL + """
SELECT asin, n, file, line_no FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY file, line_no) AS k FROM p) WHERE k = 1""")
def i9_first_in_files(spark, sf_dir):
    """Of each key the row that comes first in the files, whatever their splits."""
    rows = _raw_files(spark, sf_dir)
    return resolve.canonical_products(rows, key="asin").select("asin", "n", "file", "line_no")


@register("i10_head_of_files", _POSITIONS_SQL + "SELECT asin, n, file, line_no FROM p ORDER BY file, line_no LIMIT 25")
def i10_head_of_files(spark, sf_dir):
    """The first 25 records in the order of the files (a head is the feature)."""
    return head(_raw_files(spark, sf_dir), 25).select("asin", "n", "file", "line_no")
