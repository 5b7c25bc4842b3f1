"""Role views over the driver's tables, built twice: as Spark DataFrames and as
DuckDB SQL text for the oracle. Both must derive exactly the same rows.

Roles: product = part (asin = p_name, description = the document with the
same key), review = lineitem (product = l_partkey, reviewer = l_suppkey),
text records = documents. NULLs, blanks and out-of-range values are injected
by CASE rules on existing columns, so every row of the source is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import WS_CLASS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string")


# ---------------------------------------------------------------- reviews
def reviews(spark: SparkSession, sf_dir: str, rating_mod: int = 5) -> DataFrame:
    """lineitem as reviews. ``rating_mod=5`` gives ratings 1..5 (NULL above
    quantity 45); ``rating_mod=7`` gives 0..6 for validation tests."""
    li = table(spark, sf_dir, "lineitem")
    base = 1 if rating_mod == 5 else 0
    img = lambda s: F.concat(F.lit("img/"), _s("l_partkey"), F.lit(s))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("reviewer_key"),
        F.when(F.col("l_quantity") > 45, F.lit(None))
        .otherwise(F.lit(base) + F.floor("l_quantity") % rating_mod)
        .cast("double")
        .alias("rating"),
        (F.col("l_returnflag") == "R").alias("verified"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("  "))
        .otherwise(F.repeat(F.lit("x"), F.col("l_linenumber")))
        .alias("review_text"),
        F.when(F.col("l_orderkey") % 3 == 0, F.array().cast("array<string>"))
        .when(F.col("l_orderkey") % 3 == 1, F.array(img("/a")))
        .otherwise(F.array(img("/a"), img("/b")))
        .alias("image_urls"),
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("review_id"),
    )


def reviews_sql(rating_mod: int = 5) -> str:
    base = 1 if rating_mod == 5 else 0
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey AS product_key, l_suppkey AS reviewer_key,
           CAST(CASE WHEN l_quantity > 45 THEN NULL ELSE {base} + floor(l_quantity) % {rating_mod} END AS DOUBLE) AS rating,
           l_returnflag = 'R' AS verified,
           CASE WHEN l_linenumber % 3 = 0 THEN '  ' ELSE repeat('x', l_linenumber) END AS review_text,
           CASE WHEN l_orderkey % 3 = 0 THEN []::VARCHAR[]
                WHEN l_orderkey % 3 = 1 THEN ['img/' || l_partkey || '/a']
                ELSE ['img/' || l_partkey || '/a', 'img/' || l_partkey || '/b'] END AS image_urls,
           CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id
    FROM lineitem"""


# --------------------------------------------------------------- products
def products(spark: SparkSession, sf_dir: str, with_description: bool = True) -> DataFrame:
    """part as canonical products; description is the document text with the
    same key (NULL when there is none)."""
    p = table(spark, sf_dir, "part")
    if with_description:
        d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("doc_text"))
        p = p.join(d, p.p_partkey == d.doc_id, "left")
    else:
        p = p.withColumn("doc_text", F.lit(None).cast("string"))
    size = F.col("p_size")
    key = _s("p_partkey")
    return p.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_name").alias("asin"),
        F.when(size % 10 == 0, F.lit(None))
        .when(size % 10 == 1, F.lit(" \t"))
        .otherwise(F.concat_ws(" ", "p_name", "p_type"))
        .alias("title"),
        F.when(size % 7 == 0, F.lit("  ")).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("main_category"),
        F.when(size % 9 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("price"),
        F.col("doc_text").alias("description"),
        F.when(size % 3 == 0, F.array().cast("array<string>"))
        .when(size % 3 == 1, F.array(F.col("p_type")))
        .otherwise(F.array(F.col("p_brand"), F.lit(" "), F.col("p_type")))
        .alias("features"),
        F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("http://img.example/"), key, F.lit(".jpg"))))
        .alias("image_urls"),
        F.when(F.col("p_partkey") % 5 == 0, F.array(F.concat(F.lit("http://img.example/hi/"), key, F.lit(".jpg"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("high_res_image_urls"),
    )


PRODUCTS_SQL = """
    SELECT p_partkey AS product_key, p_name AS asin,
           CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN ' ' || chr(9)
                ELSE p_name || ' ' || p_type END AS title,
           CASE WHEN p_size % 7 = 0 THEN '  ' ELSE p_brand END AS brand,
           p_type AS main_category,
           CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_retailprice END AS price,
           d.text AS description,
           CASE WHEN p_size % 3 = 0 THEN []::VARCHAR[] WHEN p_size % 3 = 1 THEN [p_type]
                ELSE [p_brand, ' ', p_type] END AS features,
           CASE WHEN p_partkey % 4 = 0 THEN []::VARCHAR[]
                ELSE ['http://img.example/' || p_partkey || '.jpg'] END AS image_urls,
           CASE WHEN p_partkey % 5 = 0 THEN ['http://img.example/hi/' || p_partkey || '.jpg']
                ELSE []::VARCHAR[] END AS high_res_image_urls
    FROM part LEFT JOIN documents d ON d.doc_id = p_partkey"""


def product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product side for orphan tests: every part, but the key of each tenth
    one is NULL, so that its reviews become orphans."""
    part = table(spark, sf_dir, "part")
    return part.withColumn("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")))


PRODUCT_KEYS_SQL = "SELECT * REPLACE (CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS p_partkey) FROM part"


# ------------------------------------------------------- keyed documents
def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with an asin-like key: NULL for German, blank for Spanish."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.when(F.col("lang") == "de", F.lit(None))
        .when(F.col("lang") == "es", F.lit(""))
        .otherwise(F.concat(F.lit("D"), _s("doc_id")))
        .alias("asin"),
        "lang",
        "source",
        "n_chars",
    )


KEYED_DOCUMENTS_SQL = """
    SELECT doc_id,
           CASE WHEN lang = 'de' THEN NULL WHEN lang = 'es' THEN '' ELSE 'D' || doc_id END AS asin,
           lang, source, n_chars
    FROM documents"""


# ------------------------------------------------------------ SQL helpers
# The same whitespace class for DuckDB (RE2 syntax).
SQL_WS = WS_CLASS.replace(r"\x85", r"\x{85}")


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_clean(expr: str) -> str:
    return f"NULLIF({sql_strip(expr)}, '')"


def sql_has_text(expr: str) -> str:
    return f"COALESCE({sql_strip(expr)} <> '', FALSE)"


def sql_normalize(expr: str) -> str:
    return f"COALESCE({sql_strip(f'regexp_replace({expr}, {chr(39)}{SQL_WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '')"
