"""f*: multimodal features and image tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import features, gold
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.roles import PRODUCTS_SQL, sql_clean, sql_has_text


def _label(name, expr):
    return f"CASE WHEN {sql_clean(expr)} IS NOT NULL THEN '{name}: ' || {sql_clean(expr)} END"


_FEATS = f"list_filter(list_transform(features, lambda x: {sql_clean('x')}), lambda x: x IS NOT NULL)"
F1_SQL = f"""
WITH products AS ({PRODUCTS_SQL}),
f AS (
  SELECT product_key AS canonical_product_id, asin, title, brand, main_category, price,
         concat_ws(chr(10),
           {_label('Title', 'title')}, {_label('Brand', 'brand')}, {_label('Category', 'main_category')},
           CASE WHEN {sql_clean('description')} IS NOT NULL THEN 'Description: ' || {sql_clean('description')} END,
           CASE WHEN len({_FEATS}) > 0
                THEN 'Features:' || chr(10) || array_to_string(list_transform({_FEATS}, lambda x: '- ' || x), chr(10)) END
         ) AS text_content,
         CASE WHEN len(high_res_image_urls) > 0 THEN high_res_image_urls
              WHEN len(image_urls) > 0 THEN image_urls ELSE []::VARCHAR[] END AS imgs
  FROM products)
SELECT canonical_product_id, asin, title, brand, main_category, round(price, 6) AS price, text_content,
       array_to_string(imgs, '|') AS image_urls, {sql_has_text('text_content')} AS has_text,
       len(imgs) > 0 AS has_image
FROM f
"""


@register("f1_multimodal_features", F1_SQL)
def f1_multimodal_features(spark, sf_dir):
    products = roles.products(spark, sf_dir)
    summary = gold.product_summary(products, product_id="product_key")
    out = features.multimodal_features(summary, products, product_id="product_key")
    return rounded(out.withColumn("image_urls", F.array_join("image_urls", "|")))


_PAGES_SQL = """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [url] ELSE ['', url] END AS image_urls
FROM pages"""


def _page_images(spark, sf_dir):
    p = roles.table(spark, sf_dir, "pages")
    m = F.col("page_id") % 3
    imgs = (F.when(m == 0, F.array().cast("array<string>")).when(m == 1, F.array("url"))
            .otherwise(F.array(F.lit(""), F.col("url"))))
    return p.select("page_id", imgs.alias("image_urls"))


@register("f2_image_tasks", f"""
WITH p AS ({_PAGES_SQL})
SELECT page_id, image_urls[1] AS image_url FROM p WHERE len(image_urls) > 0 AND image_urls[1] <> ''""")
def f2_image_tasks(spark, sf_dir):
    return features.image_tasks(_page_images(spark, sf_dir), id_col="page_id", keep=())


@register("f3_feature_totals", f"""
WITH f AS ({F1_SQL})
SELECT count(*) AS products, count(*) FILTER (WHERE has_text) AS with_text,
       count(*) FILTER (WHERE has_image) AS with_image,
       count(*) FILTER (WHERE has_text AND has_image) AS with_text_and_image FROM f""")
def f3_feature_totals(spark, sf_dir):
    products = roles.products(spark, sf_dir)
    summary = gold.product_summary(products, product_id="product_key")
    return features.feature_totals(features.multimodal_features(summary, products, product_id="product_key"))
