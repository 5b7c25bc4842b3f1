"""e*: text and image embeddings and a resumed embedding job."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeloom.operators import embed, runs
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.q_features import _page_images
from lakeloom.operators.features import image_tasks
from lakeloom.session import checkpoint_dir

DIM = 384


def shown(vec: str):
    """A vector as text both engines write alike: millionths, joined by commas."""
    return F.array_join(F.transform(vec, lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string")), ",")


def embedding_ctes(name: str, source: str, key: str, dim: int = DIM) -> str:
    """CTEs of the signed feature hashing of a table's texts: ``name``_vec (key, place, v), places without a
    token left out, and ``name``_text (key, contents)."""
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
{name}_tok AS (SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), {lower}), '{embed.TOKEN}')) AS t FROM {source}),
{name}_dig AS (SELECT {key}, md5(t) AS d, count(*) AS n FROM {name}_tok GROUP BY {key}, t),
{name}_sum AS (SELECT {key}, ('0x' || substr(d, 1, 8))::BIGINT % {dim} AS place, sum(CASE WHEN substr(d, 9, 1) < '8' THEN n ELSE -n END)::DOUBLE AS x
  FROM {name}_dig GROUP BY 1, 2),
{name}_len AS (SELECT {key}, sqrt(sum(x * x)) AS len FROM {name}_sum GROUP BY {key}),
{name}_vec AS MATERIALIZED (SELECT s.{key}, place, (x / len)::FLOAT::DOUBLE AS v FROM {name}_sum s JOIN {name}_len l ON s.{key} = l.{key} WHERE x <> 0),
{name}_text AS (SELECT d.{key}, string_agg(coalesce(round(v * 1e6)::BIGINT, 0)::VARCHAR, ',' ORDER BY p.place) AS contents
  FROM {source} d CROSS JOIN (SELECT unnest(range({dim})) AS place) p LEFT JOIN {name}_vec v ON v.{key} = d.{key} AND v.place = p.place GROUP BY d.{key})"""


@register("e1_embed_text", f"""
WITH {embedding_ctes('d', 'documents', 'doc_id')}
SELECT doc_id, 'signed-hash-{DIM}' AS embedding_model, {DIM} AS embedding_dimension, contents AS embedding FROM d_text""")
def e1_embed_text(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    out = embed.embed_text(docs, "text", ["doc_id"], dim=DIM)
    return out.select("doc_id", "embedding_model", "embedding_dimension", shown("embedding").alias("embedding"))


@register("e2_embed_images", """
WITH t AS (SELECT page_id, url, hex(encode(html)) AS h FROM pages WHERE page_id % 3 = 1),
b AS (SELECT page_id, ('0x' || substr(h, (2 * i + 1)::INTEGER, 2))::INTEGER AS bin, count(*)::DOUBLE AS n
      FROM (SELECT page_id, h, unnest(range(length(h) // 2)) AS i FROM t WHERE page_id % 7 <> 0) GROUP BY 1, 2),
l AS (SELECT page_id, sqrt(sum(n * n)) AS len FROM b GROUP BY page_id),
v AS (SELECT b.page_id, bin, (n / len)::FLOAT::DOUBLE AS x FROM b JOIN l USING (page_id)),
c AS (SELECT l.page_id, string_agg(coalesce(round(x * 1e6)::BIGINT, 0)::VARCHAR, ',' ORDER BY p.bin) AS contents
      FROM l CROSS JOIN (SELECT unnest(range(256)) AS bin) p LEFT JOIN v ON v.page_id = l.page_id AND v.bin = p.bin GROUP BY l.page_id)
SELECT t.page_id, url AS image_url, t.page_id % 7 <> 0 AS success,
       CASE WHEN t.page_id % 7 = 0 THEN 'ValueError: empty content' END AS error,
       'byte-histogram-256' AS embedding_model,
       CASE WHEN t.page_id % 7 <> 0 THEN 256 END AS embedding_dimension,
       contents AS embedding
FROM t LEFT JOIN c ON c.page_id = t.page_id""")
def e2_embed_images(spark, sf_dir):
    tasks = image_tasks(_page_images(spark, sf_dir), id_col="page_id", keep=())
    pages = roles.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("_pid"),
        F.when(F.col("page_id") % 7 == 0, F.lit(None)).otherwise(F.encode("html", "UTF-8")).alias("content"))
    with_content = tasks.join(pages, tasks.page_id == pages._pid, "left").drop("_pid")
    out = embed.embed_images(with_content, keep=["page_id"], content_col="content")
    return out.select("page_id", "image_url", "success", "error", "embedding_model", "embedding_dimension",
                      shown("embedding").alias("embedding"))


@register("e3_resume", f"""
WITH {embedding_ctes('d', 'documents', 'doc_id')}
SELECT doc_id, CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS run_id, {DIM} AS embedding_dimension, contents AS embedding
FROM d_text JOIN documents USING (doc_id)""")
def e3_resume(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    out = os.path.join(checkpoint_dir(spark), f"e3-{uuid.uuid4().hex}")

    def job(df):
        return embed.embed_text(df, "text", ["doc_id"], dim=DIM)

    # run 1 stops after the English documents (an interrupted job) ...
    embed.run_resumable(docs.where(F.col("lang") == "en"), "doc_id", job, out, run_id=1)
    # ... run 2 is started on everything and only embeds what is missing
    latest = embed.run_resumable(docs, "doc_id", job, out, run_id=2, parts=3)
    return latest.select("doc_id", "run_id", "embedding_dimension", shown("embedding").alias("embedding"))


@register("e5_committed_runs", f"""
WITH {embedding_ctes('d', 'documents', 'doc_id')}
SELECT doc_id, CASE WHEN lang = 'en' THEN 1 ELSE 2 END::BIGINT AS run_id, contents AS embedding FROM d_text JOIN documents USING (doc_id)""")
def e5_committed_runs(spark, sf_dir):
    """Run 1 (English) fails in the middle of a bucket, is started again
    and finishes; run 2 does the rest; the runs are compacted and read back."""
    docs = roles.table(spark, sf_dir, "documents")
    english = docs.where(F.col("lang") == "en")
    path = os.path.join(checkpoint_dir(spark), f"e5-{uuid.uuid4().hex}")
    last = english.agg(F.max("doc_id")).first()[0]

    def job(df):
        return embed.embed_text(df, "text", ["doc_id"], dim=DIM)

    def failing(df):
        lost = F.raise_error(F.lit("injected failure")).cast("string")
        return job(df.withColumn("text", F.when(F.col("doc_id") == last, lost).otherwise(F.col("text"))))

    try:
        runs.run_committed(english, "doc_id", failing, path, run_id=1, buckets=4)
    except PySparkException as ex:
        if "injected failure" not in str(ex):
            raise
    runs.run_committed(english, "doc_id", job, path, run_id=1, buckets=4)
    runs.run_committed(docs, "doc_id", job, path, run_id=2, buckets=4)
    runs.compact(spark, path, "doc_id")
    return runs.latest(spark, path, "doc_id").select("doc_id", "run_id", shown("embedding").alias("embedding"))


RETRIES = 2


def flaky_fetch(url: str) -> bytes:
    """A stand-in downloader: by the digest of a url it gives the bytes at the
    first, second or third try, or never; the bytes are the url's own."""
    faults = int(hashlib.md5(url.encode()).hexdigest()[:4], 16) % 5
    tries = _TRIES.pop(url, 0)
    if tries < faults:
        if tries < RETRIES:
            _TRIES[url] = tries + 1
        raise OSError(f"fault {tries + 1}")
    return url.encode()


_TRIES: dict[str, int] = {}


@register("e6_flaky_fetch", f"""
WITH t AS (SELECT page_id, url || '#' || page_id AS u FROM pages WHERE page_id % 3 = 1),
f AS (SELECT page_id, u, ('0x' || substr(md5(u), 1, 4))::INTEGER % 5 AS faults FROM t),
b AS (SELECT page_id, ('0x' || substr(hex(encode(u)), (2 * i + 1)::INTEGER, 2))::INTEGER AS bin, count(*)::DOUBLE AS n
      FROM (SELECT page_id, u, unnest(range(octet_length(encode(u)))) AS i FROM f) GROUP BY 1, 2),
l AS (SELECT page_id, sqrt(sum(n * n)) AS len FROM b GROUP BY page_id),
c AS (SELECT l.page_id, string_agg(coalesce(round((n / len)::FLOAT::DOUBLE * 1e6)::BIGINT, 0)::VARCHAR, ',' ORDER BY p.bin) AS contents
      FROM l CROSS JOIN (SELECT unnest(range(256)) AS bin) p LEFT JOIN b ON b.page_id = l.page_id AND b.bin = p.bin GROUP BY l.page_id)
SELECT f.page_id, faults <= {RETRIES} AS success, CASE WHEN faults > {RETRIES} THEN 'OSError: fault {RETRIES + 1}' END AS error,
       least(faults + 1, {RETRIES + 1})::INTEGER AS attempts, CASE WHEN faults <= {RETRIES} THEN contents END AS embedding
FROM f JOIN c USING (page_id)""")
def e6_flaky_fetch(spark, sf_dir):
    """Images are fetched with retries by a downloader that fails by rule, and encoded."""
    tasks = image_tasks(_page_images(spark, sf_dir), id_col="page_id", keep=())
    tasks = tasks.withColumn("image_url", F.concat_ws("#", "image_url", "page_id"))
    out = embed.embed_images(tasks, keep=["page_id"], fetch=flaky_fetch, retries=RETRIES, threads=4)
    return out.select("page_id", "success", "error", "attempts", shown("embedding").alias("embedding"))


@register("e4_embedding_totals", """
SELECT count(*) FILTER (WHERE page_id % 3 = 1) AS tasks,
       count(*) FILTER (WHERE page_id % 3 = 1 AND page_id % 7 <> 0) AS processed,
       count(*) FILTER (WHERE page_id % 3 = 1 AND page_id % 7 = 0) AS failed,
       count(*) FILTER (WHERE page_id % 3 = 1 AND page_id % 7 <> 0) AS rows_with_embedding,
       256 AS embedding_dimension,
       count(*) FILTER (WHERE page_id % 3 <> 1) AS products_without_image
FROM pages""")
def e4_embedding_totals(spark, sf_dir):
    """AG21 over the image embedding job of e2."""
    pages = _page_images(spark, sf_dir)
    tasks = image_tasks(pages, id_col="page_id", keep=())
    no_image = pages.join(tasks, "page_id", "left_anti")
    content = roles.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("_pid"),
        F.when(F.col("page_id") % 7 == 0, F.lit(None)).otherwise(F.encode("html", "UTF-8")).alias("content"))
    results = embed.embed_images(tasks.join(content, tasks.page_id == content._pid, "left").drop("_pid"),
                                 keep=["page_id"], content_col="content")
    return embed.embedding_totals(results, no_image)


K_TEXT = 3
_S6 = f"""
WITH {embedding_ctes('d', 'documents', 'doc_id')},
{embedding_ctes('q', 'QUERIES', 'item_id')},
d_norm AS (SELECT doc_id, sqrt(sum(v * v)) AS len FROM d_vec GROUP BY doc_id),
q_norm AS (SELECT item_id, sqrt(sum(v * v)) AS len FROM q_vec GROUP BY item_id),
dots AS (SELECT item_id, doc_id, sum(q_vec.v * d_vec.v) AS dot FROM q_vec JOIN d_vec USING (place) GROUP BY item_id, doc_id),
s AS (SELECT q.item_id AS query_id, d.doc_id, round(coalesce(dot / (q_norm.len * d_norm.len), 0), 9) AS score
  FROM QUERIES q CROSS JOIN documents d LEFT JOIN dots ON dots.item_id = q.item_id AND dots.doc_id = d.doc_id
  LEFT JOIN q_norm ON q_norm.item_id = q.item_id LEFT JOIN d_norm ON d_norm.doc_id = d.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= K
"""


@register("s6_text_search", _S6.replace("QUERIES", "benchmark").replace("<= K\n", f"<= {K_TEXT}\n"))
def s6_text_search(spark, sf_dir):
    """Every benchmark passage is a text query; the three closest
    documents by cosine similarity of their text embeddings."""
    from lakeloom.operators import search

    docs = embed.embed_text(roles.table(spark, sf_dir, "documents"), "text", ["doc_id"], dim=DIM)
    queries = embed.embed_text(roles.table(spark, sf_dir, "benchmark"), "text", ["item_id"], dim=DIM).select(
        F.col("item_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return rounded(search.topk_batch(docs, queries, k=K_TEXT, id_col="doc_id"))


_ONE = "(SELECT * FROM benchmark ORDER BY item_id LIMIT 1)"


@register("s8_text_query", _S6.replace("QUERIES", _ONE).replace("query_id, rank", "rank").replace("<= K\n", "<= 10\n"))
def s8_text_query(spark, sf_dir):
    """One query string, the first benchmark passage, embedded like the
    documents and searched among all of them."""
    from lakeloom.operators import search

    docs = embed.embed_text(roles.table(spark, sf_dir, "documents"), "text", ["doc_id"], dim=DIM)
    text = roles.table(spark, sf_dir, "benchmark").orderBy("item_id").first()["text"]
    return rounded(search.topk_text(docs, text, k=10, id_col="doc_id", dim=DIM))
