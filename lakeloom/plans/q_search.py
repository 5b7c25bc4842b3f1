"""s*: vector collection, exact / batched / indexed top-k and enriched search
over the ``embeddings`` table. The query vector is the unit centroid of all
embeddings (batch: one centroid per label), computed by Spark; the index is
asked for the neighbours of every 50th vector."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lakeloom.operators import collection, gold, search, vector_index
from lakeloom.plans import roles
from lakeloom.plans.registry import register, rounded
from lakeloom.plans.q_gold import G1_SQL
from lakeloom.plans.roles import PRODUCTS_SQL
from lakeloom.session import checkpoint_dir

K = 10
K_BATCH = 5

_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _centroid_sql(by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}, pos" if by else "GROUP BY pos"
    grp2 = f"GROUP BY {by}" if by else ""
    return f"""
    (SELECT {sel}list_transform(m, lambda x: x / sqrt(list_sum(list_transform(m, lambda y: y * y)))) AS q
     FROM (SELECT {sel}list(a ORDER BY pos) AS m
           FROM (SELECT {sel}pos, avg(x) AS a
                 FROM (SELECT {sel}unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS x FROM {_E}) {grp})
           {grp2}))"""


S1_SQL = f"""
WITH q AS {_centroid_sql()},
s AS (SELECT vec_id, label, list_cosine_similarity(v, q) AS score FROM {_E}, q)
SELECT CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, label,
       round(score, 6) AS score
FROM s ORDER BY score DESC, vec_id LIMIT {K}
"""


def _points(spark, sf_dir):
    return roles.table(spark, sf_dir, "embeddings")


def _hits(spark, sf_dir):
    pts = _points(spark, sf_dir)
    q = search.query_vector(pts)
    return search.topk_exact(pts, q, k=K, id_col="vec_id", payload=["label"])


@register("s1_topk_exact", S1_SQL)
def s1_topk_exact(spark, sf_dir):
    return rounded(_hits(spark, sf_dir))


S2_SQL = f"""
WITH q AS {_centroid_sql('label')},
s AS (SELECT CAST(q.label AS BIGINT) AS query_id, e.vec_id, list_cosine_similarity(e.v, q.q) AS score FROM {_E} e, q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= {K_BATCH}
"""


@register("s2_batch_topk", S2_SQL)
def s2_batch_topk(spark, sf_dir):
    pts = _points(spark, sf_dir)
    queries = search.centroids(pts, by=["label"]).select(
        F.col("label").alias("query_id"), F.col("centroid").alias("query_vec"))
    return rounded(search.topk_batch(pts, queries, k=K_BATCH, id_col="vec_id"))


S3_SQL = f"""
WITH q AS {_centroid_sql()},
s AS (SELECT vec_id, list_cosine_similarity(v, q) AS score FROM {_E}, q),
hits AS (SELECT CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS canonical_product_id, score
         FROM s ORDER BY score DESC, vec_id LIMIT {K}),
products AS ({PRODUCTS_SQL}),
stats AS ({G1_SQL})
SELECT h.rank, h.canonical_product_id, round(h.score, 6) AS score,
       p.asin, p.title, p.brand, p.main_category, round(p.price, 6) AS price,
       coalesce(st.review_count, 0) AS review_count, st.avg_rating,
       coalesce(st.verified_review_count, 0) AS verified_review_count,
       coalesce(st.verified_review_ratio, 0.0) AS verified_review_ratio
FROM hits h LEFT JOIN products p ON p.product_key = h.canonical_product_id
            LEFT JOIN stats st ON st.canonical_product_id = h.canonical_product_id
"""


@register("s3_enriched_search", S3_SQL)
def s3_enriched_search(spark, sf_dir):
    hits = _hits(spark, sf_dir).select("rank", F.col("vec_id").alias("canonical_product_id"), "score")
    products = roles.products(spark, sf_dir, with_description=False)
    summary = gold.product_summary(products, product_id="product_key").select(
        "canonical_product_id", "asin", "title", "brand", "main_category", "price")
    # statistics for the hit products only: reviews are reduced before the aggregation
    reviews = search.restrict_to_hits(roles.reviews(spark, sf_dir), hits, "canonical_product_id", "product_key")
    stats = gold.product_review_stats(reviews, key="product_key").select(
        "canonical_product_id", "review_count", "avg_rating", "verified_review_count", "verified_review_ratio")
    return rounded(search.enriched_search(hits, summary, stats))


S4_SQL = """
WITH base AS (SELECT vec_id AS point_id, label, 1 AS version, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings),
upd AS (SELECT vec_id AS point_id, label + 100 AS label, 2 AS version, CAST(len(embedding) AS INTEGER) AS dim
        FROM embeddings WHERE label % 2 = 0
        UNION ALL
        SELECT vec_id + 1000000, label, 2, CAST(len(embedding) AS INTEGER) FROM embeddings WHERE label % 2 = 0),
u AS (SELECT * FROM base UNION ALL SELECT * FROM upd)
SELECT point_id, arg_max(version, version) AS version, arg_max(label, version) AS label,
       arg_max(dim, version) AS embedding_dimension
FROM u GROUP BY point_id
"""


@register("s4_vector_upsert", S4_SQL)
def s4_vector_upsert(spark, sf_dir):
    """A collection is created and filled on shared storage, points are
    replaced and added, the same write is repeated, and the points are read back."""
    e = _points(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), f"s4-{uuid.uuid4().hex}")
    changed = e.where(F.col("label") % 2 == 0)
    updates = changed.withColumn("label", F.col("label") + 100).unionByName(changed.withColumn("vec_id", F.col("vec_id") + 1000000))
    c = collection.create_collection(spark, path, 64, "given", {"label": "int"}, buckets=16)
    c = collection.upsert(spark, c, e, "vec_id", version=1)
    for _ in range(2):
        c = collection.upsert(spark, c, updates, "vec_id", version=2)
    out = collection.read(spark, collection.open_collection(spark, path))
    return out.select("point_id", F.col("version").cast("int").alias("version"), "label", F.size("embedding").alias("embedding_dimension"))


EVERY = 50
S5_SQL = f"""
WITH s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(e.v, q.v) AS score FROM {_E} e, {_E} q WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= {K}
"""


def _index(spark, pts):
    path = os.path.join(checkpoint_dir(spark), f"index-{uuid.uuid4().hex}")
    vector_index.build(spark, pts, path, "vec_id", payload=["label"])
    return vector_index.open_index(spark, path)


def _queries(pts):
    return pts.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


@register("s5_index_exact", S5_SQL)
def s5_index_exact(spark, sf_dir):
    """The stored index of all vectors, all of its cells probed."""
    pts = _points(spark, sf_dir)
    index = _index(spark, pts)
    return rounded(vector_index.search(spark, index, _queries(pts), K, probes=index.cells))


@register("s7_index_recall", f"""
SELECT count(*) AS queries, {K} * count(*) AS true_hits, TRUE AS recall_reached FROM embeddings WHERE vec_id % {EVERY} = 0""")
def s7_index_recall(spark, sf_dir):
    """The stored index with as many probes as it measured for itself,
    against the exact batch search: whether nine tenths of the true hits are found."""
    pts = _points(spark, sf_dir)
    found = vector_index.search(spark, _index(spark, pts), _queries(pts), K)
    each = vector_index.recall_of(found, search.topk_batch(pts, _queries(pts), K, id_col="vec_id"), id_col="vec_id")
    return each.agg(F.count(F.lit(1)).alias("queries"), F.sum("true_hits").alias("true_hits"), (F.sum("found") >= 0.9 * F.sum("true_hits")).alias("recall_reached"))
