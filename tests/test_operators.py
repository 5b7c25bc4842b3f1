
from shared import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from lakeloom.operators import embed, features, gold, profile, resolve, search, silver
from lakeloom.plans import roles


def test_silver_plus_quarantine_is_total(spark):
    r = roles.reviews(spark, SF_SMALL, rating_mod=7)
    keys = silver.product_key_set(roles.product_keys(spark, SF_SMALL), asin="p_partkey")
    ok, bad = silver.split_reviews(r, keys, asin="product_key")
    assert ok.count() + bad.count() == r.count()
    assert set(x[0] for x in bad.select("error").distinct().collect()) == {"unknown_product", "invalid_rating"}


def test_null_key_is_orphan_row_not_orphan_key(spark):
    reviews = spark.createDataFrame([(None, 3.0), ("A", 3.0), ("B", 3.0)], "asin string, rating double")
    products = spark.createDataFrame([("A",)], "asin string")
    keys = silver.product_key_set(products)
    q = silver.review_quality(reviews.withColumn("review_id", F.lit("r")).withColumn("reviewer_id", F.lit("x"))
                              .withColumn("review_text", F.lit("t")), keys).first()
    assert q["orphan_reviews"] == 2 and q["orphan_asin_count"] == 1


def test_gold_same_rows_at_two_partition_counts(spark):
    r = roles.reviews(spark, SF_ORACLE)
    a = sorted(gold.product_review_stats(r.repartition(3), key="product_key").collect())
    b = sorted(gold.product_review_stats(r.repartition(17, "reviewer_key"), key="product_key").collect())
    assert a == b


def test_mapping_with_differing_ids(spark):
    df = spark.createDataFrame([("p1", "A", 1), ("p2", "A", 2), ("p3", "B", 3), ("p3", "B", 4)],
                               "product_id string, asin string, seq int")
    m = {(r.source_product_id, r.match_type) for r in resolve.entity_mapping(df, order_by="seq").collect()}
    assert m == {("p1", "canonical"), ("p2", "exact_asin_duplicate"), ("p3", "canonical")}
    canon = resolve.canonical_products(df, order_by="seq").orderBy("asin").collect()
    assert [(r.asin, r.product_id, r.seq) for r in canon] == [("A", "p1", 1), ("B", "p3", 3)]


def test_missing_key_guard(spark):
    df = spark.createDataFrame([("p1", None), ("p2", " "), ("p3", "x")], "product_id string, asin string")
    assert resolve.missing_key_count(df) == 2


def test_diagnosis_skips_groups_of_three(spark):
    df = spark.createDataFrame(
        [(1, "k", "T", 1.0), (2, "k", "t ", 1.0), (3, "m", "a", None), (4, "m", "b", None),
         (5, "z", "x", 1.0), (6, "z", "x", 1.0), (7, "z", "x", 1.0)],
        "seq int, asin string, title string, price double")
    r = resolve.diagnose_duplicates(df, "asin", "seq", {"title": "text", "price": "value"}).first()
    assert (r.total_groups, r.skipped_groups, r.exact_duplicates, r.title_differences, r.price_differences) == \
        (2, 1, 1, 1, 0)


def test_field_profile_invariants(spark):
    from lakeloom.plans.q_profile import _doc_records

    recs = _doc_records(spark, SF_SMALL).where("parse_error IS NULL")
    n = recs.count()
    for r in profile.field_profile(recs, required=("title",)).collect():
        assert r.present_records + r.missing_records == n
        assert sum(r.types.values()) == r.present_records


def test_histogram_sums_to_non_null(spark):
    r = roles.reviews(spark, SF_SMALL)
    h = profile.histogram(r, "rating").agg(F.sum("count")).first()[0]
    assert h == r.where("rating IS NOT NULL").count()


def test_features_text_layout(spark):
    summary = spark.createDataFrame([("p", "A", " T ", None, "Cat", 1.0)],
                                    "canonical_product_id string, asin string, title string, brand string, "
                                    "main_category string, price double")
    meta = spark.createDataFrame([("p", " d ", ["a", " ", "b"], ["lo"], [])],
                                 "product_id string, description string, features array<string>, "
                                 "image_urls array<string>, high_res_image_urls array<string>")
    r = features.multimodal_features(summary, meta).first()
    assert r.text_content == "Title: T\nCategory: Cat\nDescription: d\nFeatures:\n- a\n- b"
    assert r.image_urls == ["lo"] and r.has_text and r.has_image


def test_batch_topk_equals_single(spark):
    pts = roles.table(spark, SF_SMALL, "embeddings")
    cents = search.centroids(pts, by=["label"]).select(F.col("label").alias("query_id"), F.col("centroid").alias("query_vec"))
    batch = search.topk_batch(pts, cents, k=3, id_col="vec_id", block_bytes=4096, slots=(3, 2))  # many blocks
    for row in cents.collect():
        single = [r.vec_id for r in search.topk_exact(pts, row.query_vec, k=3, id_col="vec_id").collect()]
        got = [r.vec_id for r in batch.where(F.col("query_id") == row.query_id).orderBy("rank").collect()]
        assert got == single


def test_upsert_keeps_newest(spark):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "point_id long, version int, label string")
    upd = spark.createDataFrame([(2, 2, "B"), (3, 2, "c")], "point_id long, version int, label string")
    got = sorted(tuple(r) for r in search.upsert(base, upd).collect())
    assert got == [(1, 1, "a"), (2, 2, "B"), (3, 2, "c")]
    again = sorted(tuple(r) for r in search.upsert(search.upsert(base, upd), upd).collect())
    assert again == got


def test_injected_text_encoder(spark):
    import numpy as np

    def factory():
        return lambda texts: np.array([[len(t), 1.0, 0.0] for t in texts])

    df = spark.createDataFrame([(1, "abcd"), (2, None)], "id long, text string")
    rows = {r.id: r for r in embed.embed_text(df, "text", ["id"], encoder_factory=factory, model_name="len3").collect()}
    assert rows[1].embedding_dimension == 3 and rows[1].embedding_model == "len3"
    assert abs(sum(x * x for x in rows[1].embedding) - 1.0) < 1e-6


def test_image_fetch_failures_are_rows(spark):
    calls = {}

    def fetch(url):
        calls[url] = calls.get(url, 0) + 1
        if "bad" in url:
            raise OSError("down")
        return b"\x00\x01\x02"

    tasks = spark.createDataFrame([(1, "http://x/ok"), (2, "http://x/bad")], "id long, image_url string")
    rows = {r.id: r for r in embed.embed_images(tasks, ["id"], fetch=fetch, threads=2, retries=2).collect()}
    assert rows[1].success and rows[1].embedding_dimension == 256
    assert not rows[2].success and rows[2].error == "OSError: down" and rows[2].embedding is None


def test_enriched_search_defaults(spark):
    hits = spark.createDataFrame([(1, "p1", 0.9), (2, "p2", 0.8)], "rank int, canonical_product_id string, score double")
    summary = spark.createDataFrame([("p1", "T1")], "canonical_product_id string, title string")
    stats = spark.createDataFrame([("p1", 3, 4.5, 1, 0.33)],
                                  "canonical_product_id string, review_count long, avg_rating double, "
                                  "verified_review_count long, verified_review_ratio double")
    rows = {r.canonical_product_id: r for r in search.enriched_search(hits, summary, stats).collect()}
    assert rows["p2"].review_count == 0 and rows["p2"].verified_review_ratio == 0.0 and rows["p2"].avg_rating is None
    assert rows["p1"].title == "T1" and rows["p1"].review_count == 3


def test_write_routed_single_pass(spark, tmp_path):
    r = roles.reviews(spark, SF_SMALL, rating_mod=7)
    keys = silver.product_key_set(roles.product_keys(spark, SF_SMALL), asin="p_partkey")
    flagged = silver.flag_reviews(r, keys, asin="product_key")
    out = str(tmp_path / "reviews")
    first = silver.write_routed(flagged, out, run_id="r1")
    again = silver.write_routed(flagged, out, run_id="r1")  # re-run overwrites its own partition only
    back = spark.read.parquet(out)
    assert back.count() == r.count() == first["rows"] == again["rows"]
    assert first["silver"] + first["quarantine"] == first["rows"]
    assert back.where("_route = 'silver'").count() == first["silver"]
    assert {x[0] for x in back.select("_route").distinct().collect()} == {"silver", "quarantine"}


def test_argument_checks(spark):
    import pytest

    pts = roles.table(spark, SF_SMALL, "embeddings")
    with pytest.raises(ValueError):
        search.topk_exact(pts, [1.0] * 64, k=0, id_col="vec_id")
    with pytest.raises(ValueError):
        embed.embed_query(spark, "   ")
    with pytest.raises(ValueError):
        embed.embed_text(pts, "label", ["vec_id"], batch_size=0)


def test_sinks_count_rows_in_the_write(spark, tmp_path):
    import json
    import os

    import pytest

    from lakeloom.sources import sinks

    df = spark.range(100).withColumn("error", F.lit("x"))
    assert sinks.write_parquet(df, str(tmp_path / "t")) == 100
    assert sinks.write_quarantine(df.select("error", F.col("id").alias("record")), str(tmp_path / "q"), "r1",
                                  "reviews") == 100
    assert sinks.publish(spark, str(tmp_path / "t"), str(tmp_path / "p")) == 100
    with pytest.raises(FileNotFoundError):
        sinks.publish(spark, str(tmp_path / "missing"), str(tmp_path / "p2"))
    sinks.write_report(spark.createDataFrame([("PASS", 3)], "status string, n long"), str(tmp_path / "rep"))
    part = [f for f in os.listdir(tmp_path / "rep") if f.endswith(".json")]
    assert json.loads(open(tmp_path / "rep" / part[0]).read()) == {"status": "PASS", "n": 3}


def test_stream_equals_batch(spark):
    from lakeloom.plans import catalog

    streamed = catalog.QUERIES["x1_stream_ingest"](spark, SF_SMALL)
    batch = catalog.QUERIES["i1_raw_objects"](spark, SF_SMALL)
    # same events (the stream input repeats some lines and uses another fault rule)
    assert streamed.count() == streamed.select("event_id").distinct().count()
    assert streamed.join(batch, "event_id", "left_anti").where("event_id % 50 NOT IN (7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47)").count() == 0


def test_hot_key_third_of_rows(spark):
    """One product holds a third of all reviews and of all product rows:
    results stay whole and equal across partitionings."""
    n = 3000
    reviews = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 97).cast("string")))
        .alias("asin"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
        (F.col("id") % 2 == 0).alias("verified"),
        F.lit("text").alias("review_text"),
        F.array(F.lit("u")).alias("image_urls"),
        F.concat(F.lit("R"), (F.col("id") % 7).cast("string")).alias("reviewer_id"),
    )
    products = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 97).cast("string")))
        .alias("asin"),
        F.concat(F.lit("id"), F.col("id").cast("string")).alias("product_id"),
        F.col("id").alias("seq"),
    )
    mapping = resolve.entity_mapping(products, order_by="seq")
    assert mapping.count() == 300
    linked = resolve.attach_canonical(reviews, mapping)
    assert linked.count() == n
    a = sorted(gold.product_review_stats(linked).collect())
    b = sorted(gold.product_review_stats(linked.repartition(13)).collect())
    assert a == b
    hot = [r for r in a if r.canonical_product_id == "id0"][0]
    assert hot.review_count == n // 3


def test_stream_ingest_routes_like_batch(spark, tmp_path):
    from lakeloom.operators.ingest import ingest
    from lakeloom.plans.q_ingest import _review_lines
    from lakeloom.streaming.ingest import stream_ingest

    lines = _review_lines(spark, SF_SMALL)
    lines.write.text(str(tmp_path / "in"))
    q = stream_ingest(spark, str(tmp_path / "in"), "reviews", str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = ingest(lines, "reviews")
    assert out.count() == batch.count()
    got = {r["_route"]: r["n"] for r in out.groupBy("_route").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got["silver"] == batch.where("error IS NULL").count()
    assert sorted(r[0] for r in out.select("error").distinct().collect() if r[0]) == \
        sorted(r[0] for r in batch.select("error").distinct().collect() if r[0])


def test_text_search_matches_brute_force(spark):
    """s6 against an exhaustive numpy search on the smallest fixture."""
    import numpy as np

    from lakeloom.plans import catalog

    got = catalog.QUERIES["s6_text_search"](spark, SF_SMALL).collect()
    docs = embed.embed_text(roles.table(spark, SF_SMALL, "documents"), "text", ["doc_id"]).collect()
    bench = embed.embed_text(roles.table(spark, SF_SMALL, "benchmark"), "text", ["item_id"]).collect()
    ids = np.array([r.doc_id for r in docs])
    m = np.array([r.embedding for r in docs], dtype=np.float64)
    m /= np.where(np.linalg.norm(m, axis=1) == 0, 1, np.linalg.norm(m, axis=1))[:, None]
    for q in bench:
        v = np.array(q.embedding, dtype=np.float64)
        scores = m @ (v / np.linalg.norm(v))
        order = sorted(range(len(ids)), key=lambda i: (-round(scores[i], 9), ids[i]))[:3]
        want = [int(ids[i]) for i in order]
        have = [r.doc_id for r in sorted((r for r in got if r.query_id == q.item_id), key=lambda r: r.rank)]
        assert have == want, q.item_id


def test_batch_topk_of_null_zero_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40, 0, -1)] + [(50, [0.0, 0.0]), (51, None), (52, [-1.0, 0.0])]
    pts = spark.createDataFrame(rows, "point_id long, embedding array<double>").repartition(5)
    qs = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0])], "query_id long, query_vec array<double>")
    top = lambda k, p=pts, q=qs: [tuple(r) for r in search.topk_batch(p, q, k=k, block_bytes=64, slots=(2, 3)).orderBy("query_id", "rank").collect()]
    got = top(3)
    assert got == [(1, i, i, 1.0) for i in (1, 2, 3)] + [(3, i, i, 0.0) for i in (1, 2, 3)]
    last = [r[2:] for r in top(100) if r[0] == 1][-3:]
    single = [(r.point_id, r.score) for r in search.topk_exact(pts, [2.0, 0.0], k=100).orderBy("rank").collect()][-3:]
    assert last == single == [(50, 0.0), (52, -1.0), (51, None)]
    assert top(3, q=qs.limit(0)) == [] and top(3, p=pts.limit(0)) == []


def test_batch_topk_of_ten_thousand_queries(spark):
    pts = spark.range(300).select(F.col("id").alias("point_id"), F.array(F.cos("id"), F.sin("id")).alias("embedding"))
    qs = spark.range(10_000).select(F.col("id").alias("query_id"), F.array(F.cos(F.col("id") % 300), F.sin(F.col("id") % 300)).alias("query_vec"))
    got = search.topk_batch(pts, qs, k=2, block_bytes=16_384, slots=(4, 1))
    best = got.where((F.col("rank") == 1) & (F.col("point_id") == F.col("query_id") % 300))
    assert got.count() == 20_000 and best.count() == 10_000


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_keys_are_split(spark, tmp_path):
    """Half the reviews and half the products share one key: AQE must split that partition in every join."""
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    spark.range(60_000).select("id", key.alias("asin"), F.sha2(F.col("id").cast("string"), 256).alias("body"), F.lit(3.0).alias("rating")).repartition(8).write.parquet(f"{tmp_path}/r")
    rows = spark.read.parquet(f"{tmp_path}/r")
    old = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        mapping = rows.select("asin", F.col("id").alias("canonical_product_id"))
        for name, df in {
            "flag_reviews": silver.flag_reviews(rows, silver.product_key_set(rows)),
            "attach_canonical": resolve.attach_canonical(rows, mapping),
            "entity_mapping": resolve.entity_mapping(rows, product_id="id", order_by="id"),
        }.items():
            assert len(df.collect()) == 60_000
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
