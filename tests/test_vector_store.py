"""Vector collection and stored index: files, versions, refusals, recall, pruning."""

import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shared import SF_SMALL

from lakeloom.operators import collection as col
from lakeloom.operators import embed, search
from lakeloom.operators import vector_index as vi
from lakeloom.plans import roles

POINTS = "point_id long, embedding array<float>, label int"


def vectors(spark, ids, version=0):
    return spark.createDataFrame([(i, [float(i), float(version)], i + version) for i in ids], POINTS)


def labels(spark, c):
    return {r.point_id: r.label for r in col.read(spark, c).collect()}


def files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_create_if_absent_and_refusals(spark, tmp_path):
    path = str(tmp_path / "c")
    made = col.create_collection(spark, path, 2, "m", {"label": "int"}, buckets=4)
    assert made.version == 0 and col.read(spark, made).count() == 0
    assert col.create_collection(spark, path, 2, "m", {"label": "int"}) == made
    for other in ((3, "m", {"label": "int"}), (2, "n", {"label": "int"}), (2, "m", {})):
        with pytest.raises(ValueError):
            col.create_collection(spark, path, *other)
    with pytest.raises(ValueError):
        col.open_collection(spark, str(tmp_path / "none"))


def test_upsert_writes_touched_buckets_only_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path / "c")
    c = col.create_collection(spark, path, 2, "m", {"label": "int"}, buckets=8)
    c = col.upsert(spark, c, vectors(spark, range(100)), "point_id", version=1)
    before = files(f"{path}/data")
    c2 = col.upsert(spark, c, vectors(spark, [5, 200], 1000), "point_id", version=2)
    assert labels(spark, c2) == {i: i for i in range(100)} | {5: 1005, 200: 1200}
    changed = {b for b in c2.commits if c2.commits[b] != c.commits.get(b)}
    assert 1 <= len(changed) <= 2 and len(files(f"{path}/data") - before) == len(changed)
    assert labels(spark, c) == {i: i for i in range(100)}  # the earlier version stays readable
    again = col.upsert(spark, c2, vectors(spark, [5, 200], 1000), "point_id", version=2)
    late = col.upsert(spark, again, vectors(spark, [5, 7], 500), "point_id", version=0)
    assert labels(spark, again) == labels(spark, late) == labels(spark, c2)
    assert late.version == 4 and col.open_collection(spark, path) == late
    assert col.upsert(spark, late, vectors(spark, []), "point_id") == late
    gone = col.delete(spark, late, spark.createDataFrame([(5,), (6,), (999,)], "point_id long"))
    assert labels(spark, gone) == {i: v for i, v in labels(spark, late).items() if i not in (5, 6)}


def test_wrong_dimension_missing_id_and_lost_races_leave_the_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    c = col.create_collection(spark, path, 2, "m", {"label": "int"}, buckets=4)
    c = col.upsert(spark, c, vectors(spark, range(10)), "point_id", version=1)
    bad = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0], 0)], POINTS)
    with pytest.raises(PySparkException, match="dimension"):
        col.upsert(spark, c, bad, "point_id", version=2)
    with pytest.raises(PySparkException, match="no id"):
        col.upsert(spark, c, spark.createDataFrame([(None, [1.0, 2.0], 0)], POINTS), "point_id", version=2)
    assert col.open_collection(spark, path) == c and labels(spark, c) == {i: i for i in range(10)}
    col.upsert(spark, c, vectors(spark, [1], 10), "point_id", version=2)
    with pytest.raises(col.Conflict):  # it started from the same version
        col.upsert(spark, c, vectors(spark, [2], 10), "point_id", version=2)
    assert labels(spark, col.open_collection(spark, path)) == {i: i for i in range(10)} | {1: 11}


def test_repeated_points_in_one_write_and_text_ids(spark, tmp_path):
    c = col.create_collection(spark, str(tmp_path / "c"), 1, "m", {"name": "string"}, buckets=2)
    rows = [("a", [1.0], "x", 1), ("a", [2.0], "y", 3), ("a", [9.0], "z", 2), ("b", [1.0], None, 1), ("b", [1.0], None, 1)] * 50
    c = col.upsert(spark, c, spark.createDataFrame(rows, "id string, embedding array<float>, name string, v int"), "id", version="v")
    assert sorted((r.version, r.name, list(r.embedding)) for r in col.read(spark, c).collect()) == [(1, None, [1.0]), (3, "y", [2.0])]


# ----------------------------------------------------------------- index
def clustered(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    m = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, 16))
    m[: n // 3] = m[0]  # a third of all vectors are copies of one
    return spark.createDataFrame([(i, [float(x) for x in row], i % 5) for i, row in enumerate(m)], POINTS)


def test_index_finds_nine_tenths_of_all_neighbours(spark, tmp_path):
    pts = clustered(spark, 2000)
    index = vi.build(spark, pts, str(tmp_path / "i"), "point_id", payload=["label"], cells=40)
    assert index.recall >= 0.95 and index.probes < index.cells
    assert vi.points(spark, index).count() == 2000 and set(vi.points(spark, index).columns) == {"point_id", "embedding", "label", "cell"}
    queries = pts.where("point_id % 50 = 0").select(F.col("point_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    exact = search.topk_batch(pts, queries, 10)
    opened = vi.open_index(spark, index.path)
    assert (opened.probes, opened.cells, opened.recall) == (index.probes, index.cells, index.recall)
    total = vi.recall_of(vi.search(spark, opened, queries, 10), exact).agg(F.sum("found"), F.sum("true_hits")).first()
    assert total[1] == 400 and total[0] >= 0.9 * total[1]
    whole = vi.search(spark, opened, queries, 10, probes=opened.cells)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, exact.collect()))


def test_index_of_the_test_vectors_reaches_the_recall_it_measured(spark, tmp_path):
    pts = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = vi.build(spark, pts, str(tmp_path / "i"), "vec_id")
    queries = pts.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))  # every vector
    total = vi.recall_of(vi.search(spark, index, queries, 10), search.topk_batch(pts, queries, 10, id_col="vec_id"), id_col="vec_id").agg(F.sum("found") / F.sum("true_hits")).first()[0]
    assert total >= 0.9 and index.probes < index.cells


def test_search_reads_probed_cells_only(spark, tmp_path):
    index = vi.build(spark, clustered(spark, 600), str(tmp_path / "i"), "point_id", cells=20)
    one = clustered(spark, 600).where("point_id = 599").select(F.col("point_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    plan = vi.search(spark, index, one, 3, probes=1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [(cell" in plan, plan


def test_few_points_widen_the_search(spark, tmp_path):
    rows = [(i, [float(np.cos(i)), float(np.sin(i))], 0) for i in range(30)] + [(30, [0.0, 0.0], 0), (31, None, 0)]
    pts = spark.createDataFrame(rows, POINTS)
    index = vi.build(spark, pts, str(tmp_path / "i"), "point_id", cells=10)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "query_id long, query_vec array<double>")
    got = vi.search(spark, index, queries, 25, probes=1).groupBy("query_id").count().collect()
    assert sorted(map(tuple, got)) == [(1, 25), (3, 25)]
    assert vi.search(spark, index, queries, 100, probes=1).where("query_id = 1").count() == 31
    empty = vi.build(spark, pts.limit(0), str(tmp_path / "e"), "point_id")
    assert vi.search(spark, empty, queries, 3).count() == 0
    with pytest.raises(ValueError):
        vi.build(spark, pts.select("point_id", F.when(F.col("point_id") < 5, F.array(F.lit(1.0))).otherwise(F.col("embedding")).alias("embedding")), str(tmp_path / "x"), "point_id")


def test_cells_come_from_a_bounded_sample_whatever_the_partitioning(spark):
    pts = clustered(spark, 500)
    picked = [sorted(r.point_id for r in vi.sample_by_hash(df, "point_id", 20).collect()) for df in (pts, pts.repartition(9), pts.orderBy(F.desc("point_id")))]
    assert picked[0] == picked[1] == picked[2] and len(picked[0]) == 20


def test_grid_follows_the_sizes():
    assert search.grid(10**9, 10, cell_scores=10**6) == (10000, 1)
    assert search.grid(10**6, 10**6, cell_scores=10**8) == (100, 100)
    p, q = search.grid(4 * 10**6, 10**6, cell_scores=10**8)
    assert p * q >= 4 * 10**4 and 3 < p / q < 5  # both sides are copied about alike
    assert search.grid(0, 0) == (1, 1) and search.grid(5, 1, least=8) == (8, 1)


# --------------------------------------------------------------- encoder
def plain_vector(text, dim):
    import hashlib

    v = np.zeros(dim)
    for t in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" "):
        if t:
            d = hashlib.md5(t.encode()).hexdigest()
            v[int(d[:8], 16) % dim] += 1 if d[8] < "8" else -1
    n = np.linalg.norm(v)
    return v / n if n else v


def test_text_encoder_is_signed_hashing(spark):
    texts = [(1, "The cat the CAT é É"), (2, None), (3, ""), (4, " \t x\x0by z\n"), (5, "word " * 5000)]
    df = spark.createDataFrame(texts, "id long, text string")
    rows = {r.id: r for r in embed.embed_text(df, "text", ["id"], dim=32).collect()}
    for i, t in texts:
        assert np.allclose(rows[i].embedding, plain_vector(t, 32), atol=1e-6) and rows[i].embedding_dimension == 32
    plan = embed.embed_text(df, "text", ["id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert np.allclose(embed.embed_query(spark, "The cat the CAT é É", dim=32), plain_vector(texts[0][1], 32), atol=1e-6)
    with pytest.raises(ValueError):
        embed.embed_query(spark, " \n")


def test_one_text_finds_its_own_document(spark):
    docs = roles.table(spark, SF_SMALL, "documents").where("length(text) > 100")
    text = docs.orderBy("doc_id").first().text
    hits = search.topk_text(embed.embed_text(docs, "text", ["doc_id"]), text, k=3, id_col="doc_id").collect()
    assert hits[0].score == pytest.approx(1.0) and hits[0].rank == 1


def test_a_search_of_all_cells_deals_no_query_to_each_of_them(spark, tmp_path, monkeypatch):
    pts = clustered(spark, 300)
    index = vi.build(spark, pts, str(tmp_path / "i"), "point_id", cells=20)
    queries = pts.where("point_id % 50 = 0").select(F.col("point_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    monkeypatch.setattr(vi, "_probing", lambda *_: pytest.fail("queries are dealt to cells"))
    whole = vi.search(spark, index, queries, 10, probes=index.cells)
    assert whole.columns == ["query_id", "rank", "point_id", "score"]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, search.topk_batch(pts, queries, 10).collect()))


def test_workers_give_freed_memory_back_when_a_task_ends(monkeypatch):
    trimmed = []

    class Libc:
        malloc_trim = staticmethod(trimmed.append)

    monkeypatch.setattr(search.ctypes, "CDLL", lambda _: Libc)
    for run in (search.packed_rows(64), search.best_of_blocks(3), vi._assigned(None), vi._probing(None, 0, 1)):
        assert list(run(iter([]))) == []
    assert len(trimmed) == 4
