"""Commit log, profile store and bounded fetch."""

import os
import threading
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shared import lines_df

from lakeloom.operators import embed, profile, profile_store, runs
from lakeloom.sources.raw import parse_records


def rows(spark, ids, value=0):
    return spark.createDataFrame([(i, value) for i in ids], "id long, value int")


def kept(df):
    return {} if df is None else {r.id: (r.run_id, r.value) for r in df.collect()}


def test_failed_run_keeps_its_buckets_and_resumes_from_staged_rows(spark, tmp_path):
    path, calls = str(tmp_path / "r"), []

    def job(bad):
        def run(df):
            files = df.inputFiles()
            assert all("/staged/" in f for f in files)  # the input itself is read once, when it is staged
            calls.append(len(files))
            boom = F.raise_error(F.lit("boom")).cast("int")
            return df.withColumn("value", F.when(F.col("id") == bad, boom).otherwise(F.col("value") + 1))

        return run

    with pytest.raises(PySparkException, match="boom"):
        runs.run_committed(rows(spark, range(200)), "id", job(7), path, run_id=1, buckets=8)
    part = kept(runs.latest(spark, path, "id"))
    assert 7 not in part and len(part) < 200
    before = len(calls)
    assert kept(runs.run_committed(rows(spark, []), "id", job(None), path, run_id=1, buckets=8)) == {i: (1, 1) for i in range(200)}
    assert before < len(calls) and runs.commits(spark, path).where("bucket >= 0").count() == 8
    calls.clear()
    runs.run_committed(rows(spark, range(200)), "id", job(None), path, run_id=1, buckets=8)
    assert not calls  # all buckets are committed


def test_a_killed_attempts_files_are_not_read(spark, tmp_path):
    path = str(tmp_path / "r")
    runs.run_committed(rows(spark, range(10)), "id", lambda df: df, path, run_id=1, buckets=2)
    location = runs.commits(spark, path).where("n_rows > 0").first().location
    stray = os.path.join(path, os.path.dirname(location), "attempt=killed")
    rows(spark, range(100), 9).withColumn("run_id", F.lit(5).cast("long")).write.parquet(stray)
    assert kept(runs.latest(spark, path, "id")) == {i: (1, 0) for i in range(10)}


def test_compaction_swaps_the_log(spark, tmp_path):
    path = str(tmp_path / "r")
    assert runs.latest(spark, path, "id") is None and runs.compact(spark, path, "id") == 0
    runs.run_committed(rows(spark, range(10)), "id", lambda df: df, path, run_id=1, buckets=2)
    runs.run_committed(rows(spark, range(14), 5), "id", lambda df: df, path, run_id=2, buckets=2)
    want = {i: (1, 0) for i in range(10)} | {i: (2, 5) for i in range(10, 14)}
    assert kept(runs.latest(spark, path, "id")) == want
    assert runs.compact(spark, path, "id") == 14
    assert kept(runs.latest(spark, path, "id")) == want
    assert len([r for r in runs.commits(spark, path).collect() if r.n_rows]) == 1
    # a finished run is still known as done, a new one starts from the compacted rows
    fails = lambda df: 1 / 0
    assert kept(runs.run_committed(rows(spark, range(14)), "id", fails, path, run_id=2, buckets=2)) == want
    more = kept(runs.run_committed(rows(spark, range(16), 7), "id", lambda df: df, path, run_id=3, buckets=2))
    assert more == want | {14: (3, 7), 15: (3, 7)}


# ----------------------------------------------------------- profile store
def test_profiles_of_runs_merge_to_the_profile_of_all(spark, tmp_path):
    lines = [['{"a":1,"b":""}', '{"a":"x"}', '{"c":[]}'], ['{"a":null,"b":"t"}', "{}"], []]
    path = str(tmp_path / "p")
    parsed = lambda xs: parse_records(lines_df(spark, xs)).where("parse_error IS NULL")
    for i, some in enumerate(lines):
        if some:
            profile_store.save_run(path, f"r{i}", parsed(some))
        else:
            profile_store.save_run(path, f"r{i}", parsed(["{}"]).limit(0))
    whole = profile.field_profile(parsed([x for some in lines for x in some]), required=("a", "z"))
    assert profile_store.merged_fields(spark, path, ("a", "z")).collect() == whole.collect()
    one = profile.field_profile(parsed(lines[1]), required=("a", "z"))
    assert profile_store.merged_fields(spark, path, ("a", "z"), runs=["r1", "r2"]).collect() == one.collect()
    profile_store.save_run(path, "r0", parsed(lines[0]))  # a repeated run replaces its own state
    assert profile_store.merged_fields(spark, path, ("a", "z")).collect() == whole.collect()


def test_sketches_stay_within_their_error_and_orphans_are_exact(spark, tmp_path):
    path = str(tmp_path / "p")
    for run in range(3):
        child = spark.range(run * 20_000, run * 20_000 + 40_000).select(F.col("id").alias("k"), F.lit(" text  here ").alias("t"))
        parent = spark.range(run * 20_000, run * 20_000 + 30_000).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("k"))
        profile_store.save_run(path, str(run), tables={"child": (child, ["t"], ["k"]), "parent": (parent.union(spark.sql("SELECT '  '")), [], ["k"])}, exact=True)
    exact = {(r.table_name, r.key_name): (r.n, r.distinct_keys) for r in profile_store.merged_keys(spark, path, exact=True).collect()}
    assert exact == {("child", "k"): (120_000, 80_000), ("parent", "k"): (90_000, 70_000)}
    bound = 4 * 1.04 / 2 ** (profile_store.LG_K / 2)
    for r in profile_store.merged_keys(spark, path).collect():
        n, d = exact[(r.table_name, r.key_name)]
        assert r.n == n and abs(r.distinct_keys - d) <= bound * d
    assert tuple(profile_store.merged_orphans(spark, path, ("child", "k"), ("parent", "k"), exact=True).first()) == (80_000, 10_000)
    guess = profile_store.merged_orphans(spark, path, ("child", "k"), ("parent", "k")).first()
    assert abs(guess.orphans - 10_000) <= 2 * bound * 80_000
    assert tuple(profile_store.merged_texts(spark, path, "child", ["t"]).first()) == (120_000, 9.0)
    assert profile_store.merged_keys(spark, path, exact=True, runs=["0"]).where("table_name = 'child'").first().distinct_keys == 40_000


# ------------------------------------------------------------ bounded fetch
def test_fetching_waits_for_the_one_who_takes(monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    live, most, lock = 0, 0, threading.Lock()

    def work(i):
        nonlocal live, most
        with lock:
            live += 1
            most = max(most, live)
        return i

    got = []
    with ThreadPoolExecutor(8) as pool:
        for i in embed._in_flight(pool, work, range(60), 5):
            time.sleep(0.001)
            with lock:
                live -= 1
            got.append(i)
    assert got == list(range(60)) and most <= 6


def test_slices_are_bounded_by_bytes_and_count(spark):
    sizes = []

    def factory():
        def encode(blobs):
            sizes.append((len(blobs), sum(map(len, blobs))))
            return np.ones((len(blobs), 2))

        return encode

    urls = [f"{n}" for n in [10] * 20 + [500, 10, 2000, 0, 10] + [90] * 30]
    out = embed.embed_images(spark.range(1).select(F.col("id").alias("k"), F.lit("u").alias("image_url")), ["k"], fetch=lambda u: b"x", encoder_factory=factory, batch_size=8, slice_bytes=300, max_bytes=1000)
    body = embed_body(embed.embed_images, spark, factory, lambda u: b"x" * int(u))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(urls))), pa.array(urls)], names=["k", "image_url"])
    rows_out = [r for b in body(iter([batch])) for r in b.to_pylist()]
    assert [r["k"] for r in rows_out] == list(range(len(urls))) and out.count() == 1
    assert max(n for n, _ in sizes) <= 8 and max(b for _, b in sizes) < 300 + 1000
    errors = {urls[r["k"]]: (r["error"], r["attempts"]) for r in rows_out if not r["success"]}
    assert errors == {"2000": ("ValueError: image of 2000 bytes is over 1000", 1), "0": ("ValueError: empty content", 3)}


def embed_body(op, spark, factory, fetch):
    """The function that embed_images hands to mapInArrow."""
    caught = {}

    class Tasks:
        def select(self, *cols):
            return self

        @property
        def schema(self):
            return spark.createDataFrame([], "k long, image_url string").schema

        def mapInArrow(self, run, schema):
            caught["run"] = run

    op(Tasks(), ["k"], fetch=fetch, encoder_factory=factory, model_name="sliced", batch_size=8, slice_bytes=300, max_bytes=1000)
    return caught["run"]
