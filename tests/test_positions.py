"""Source order across files and splits, the key guard, the review stream's state."""

import gzip
import itertools
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shared import SF_SMALL

from lakeloom.operators import resolve
from lakeloom.sources import raw
from lakeloom.streaming import dedupe


@pytest.fixture
def files(tmp_path):
    want = []
    for name, n in (("a.txt", 400), ("b.txt.gz", 300), ("c.txt", 0), ("d.txt", 250)):
        lines = [f"{name} line {i} " + "x" * (i * 7 % 90) for i in range(n)]
        data = "".join(x + "\n" for x in lines).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
        want += [(name, i, x) for i, x in enumerate(lines)]
    return str(tmp_path), want


@pytest.mark.parametrize(("size", "cost"), list(itertools.product(["300", "5000", "128m"], ["0", "4m"])))
def test_order_and_line_numbers_do_not_depend_on_splits(spark, files, size, cost):
    path, want = files
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        lines = raw.with_line_numbers(raw.read_lines(spark, path)).withColumn("name", F.regexp_extract("source_file", "([^/]*)$", 1))
        got = [(r.name, r.line_no, r.line) for r in lines.repartition(7).orderBy(*raw.POSITION).collect()]
        assert got == want
        assert [r.line for r in raw.head(lines, 410).collect()] == [x for _, _, x in want[:410]]
        keyed = lines.withColumn("asin", F.length("line"))
        first = {}
        for name, i, x in want:
            first.setdefault(len(x), (name, i))
        assert {r.asin: (r.name, r.line_no) for r in resolve.canonical_products(keyed.repartition(5)).collect()} == first
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_missing_keys_fail_inside_the_job_or_come_back_unresolved(spark):
    good = [(1, "A"), (2, "A"), (3, "B")]
    schema = "product_id long, asin string"
    df = spark.createDataFrame(good, schema)
    assert resolve.entity_mapping(df, order_by="product_id").count() == 3
    for bad in (None, "", " \t "):
        rows = spark.createDataFrame([*good, (4, bad), (5, bad)], schema)
        with pytest.raises(PySparkException, match="missing asin"):
            resolve.entity_mapping(rows, order_by="product_id").collect()
        with pytest.raises(PySparkException, match="missing asin"):
            resolve.canonical_ids(resolve.guarded(rows), order_by="product_id").collect()
        got = sorted(tuple(r) for r in resolve.entity_mapping(rows, order_by="product_id", on_missing="unresolved").collect())
        assert got[3:] == [(i, None, None, "missing_key", 0.0, "unresolved") for i in (4, 5)]
        assert [r[2] for r in got[:3]] == [1, 1, 3]
    with pytest.raises(ValueError):
        resolve.entity_mapping(df, on_missing="drop")


REVIEWS = "review_id string, review_time timestamp, rating double, tags array<string>, n int"


def deliver(spark, base, rows, known=None):
    """One delivery: a file arrives, the stream starts from its checkpoint, takes it and stops."""
    df = spark.createDataFrame(rows, "review_id string, minute int, rating double, tags array<string>, n int")
    df = df.select("review_id", F.when(F.col("minute").isNotNull(), F.timestamp_seconds(F.col("minute") * 60)).alias("review_time"), "rating", "tags", "n")
    df.write.mode("append").parquet(f"{base}/in")
    arriving = spark.readStream.schema(REVIEWS).parquet(f"{base}/in")
    dedupe.stream_reviews(dedupe.dedupe_reviews(arriving, known, delay="10 minutes", buckets=3), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return sorted(((r.n, r.error, r["_route"]) for r in spark.read.parquet(f"{base}/out").collect()), key=lambda x: (x[0], x[1] or ""))


def test_repeats_across_restarts_late_and_known_rows_are_routed(spark, tmp_path):
    base = str(tmp_path)
    known = spark.createDataFrame([("old",), (None,)], "review_id string")
    got = deliver(spark, base, [("a", 100, 1.5, ["x"], 1), ("b", 101, None, None, 2), ("old", 100, 1.0, [], 3), (None, 100, 1.0, [], 4), ("c", None, 1.0, [], 5)], known)
    assert got == [(1, None, "silver"), (2, None, "silver"), (3, "already_ingested", "quarantine"), (4, "missing_review_id", "quarantine"), (5, "missing_review_timestamp", "quarantine")]
    # a repeat within the watermark; a row before it; a new one that moves it on
    got = deliver(spark, base, [("a", 100, 1.5, ["x"], 6), ("d", 80, 1.0, [], 7), ("e", 200, 1.0, [], 8)], known)
    assert got[5:] == [(6, "duplicate_review", "quarantine"), (7, "late_review", "quarantine"), (8, None, "silver")]
    # a repeat beyond the watermark is late; one id twice in a delivery
    got = deliver(spark, base, [("a", 100, 1.5, ["x"], 9), ("f", 195, 2.0, ["y", None], 10), ("f", 195, 2.0, ["y", None], 10)], known)
    assert got[8:] == [(9, "late_review", "quarantine"), (10, None, "silver"), (10, "duplicate_review", "quarantine")]
    row = spark.read.parquet(f"{base}/out").where("n = 10 AND error IS NULL").first()
    assert (row.review_id, row.rating, row.tags) == ("f", 2.0, ["y", None]) and str(row.review_time) == "1970-01-01 03:15:00"


def test_a_bucket_of_ids_is_small(spark):
    """A worker holds a whole bucket's ids: sf0.001 has 6,000 reviews, the stand-in for any size."""
    from lakeloom.plans import catalog
    from lakeloom.session import checkpoint_dir

    folder = Path(checkpoint_dir(spark))
    before = set(folder.glob("x2-*"))
    catalog.QUERIES["x2_stream_review_dedupe"](spark, SF_SMALL)
    (mine,) = set(folder.glob("x2-*")) - before
    state = spark.read.format("statestore").load(f"{mine}/checkpoint")
    ids, largest = state.agg(F.sum(F.size("value.groupState.ids")), F.max(F.size("value.groupState.ids"))).first()
    assert ids > 500 and largest <= 20


def test_state_holds_the_watermark_window_only():
    class State:
        exists, value, watermark = False, None, 0

        @property
        def get(self):
            return self.value

        def getCurrentWatermarkMs(self):
            return self.watermark

        def update(self, value):
            self.exists, self.value = True, value

    import pandas as pd

    state = State()
    chunk = lambda ids, ms: iter([pd.DataFrame({"id": ids, "ms": ms, "error": [None] * len(ids), "payload": ids})])
    list(dedupe._judge((0,), chunk(["a", "b"], [10, 50]), state))
    state.watermark = 40
    got = pd.concat(dedupe._judge((0,), chunk(["b", "a", "c"], [50, 10, 45]), state))
    assert got["error"].tolist() == ["duplicate_review", "late_review", None]
    assert state.value == (["b", "c"], [50, 45])
