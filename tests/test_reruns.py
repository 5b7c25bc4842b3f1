"""Re-runs that must not leave or hide anything."""

import pytest

from lakeloom.operators import embed, search, silver
from lakeloom.sources import sinks


def test_rerun_without_bad_rows_clears_the_old_quarantine(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = spark.createDataFrame([(1, None), (2, "bad")], "id int, error string")
    assert silver.write_routed(rows, path, "r1")["quarantine"] == 1
    assert silver.write_routed(rows.where("error IS NULL"), path, "r2")["quarantine"] == 0
    assert silver.write_routed(rows.where("error IS NULL"), path, "r1")["quarantine"] == 0
    back = spark.read.parquet(path)
    assert sorted((r.id, r.run_id) for r in back.collect()) == [(1, "r1"), (1, "r2")]


def test_quarantine_file_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "quarantine")
    bad = spark.createDataFrame([("e", "r")], "error string, record string")
    assert sinks.write_quarantine(bad, path, "r1", "reviews") == 1
    assert sinks.write_quarantine(bad.where("error = 'x'"), path, "r1", "reviews") == 0
    assert spark.read.schema("error string, record string").json(path).count() == 0


def test_resume_does_not_take_a_read_error_for_a_first_run(spark, tmp_path):
    path = tmp_path / "out"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet at all")
    todo = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(Exception):
        embed.run_resumable(todo, "id", lambda df: df, str(path), 1)
    assert not [p for p in path.iterdir() if p.is_dir()]


def test_zero_vectors_score_zero(spark):
    points = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "point_id long, embedding array<float>")
    got = {r.point_id: r.score for r in search.topk_exact(points, [1.0, 0.0], 2).collect()}
    assert got == {1: 0.0, 2: 1.0}


def test_a_killed_run_keeps_the_parts_it_has_finished(spark, tmp_path):
    out = str(tmp_path / "out")
    todo = spark.range(100).withColumnRenamed("id", "key")
    left = [2]

    def job(df):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        return df

    with pytest.raises(KeyboardInterrupt):
        embed.run_resumable(todo, "key", job, out, run_id=1, parts=4)
    kept = {r.key for r in spark.read.parquet(out).collect()}
    assert 0 < len(kept) < 100
    left[0] = 4
    latest = embed.run_resumable(todo, "key", job, out, run_id=2, parts=4).collect()
    assert len(latest) == 100 and {r.key for r in latest if r.run_id == 1} == kept


def test_models_of_two_names_do_not_mix(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, text string")
    first = embed.embed_text(df, "text", ["id"], dim=2, encoder_factory=lambda: lambda ts: [[1.0, 0.0]] * len(ts), model_name="x")
    second = embed.embed_text(df, "text", ["id"], dim=2, encoder_factory=lambda: lambda ts: [[0.0, 1.0]] * len(ts), model_name="y")
    assert [list(d.first().embedding) for d in (first, second)] == [[1.0, 0.0], [0.0, 1.0]]


def test_of_several_metadata_rows_the_last_one_stays(spark):
    from lakeloom.operators import features

    summary = spark.createDataFrame([(1, "a", "t", "b", "m", 1.0)], "canonical_product_id long, asin string, title string, brand string, main_category string, price double")
    meta = spark.createDataFrame([(1, 1, "zz"), (1, 2, "aa")], "product_id long, seq long, description string").selectExpr(
        "*", "cast(null as array<string>) as features", "cast(null as array<string>) as image_urls", "cast(null as array<string>) as high_res_image_urls")
    text = lambda **kw: features.multimodal_features(summary, meta, **kw).first().text_content
    assert "Description: aa" in text(order_by="seq") and "Description: zz" in text()


def test_head_goes_file_by_file(spark):
    from lakeloom.sources.raw import head

    rows = spark.createDataFrame([("b", 1), ("a", 7), ("a", 5)], "source_file string, seq long")
    assert [tuple(r) for r in head(rows, 2).collect()] == [("a", 5), ("a", 7)]
    assert [r.seq for r in head(rows, 1, "seq").collect()] == [1]
    with pytest.raises(ValueError):
        head(rows.drop("seq", "source_file").selectExpr("1 as x"), 1)


def test_a_token_is_hashed_once_in_a_task(monkeypatch):
    """A text's words repeat, and so do those of a task's texts."""
    import hashlib

    import pyarrow as pa

    asked = []

    def md5(token, **kw):
        asked.append(token)
        return hashlib.new("md5", token, **kw)

    monkeypatch.setattr(embed.hashlib, "md5", md5)
    texts = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4], "_text": ["Ab ab\xa0c \x0b ab", None, "", "AB\x1cx ab Ä"]})
    (got,) = embed._hashed(8)(iter([texts]))
    # no-break space, information separators and capitals beyond A-Z belong to tokens as they are
    assert sorted(asked) == sorted(x.encode() for x in ("ab", "ab\xa0c", "ab\x1cx", "Ä"))
    vectors = got.column("_vec").to_pylist()
    assert vectors[1] == vectors[2] == [0.0] * 8 and abs(sum(x * x for x in vectors[0]) - 1) < 1e-6
