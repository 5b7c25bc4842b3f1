"""Raw-line parsing and normalization edge cases (FIXTURES.md sections 1-2)."""

from pyspark.sql import functions as F
from shared import lines_df

from lakeloom.operators.ingest import ingest, normalize_products, normalize_reviews
from lakeloom.sources.raw import parse_records, split_records


def _errors(spark, lines):
    parsed = parse_records(lines_df(spark, lines))
    return {r["line"]: r["parse_error"] for r in parsed.collect()}


def test_parse_errors(spark):
    e = _errors(spark, ["", "   ", "{bad", "[1,2]", '[{"asin":"A"}]', '{"asin":"A"} junk', '{"asin":"A"}', '"s"',
                        '{"x": NaN}'])
    assert "" not in e and "   " not in e  # blank lines skipped
    assert e["{bad"] == "malformed_json"
    assert e['{"asin":"A"} junk'] == "malformed_json"
    assert e["[1,2]"] == "not_object"
    assert e['[{"asin":"A"}]'] == "not_object"
    assert e['"s"'] == "not_object"
    assert e['{"asin":"A"}'] is None
    assert e['{"x": NaN}'] == "malformed_json"


def _products(spark, lines):
    parsed = parse_records(lines_df(spark, lines)).where("parse_error IS NULL")
    return [r.asDict() for r in normalize_products(parsed, keep=("line",)).orderBy("line").collect()]


def test_product_asin_rules(spark):
    rows = {r["line"]: r for r in _products(spark, [
        '{"title":"t"}', '{"asin":null}', '{"asin":"  "}', '{"asin":5}', '{"asin":" A1\\u00a0"}',
        '{"asin":"A","asin":"B"}'])}
    assert rows['{"title":"t"}']["error"] == "missing_asin"
    assert rows['{"asin":null}']["error"] == "missing_asin"
    assert rows['{"asin":"  "}']["error"] == "missing_asin"
    assert rows['{"asin":5}']["asin"] == "5"
    assert rows['{"asin":" A1\\u00a0"}']["asin"] == "A1"
    assert rows['{"asin":"A","asin":"B"}']["asin"] == "B"  # last duplicate key wins
    import hashlib

    assert rows['{"asin":5}']["product_id"] == "prod_" + hashlib.sha256(b"5").hexdigest()[:24]


def test_product_values(spark):
    line = ('{"asin":"A","title":"\\t Big  \\u00a0","price":"$1,019.99","feature":["a"," ",null,"b "],'
            '"imageURL":" u ","category":["x","y"],"description":[],"similar_item":"s"}')
    (r,) = _products(spark, [line])
    assert r["title"] == "Big"
    assert r["price"] == 1019.99
    assert r["features"] == ["a", "b"]
    assert r["image_urls"] == ["u"]
    assert r["category"] == "x > y"
    assert r["description"] is None
    assert r["similar_items"] == ["s"]
    assert r["also_buy"] == []


def test_prices(spark):
    cases = {'""': None, '"$5 - $9"': None, '"nan"': "nan", '"5d"': None, '"1_000"': None, 'true': 1.0,
             '" $ 5 "': 5.0, '"1e3"': 1000.0, '7': 7.0, '"abc"': None, '[1]': None}
    lines = [f'{{"asin":"A{i}","price":{v}}}' for i, v in enumerate(cases)]
    rows = {r["asin"]: r["price"] for r in _products(spark, lines)}
    for i, (v, want) in enumerate(cases.items()):
        got = rows[f"A{i}"]
        if want == "nan":
            assert got != got
        else:
            assert got == want, (v, got)


def _reviews(spark, lines):
    parsed = parse_records(lines_df(spark, lines)).where("parse_error IS NULL")
    return [r.asDict() for r in normalize_reviews(parsed, keep=("line",)).collect()]


BASE = {"asin": '"A"', "reviewerID": '"R"', "unixReviewTime": "1400000000", "overall": "5.0"}


def _line(**kw):
    d = dict(BASE)
    d.update(kw)
    return "{" + ",".join(f'"{k}":{v}' for k, v in d.items() if v is not None) + "}"


def test_review_error_order(spark):
    cases = [
        (_line(asin=None), "missing_asin"),
        (_line(reviewerID=None), "missing_reviewer_id"),
        (_line(unixReviewTime=None), "missing_review_timestamp"),
        (_line(unixReviewTime='"x"'), "invalid_review_timestamp"),
        (_line(overall='"abc"'), "missing_rating"),
        (_line(overall="-1"), "invalid_rating"),
        (_line(overall="5.5"), "invalid_rating"),
        (_line(asin=None, overall="9"), "missing_asin"),
        (_line(overall="0"), None),
        (_line(unixReviewTime="1.9e9"), None),
    ]
    rows = {r["line"]: r for r in _reviews(spark, [c for c, _ in cases])}
    for line, want in cases:
        assert rows[line]["error"] == want, line
    assert rows[_line(unixReviewTime="1.9e9")]["review_timestamp"] == 1900000000


def test_review_values(spark):
    import hashlib

    cases = {
        "v1": _line(vote='"1,234"', style='{"b":1,"a":"x"}'),
        "v2": _line(vote='""', style="{}"),
        "v3": _line(vote='"x"', style='"s"'),
        "v4": _line(vote="3"),
        "v5": _line(vote="3.5", verified="true", image='["u", " ", null]'),
    }
    rows = {r["line"]: r for r in _reviews(spark, list(cases.values()))}
    assert rows[cases["v1"]]["vote"] == 1234
    assert rows[cases["v1"]]["style"] == '{"a": "x", "b": 1}'
    assert rows[cases["v2"]]["vote"] is None and rows[cases["v2"]]["style"] == "{}"
    assert rows[cases["v3"]]["vote"] is None and rows[cases["v3"]]["style"] is None
    assert rows[cases["v4"]]["vote"] == 3
    assert rows[cases["v5"]]["vote"] is None
    assert rows[cases["v5"]]["verified"] is True
    assert rows[cases["v5"]]["image_urls"] == ["u"]
    fp = "|".join(["R", "A", "1400000000", "5.0", "", ""])
    assert rows[cases["v4"]]["review_id"] == "rev_" + hashlib.sha256(fp.encode()).hexdigest()[:32]


def test_rating_zero_shares_fingerprint_with_missing(spark):
    a = _line(overall="0")
    b = _line(overall="0.0")
    rows = {r["line"]: r for r in _reviews(spark, [a, b])}
    import hashlib

    fp = "|".join(["R", "A", "1400000000", "", "", ""])
    want = "rev_" + hashlib.sha256(fp.encode()).hexdigest()[:32]
    assert rows[a]["review_id"] == want == rows[b]["review_id"]


def test_ingest_routes_every_line(spark):
    lines = ["{bad", "", _line(), _line(asin=None), "[1]"]
    out = ingest(lines_df(spark, lines), "reviews")
    errs = sorted((r["error"] or "") for r in out.collect())
    assert errs == ["", "malformed_json", "missing_asin", "not_object"]


def test_read_lines_gzip(spark, tmp_path):
    import gzip

    from lakeloom.sources.raw import read_lines

    p = tmp_path / "reviews.json.gz"
    with gzip.open(p, "wt", encoding="utf-8") as f:
        f.write('{"asin":"A","reviewerID":"R","unixReviewTime":1,"overall":5.0}\n\n{bad\n')
    out = ingest(read_lines(spark, str(p), partitions=2), "reviews")
    rows = sorted((r["error"] or "", r["seq"]) for r in out.collect())
    assert [e for e, _ in rows] == ["", "malformed_json"]
    assert all(r["source_file"].endswith("reviews.json.gz") for r in out.collect())


def test_head_counts_only_good_records(spark):
    from lakeloom.sources.raw import head

    lines = ["{bad", '{"a":1}', "", '{"a":2}', "[1]", '{"a":3}']
    good, _ = split_records(parse_records(lines_df(spark, lines)))
    got = [r["line"] for r in head(good, 2).collect()]
    assert got == ['{"a":1}', '{"a":2}']


def test_more_input_is_spread_over_more_tasks(spark, tmp_path):
    from lakeloom.sources import raw

    spark.range(60).repartition(30).selectExpr("cast(id as string) as value").write.text(str(tmp_path / "many"))
    lines = raw.read_lines(spark, str(tmp_path / "many"))
    assert raw.spread(lines).rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, raw.TASKS_A_SPLIT * lines.rdd.getNumPartitions())
    assert raw.spread(lines, 3).rdd.getNumPartitions() == 3


def test_a_line_is_parsed_once(spark):
    lines = {'{"a":{"b":1}}': None, '{"a":{}}{"b":2}': "malformed_json", '{"a":{}},{"b":2}': "malformed_json", '{"a":{}} x': "malformed_json",
             ' {"a":"}"} ': None, '[{}]': "not_object", '{"a":{}': "malformed_json", '1]': "malformed_json", '1,2': "malformed_json", '"}"': "not_object", "5": "not_object"}
    parsed = parse_records(lines_df(spark, list(lines)))
    assert parsed._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
    got = {r["line"]: (r["parse_error"], r["record"]) for r in parsed.selectExpr("line", "parse_error", "to_json(record) record").collect()}
    assert {k: e for k, (e, _) in got.items()} == lines
    assert got['{"a":{"b":1}}'][1] == '{"a":{"b":1}}' and got[' {"a":"}"} '][1] == '{"a":"}"}'
    assert all(r is None for e, r in got.values() if e)


def test_generated_methods_can_be_compiled(spark):
    """The JVM never compiles a method over 8,000 bytes and makes no optimized code of one with some 50 arguments or more."""
    import re

    out = ingest(lines_df(spark, [_line()]), "reviews")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(out._jdf.queryExecution().executedPlan())
    for i in range(stages.size()):
        source, stats = stages.apply(i)._2(), stages.apply(i)._3()
        arguments = [a.count(",") + 1 for a in re.findall(r"void \w+_doConsume_\d+\(([^)]*)\)", source)]
        assert max(arguments, default=0) <= 40, arguments
        assert stats.maxMethodCodeSize() < 8000


def test_json_text_and_type_match_the_variant(spark):
    from lakeloom.functions import values as V

    texts = ['""', '" "', '"a"', '"q\\"x"', '"b\\\\s"', '"\\u00e9"', '"é"', '"\\ud83d\\ude00"', '"a\\nb"', '"/"', '"Infinity"', '"-Infinity"', '"NaN"', "1e999", "-1e999",
             "0", "-1", "5.0", "1e-7", "123456789012345678901", "true", "false", "null", "[]", "{}", "[1]", '{"a":1}', '"null"', '"{}"']
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", F.parse_json("x").alias("v"))
    df = df.unionByName(df.limit(1).selectExpr("'none' x", "variant_get(v, '$.none', 'variant') v"))
    df = df.select("x", "v", F.to_json("v").alias("j")).withColumn("b", F.ascii("j"))
    got = df.select("x", V.json_text("v", "j").alias("s"), V.variant_text("v").alias("want"), V.json_type("v", "j", "b").alias("t"), V.vtype("v").alias("type")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert r["s"] == r["want"] and r["t"] == r["type"], r
