"""Column functions: Python text, number and JSON-type semantics."""

import math

from pyspark.sql import functions as F

from lakeloom.functions import text as TX
from lakeloom.functions import values as V
from lakeloom.functions import vectors as VX


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_strip_matches_python(spark):
    samples = ["\t a \n", " b　", "\x1cc\x1f", "​z​", "  ", "", "x", " y ", "\x85q\x0b"]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r[0] for r in df.select(TX.strip("x")).collect()]
    assert got == [s.strip() for s in samples]


def test_whitespace_class_is_python_isspace():
    assert sorted(TX.WS_CHARS) == [chr(i) for i in range(0x110000) if chr(i).isspace()]


def test_clean_string_and_normalize(spark):
    df = spark.createDataFrame([(" a  b\t\nc ",), ("   ",), (None,)], "x string")
    rows = df.select(TX.clean_string("x").alias("c"), TX.normalize_text("x").alias("n"),
                     TX.normalize_lower("x").alias("l")).collect()
    assert rows[0]["c"] == "a  b\t\nc" and rows[0]["n"] == "a b c"
    assert rows[1]["c"] is None and rows[1]["n"] == ""
    assert rows[2]["c"] is None and rows[2]["n"] == ""


def test_parse_float_text_python_rules(spark):
    cases = {"5": 5.0, " 5 ": 5.0, "$1,019.99": 1019.99, "5d": None, "5f": None, "1e3": 1000.0, ".5": 0.5,
             "inf": math.inf, "-Infinity": -math.inf, "abc": None, "": None, "5 - 9": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r["x"]: r["v"] for r in df.select("x", V.parse_float_text("x").alias("v")).collect()}
    for k, want in cases.items():
        assert got[k] == want, k


def test_value_type_and_is_empty(spark):
    cases = {"null": ("null", True), "true": ("bool", False), "5": ("int", False), "5.0": ("float", False),
             "5e0": ("float", False), "123456789012345678901": ("int", False), '"x"': ("string", False),
             '"  "': ("string", True), "[]": ("list", True), "[null]": ("list", False), "{}": ("dict", True),
             '{"a":1}': ("dict", False)}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    v = F.parse_json("x")
    got = {r["x"]: (r["t"], r["e"]) for r in df.select("x", V.value_type(v).alias("t"), V.is_empty(v).alias("e")).collect()}
    assert got == cases


def test_json_spaced(spark):
    assert _one(spark, TX.json_spaced(F.col("x")), '{"a":"x, y: z","b":[1,2],"c":{"d":null}}') == \
        '{"a": "x, y: z", "b": [1, 2], "c": {"d": null}}'


def test_safe_percentage(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "n long, d long")
    got = [r[0] for r in df.select(V.safe_percentage("n", "d")).collect()]
    assert got == [33.3333, 0.0]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0])], "a array<float>, b array<float>")
    r = df.select(VX.dot("a", "b").alias("d"), VX.norm("a").alias("n"), VX.l2_normalize("a").alias("u")).first()
    assert r["d"] == 3.0 and r["n"] == 5.0
    assert [round(x, 6) for x in r["u"]] == [0.6, 0.8]


def test_timestamp_follows_python_int(spark):
    cases = {"1400000000.5": 1400000000, "1400000000": 1400000000, "1.5e9": 1500000000, '"1400000000"': 1400000000,
             "-3.7": -3, "true": 1, '"x"': None, '"1.5"': None, "[1]": None, "123456789012345678901": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r["x"]: r["s"] for r in df.select("x", V.parse_timestamp(F.parse_json("x"))[0].alias("s")).collect()}
    assert got == cases


def test_floats_print_as_python_prints_them(spark):
    from lakeloom.functions.values import float_text

    values = [0.0, -0.0, 4.5, 1e7, 1.4e9, -1400000000.25, 123456789012345.67, 1e16, 1.5e16, 1.25e300, 1e-3, 1e-4, 0.00012345678901234567, 1e-5, -2.5e-7, 1e-12, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", float_text("v").alias("t"))
    assert [r.t for r in df.collect()] == [str(v) for v in values]


def test_strip_by_name_is_python_strip(spark):
    samples = ["", " ", "a", "a ", " a", "\u3000a", "a\u2009", "\x7fa\x7f", "é", "é ", "~!", "a b", "\x1f~", None]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [tuple(r) for r in df.select(TX.strip("x"), TX.strip(F.col("x"))).collect()]
    assert got == [(None, None) if s is None else (s.strip(), s.strip()) for s in samples]


def test_json_numbers_match_the_variant_cast(spark):
    texts = ["0", "-0.0", "5.0", "1.50", "100.0", "0.1", "1e999", "-1e999", "1e-7", "1.9e9", "123456789012345678901", "9007199254740993", "0.30000000000000004441", "true", "false", "null", '"5"', "[]", "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", F.parse_json("x").alias("v"))
    for r in df.select("x", V.json_number("v").alias("n"), F.try_variant_get("v", "$", "double").alias("m")).collect():
        assert r["n"] == r["m"] or r["x"] == '"5"', r
    ints = df.where(V.vtype("v") == "BIGINT")
    assert ints.where(~V.json_int("v").eqNullSafe(F.try_variant_get("v", "$", "bigint"))).count() == 0 and ints.count() == 2
