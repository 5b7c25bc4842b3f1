"""Value cleaning, typing and key functions over VARIANT and plain columns.

Every function returns a Column built from ``pyspark.sql.functions`` so the
work stays in generated JVM code. Functions taking ``v`` expect a VARIANT
column holding one JSON value (``variant_get(obj, '$.field', 'variant')``);
a missing field is SQL NULL, a JSON ``null`` is a variant null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.text import WS_CLASS, _col, clean_string, strip

# Fixed value: the literal forms Python's float() accepts (underscore digit
# groups excepted, see README), used to refuse forms Spark would also take
# such as '5d' or '5f'.
_FLOAT_TEXT = (
    rf"(?i)^{WS_CLASS}*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?"
    rf"|nan|inf|infinity){WS_CLASS}*$"
)
_INT_TEXT = rf"^{WS_CLASS}*[+-]?[0-9]+{WS_CLASS}*$"


def field(obj, name: str) -> Column:
    """One field of a VARIANT object as VARIANT (NULL when absent)."""
    key = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.variant_get(_col(obj), f"$['{key}']", "variant")


def type_of_schema(sch) -> Column:
    """A schema text up to its first '<' or '('."""
    sch = _col(sch)
    return F.substring_index(F.substring_index(sch, "<", 1), "(", 1)


def vtype(v) -> Column:
    """Top-level type text of a variant: OBJECT, ARRAY, STRING, BIGINT,
    DECIMAL, VOID, ... (the schema text up to its first '<' or '(')."""
    return type_of_schema(F.schema_of_variant(_col(v)))


def value_type(v, sch: Column | None = None, t: Column | None = None) -> Column:
    """Python type name null/bool/int/float/string/list/dict.

    DECIMAL with scale 0 and more than 18 digits comes from a JSON integer
    too long for BIGINT, so it is an int; other decimals come from literals
    such as ``5.0`` and are floats.
    """
    v = _col(v)
    sch = F.schema_of_variant(v) if sch is None else sch
    t = type_of_schema(sch) if t is None else t
    big_int = sch.rlike(r"^DECIMAL\((19|[2-9][0-9]|[1-9][0-9]{2}),0\)$")
    return (
        F.when(v.isNull() | (t == "VOID"), "null")
        .when(t == "BOOLEAN", "bool")
        .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(t == "DECIMAL", F.when(big_int, "int").otherwise("float"))
        .when(t.isin("DOUBLE", "FLOAT"), "float")
        .when(t == "STRING", "string")
        .when(t == "ARRAY", "list")
        .when(t == "OBJECT", "dict")
        .otherwise(F.lower(t))
    )


def json_number(v, j=None) -> Column:
    """The double of a JSON number or boolean. A cast from VARIANT builds a Spark
    expression for every value; the value's JSON text (``j`` where it is at hand) is
    cast for a third of that (what has no plain number text, such as an infinity,
    takes the slow way)."""
    v = _col(v)
    return F.coalesce(_json(v, j).try_cast("double"), F.try_variant_get(v, "$", "double"))


def json_int(v, j=None) -> Column:
    """The bigint of a JSON integer (see ``json_number``)."""
    return _json(v, j).try_cast("bigint")


def _json(v, j=None) -> Column:
    return F.to_json(_col(v)) if j is None else _col(j)


def is_empty(v, t: Column | None = None, sch: Column | None = None, s: Column | None = None) -> Column:
    """None, blank string, empty list or empty dict. Only an array whose
    schema is ARRAY<VOID> can be empty, so other arrays are never converted.
    ``s`` is the stripped text of a string where it is at hand."""
    v = _col(v)
    sch = F.schema_of_variant(v) if sch is None else sch
    t = type_of_schema(sch) if t is None else t
    return (
        F.when(v.isNull() | (t == "VOID"), True)
        .when(t == "STRING", (strip(F.try_variant_get(v, "$", "string")) if s is None else s) == "")
        .when(t == "ARRAY", (sch == "ARRAY<VOID>") & (F.to_json(v) == "[]"))
        .when(t == "OBJECT", sch == "OBJECT<>")
        .otherwise(False)
    )


def variant_text(v) -> Column:
    """``str(value)`` for scalars; list elements joined are handled by callers."""
    return F.try_variant_get(_col(v), "$", "string")


# Fixed value: doubles that JSON has no number for, as ``to_json`` writes them: in quotes, like strings.
_QUOTED_DOUBLES = ('"Infinity"', '"-Infinity"', '"NaN"')


def json_type(v, j, first) -> Column:
    """``vtype`` of a value whose JSON text ``j`` is at hand: its first byte
    (``first``, a number) tells the type but for numbers, whose schema is asked."""
    return (
        F.when((_col(first) == ord('"')) & ~_col(j).isin(*_QUOTED_DOUBLES), "STRING")
        .when(_col(first) == ord("{"), "OBJECT")
        .when(_col(first) == ord("["), "ARRAY")
        .when(_col(first).isin(ord("t"), ord("f")), "BOOLEAN")
        .when(_col(first) == ord("n"), "VOID")
        .otherwise(vtype(v))
    )


def json_text(v, j=None) -> Column:
    """``variant_text`` of a value whose JSON text ``j`` may be at hand: a string
    without escapes stands between the quotes; only another value is cast, which
    builds a Spark expression for each."""
    if j is None:
        return variant_text(v)
    j = _col(j)
    plain = j.startswith('"') & ~j.contains("\\") & ~j.isin(*_QUOTED_DOUBLES)
    inner = F.substring(j.cast("binary"), F.lit(2), F.octet_length(j) - 2).cast("string")
    return F.when(plain, inner).otherwise(variant_text(v))


def clean_value_string(v, list_sep: str | None = None, t: Column | None = None) -> Column:
    """P1 over a JSON value. Lists are joined with ``list_sep`` after
    cleaning their elements (empty list -> NULL). Without ``list_sep`` no type is
    asked for: a JSON null has no text."""
    v = _col(v)
    scalar = clean_string(variant_text(v))
    if list_sep is None:
        return scalar
    t = vtype(v) if t is None else t
    joined = F.array_join(clean_list(v, t), list_sep)
    return F.when(t == "ARRAY", F.nullif(joined, F.lit(""))).when(t == "VOID", None).otherwise(scalar)


def list_parts(v, t: Column | None = None, j=None) -> tuple[Column, Column]:
    """What ``clean_list`` takes from a JSON value: a list's elements as texts (else
    NULL) and a string, cleaned (else NULL)."""
    v = _col(v)
    t = vtype(v) if t is None else t
    return F.when(t == "ARRAY", F.try_variant_get(v, "$", "array<string>")), F.when(t == "STRING", clean_string(json_text(v, j)))


def clean_parts(elems, one) -> Column:
    """The cleaned list of ``list_parts``."""
    elems, one = _col(elems), _col(one)
    cleaned = F.filter(F.transform(elems, strip), lambda x: x != "")
    return F.when(elems.isNotNull(), cleaned).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<string>"))


def clean_list(v, t: Column | None = None) -> Column:
    """None->[]; string->[stripped] or []; list->cleaned, blanks dropped; other->[]."""
    return clean_parts(*list_parts(v, t))


def parse_float_text(s) -> Column:
    """Python ``float(s.strip().replace('$','').replace(',',''))`` or NULL."""
    t = F.regexp_replace(strip(_col(s)), r"[$,]", "")
    return F.when(t.rlike(_FLOAT_TEXT), t.try_cast("double"))


def clean_number(v, t: Column | None = None, j=None) -> Column:
    """Numbers (bools as 1.0/0.0) -> double; text parsed as above; else NULL."""
    v = _col(v)
    t = vtype(v) if t is None else t
    return (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN"),
               json_number(v, j))
        .when(t == "STRING", parse_float_text(json_text(v, j)))
    )


def parse_vote(v, t: Column | None = None, j=None) -> Column:
    """Integers kept; '1,234' -> 1234; floats, booleans and junk -> NULL."""
    v = _col(v)
    t = vtype(v) if t is None else t
    s = F.replace(strip(json_text(v, j)), F.lit(","), F.lit(""))
    return (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), json_int(v, j))
        .when((t == "STRING") & s.rlike(_INT_TEXT), strip(s).try_cast("bigint"))
    )


def parse_timestamp(v, t: Column | None = None, j=None) -> tuple[Column, Column]:
    """``int(value)``. Returns (seconds, is_invalid); a missing value is
    neither (callers test NULL first). Floats truncate, numeric text must be
    an integer, infinities and containers are invalid."""
    v = _col(v)
    t = vtype(v) if t is None else t
    s = json_text(v, j)
    seconds = (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), json_int(v, j))
        .when(t == "DECIMAL", F.try_variant_get(v, "$", "bigint"))
        .when(t.isin("DOUBLE", "FLOAT"), F.try_variant_get(v, "$", "double").try_cast("bigint"))
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .when((t == "STRING") & s.rlike(_INT_TEXT), strip(s).try_cast("bigint"))
    )
    return seconds, seconds.isNull()


def float_text(d) -> Column:
    """``str(float)`` as Python prints it: plain digits from 0.0001 to below
    1e16, else an exponent of two digits or more."""
    d = _col(d)
    java, size = d.cast("string"), F.abs(d)
    # the shortest digits, moved to their places; 16 before and 22 behind the point
    plain = F.regexp_replace(java.try_cast("decimal(38,22)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    e = F.regexp_replace(F.regexp_replace(F.regexp_replace(java, r"\.0E", "E"), r"E-(\d)$", "E-0$1"), r"E(\d)", "E+$1")
    return (
        F.when(F.isnan(d), "nan")
        .when(size == float("inf"), F.when(d > 0, "inf").otherwise("-inf"))
        .when((size >= 1e-3) & (size < 1e7) | (size == 0), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.lower(e))
    )


def number_text(v, t: Column | None = None, n: Column | None = None, j=None) -> Column:
    """``str(value)`` of a JSON scalar as Python prints it (ints as digits,
    floats through double, booleans capitalized, strings unchanged); NULL for null.
    ``n`` is the value of a number where it is at hand."""
    v = _col(v)
    t = vtype(v) if t is None else t
    n = F.try_variant_get(v, "$", "double") if n is None else n
    return (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), _json(v, j))
        .when(t.isin("DECIMAL", "DOUBLE", "FLOAT"), float_text(n))
        .when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), "True").otherwise("False"))
        .otherwise(json_text(v, j))
    )


def style_json(v, t: Column | None = None, j=None) -> Column:
    """JSON object -> text with sorted keys in ``json.dumps`` spacing; else NULL."""
    from lakeloom.functions.text import json_spaced

    v = _col(v)
    t = vtype(v) if t is None else t
    return F.when(t == "OBJECT", json_spaced(_json(v, j)))


def sha256_hex(c) -> Column:
    """P4."""
    return F.sha2(_col(c), 256)


def product_id_from_key(c) -> Column:
    """P5: 'prod_' + first 24 hex digits of sha256(key)."""
    return F.concat(F.lit("prod_"), F.substring(sha256_hex(c), 1, 24))


def review_id_from_parts(*parts) -> Column:
    """P6: 'rev_' + first 32 hex digits of sha256 of the '|'-joined parts
    (each part already '' when the source value is falsy)."""
    cols = [F.coalesce(_col(p), F.lit("")) for p in parts]
    return F.concat(F.lit("rev_"), F.substring(sha256_hex(F.concat_ws("|", *cols)), 1, 32))


def falsy_text(v, raw_text, t: Column | None = None, n: Column | None = None, j=None) -> Column:
    """``str(value or '')`` for a JSON value: '' for null, 0, 0.0, '', false,
    [] and {}; otherwise the literal text of the value (``raw_text``). ``n`` is
    the value of a number where it is at hand."""
    v = _col(v)
    t = vtype(v) if t is None else t
    num = F.try_variant_get(v, "$", "double") if n is None else n
    falsy = (
        v.isNull()
        | (t == "VOID")
        | ((t.isin("BIGINT", "INT", "DECIMAL", "DOUBLE", "FLOAT")) & (num == 0))
        | ((t == "STRING") & (_col(raw_text) == ""))
        | ((t == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean"))
        | ((t == "ARRAY") & (_json(v, j) == "[]"))
        | ((t == "OBJECT") & (_json(v, j) == "{}"))
    )
    shown = F.when(t == "BOOLEAN", F.lit("True")).otherwise(_col(raw_text))
    return F.when(falsy, F.lit("")).otherwise(shown)


def safe_percentage(n, d) -> Column:
    """100 * n / d rounded to 4 places, 0 when d is 0."""
    return F.round(F.coalesce(F.try_divide(_col(n).cast("double"), _col(d)), F.lit(0.0)) * 100, 4)
