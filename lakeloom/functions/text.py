"""String column functions with Python ``str`` semantics.

All functions map Column -> Column and stay inside Catalyst (no UDF).
Spark's ``trim`` strips only U+0020, while Python's ``strip``/``split`` use
every Unicode whitespace code point, so one shared character class is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points Python's str.isspace() accepts, written as a
# Java regex class: TAB LF VT FF CR, the four information separators
# U+001C..U+001F, NEL U+0085 and every Unicode separator (category Z).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
_RUN = f"{WS_CLASS}+"
# Fixed value: the same 29 code points as a plain string, in code point order,
# for btrim (edge trimming without a regex): U+0009..U+000D, U+001C..U+001F,
# U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F,
# U+205F, U+3000.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``s.strip()``. btrim looks every edge character up in the whole
    class; a column given by its name can be read several times for nothing, so
    its text is taken as it is where both edge bytes are visible ASCII."""
    trimmed = F.btrim(_col(c), F.lit(WS_CHARS))
    if not isinstance(c, str):
        return trimmed
    data = F.col(c).cast("string").cast("binary")
    first, last = (F.substring(data, i, 1).between(F.lit(b"!"), F.lit(b"~")) for i in (1, -1))
    return F.when(first & last, F.col(c).cast("string")).otherwise(trimmed)


def clean_string(c) -> Column:
    """Strip Unicode whitespace; empty -> NULL; NULL stays NULL."""
    return F.nullif(strip(c), F.lit(""))


def is_blank(c) -> Column:
    """True for NULL or whitespace-only text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def has_text(c) -> Column:
    """Python ``value is not None and str(value).strip()`` as a boolean."""
    return ~is_blank(c)


def clean_text(c) -> Column:
    """P20: strip to '' (NULL -> '')."""
    return F.coalesce(strip(c), F.lit(""))


def normalize_text(c) -> Column:
    """``' '.join(s.split())``; NULL -> ''."""
    return F.coalesce(strip(F.regexp_replace(_col(c), _RUN, " ")), F.lit(""))


def normalize_lower(c) -> Column:
    """Lower-cased P14."""
    return F.lower(normalize_text(c))


def text_equal(a, b) -> Column:
    """Equality after P15 (NULL and '' compare equal)."""
    return normalize_lower(a) == normalize_lower(b)


def labeled(label: str, c) -> Column:
    """'Label: value' or NULL when the value is blank (for concat_ws)."""
    v = clean_string(c)
    return F.when(v.isNotNull(), F.concat(F.lit(f"{label}: "), v))


def json_spaced(c) -> Column:
    """Re-space compact JSON text the way Python's ``json.dumps`` prints it
    (``', '`` and ``': '`` outside of strings)."""
    token = r'((?:"(?:[^"\\]|\\.)*"|[^",:])*?)([,:])'
    return F.regexp_replace(_col(c), token, "$1$2 ")
