"""Helpers that render driver rows as JSON text (test inputs for the raw
source). Inputs are plain identifiers and numbers, so no escaping is needed."""

from __future__ import annotations

from pyspark.sql import functions as F

c, lit = F.col, F.lit


def s(x):
    return (c(x) if isinstance(x, str) else x).cast("string")


def q(*parts):
    """JSON string literal text from pieces."""
    return F.concat(lit('"'), *[p if not isinstance(p, str) else lit(p) for p in parts], lit('"'))


def kv(key, value_text):
    return F.concat(lit(f'"{key}":'), value_text)


def obj(*fields):
    """'{...}' from field texts; NULL fields are left out."""
    return F.concat(lit("{"), F.concat_ws(",", *fields), lit("}"))
