"""Dense-vector column functions (ARRAY<FLOAT> / ARRAY<DOUBLE>).

Elements are widened to double before multiplying (float32 inputs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.text import _col


def dot(a, b) -> Column:
    """Inner product of two equal-length vectors, in double precision."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def dot_literal(a, q: Sequence[float]) -> Column:
    """Inner product against a constant vector, folded into the expression
    (no join: every partition scores its own rows)."""
    return dot(a, F.array(*[F.lit(float(x)) for x in q]))


def norm(a) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a, element_type: str = "float") -> Column:
    """V / ||v|| (zero vectors stay zero)."""
    n = norm(a)
    return F.transform(
        _col(a),
        lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)).cast(element_type),
    )


def dimension(a) -> Column:
    """Vector length as int."""
    return F.size(_col(a)).cast("int")
