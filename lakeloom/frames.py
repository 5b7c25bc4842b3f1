"""Small DataFrame-level helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def boundary(df: DataFrame) -> DataFrame:
    """Identity that filters cannot be pushed through.

    Parsing and cleaning build deep expression trees. If a filter on their
    results (``parse_error IS NULL``, ``error IS NULL``) were pushed below
    them, Catalyst would inline every tree into the predicate (predicates do
    not share common subexpressions) and evaluate the parse several times
    per row. A generator, ``inline`` of a one-element array, keeps such
    filters above the projection, so each expression runs once per row.
    """
    # one column goes into the generator: Spark hands each of its input columns to the next generated
    # method as two arguments, and of a method with more than some 50 the JVM makes no optimized code
    row = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    return row.select(F.inline(F.array("_row")))


def with_one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Add the columns of ``right``, a single-row frame such as a global
    aggregate, to every row of ``left``. ``right`` becomes one scalar
    subquery (a struct), evaluated once; there is no join, and the query
    fails if ``right`` ever holds more than one row."""
    r = right.select(F.struct(*[F.col(c) for c in right.columns]).alias("_r")).scalar()
    return left.select("*", r.alias("_r")).select(*left.columns, *[F.col("_r")[c].alias(c) for c in right.columns])


def skew_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "left") -> DataFrame:
    """Join of a table whose key may be hot with a key-unique table that is
    itself an aggregate on the key.

    AQE splits a hot partition only where both sides of the join are bare
    shuffles. An aggregate is already partitioned by its key, so it would be
    joined without one and the rule would never fire; the boundary hides that
    partitioning. The few key-unique rows move once more, and a hot key is
    then split into as many tasks as its bytes ask for."""
    small = boundary(small)
    return big.join(small, big[big_key] == small[small_key], how)
