"""Mixing sources to target weights (operator 3, DataFrame functions only).

Iterative proportional fitting: documents fall into cells of source, language
and topic. Each round rakes the cells' sampling probabilities to the target
share of tokens of every source, then language, then topic, and no
probability goes over 1. Documents are then sampled by their cell's
probability: a hash of the id, read as a number in [0, 1), is below it.

Documents are aggregated to cells once, with partial sums before the shuffle;
all raking runs on the table of cells, whose size does not depend on the
number of documents. That table is joined back to the documents; Spark
broadcasts it only below its size threshold.

Defined results: a null or empty dimension is the value ``unknown``; null and
empty texts have no tokens and stay with their cell's probability; rows
repeating an id stay or go together; a null id is hashed as the empty text;
a table without tokens keeps each row with the plain rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import id_of, written

WORD = r"[^\x20\x09-\x0D]+"
DIMS = ("source", "lang", "topic")

#: Topic by form, the first that fits; ``n_tokens`` is the number of words.
TOPICS = (
    ("table", "text LIKE '% | %'"),
    ("note", "n_tokens < 50"),
    ("long read", "n_tokens >= 2000"),
    ("article", "n_tokens >= 300"),
)
OTHER_TOPIC = "brief"

#: Target shares are proportional to tokens to this power (1: as they are, 0: equal).
TEMPERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}


def with_dimensions(docs: DataFrame, topics=TOPICS, text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, and source, lang, topic, n_tokens."""
    named = lambda c: F.when(F.col(c).cast("string") != "", F.col(c).cast("string")).otherwise("unknown")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), named(source_col).alias("source"), named(lang_col).alias("lang"),
        text.alias("text"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )
    topic = F.lit(OTHER_TOPIC)
    for name, condition in reversed(topics):
        topic = F.when(F.expr(condition), F.lit(name)).otherwise(topic)
    return base.select("row", "source", "lang", topic.alias("topic"), "n_tokens")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, share): target shares proportional to the dimension's tokens to ``power``."""
    by = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    weight = F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(power))).otherwise(F.lit(0.0))
    weights = by.select(dim, weight.alias("weight"))
    # one row, joined: a window over all values would put them in one task
    total = weights.agg(F.sum("weight").alias("total"))
    return weights.crossJoin(F.broadcast(total)).select(dim, F.coalesce(F.try_divide("weight", "total"), F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rate: float, rounds: int = 8) -> DataFrame:
    """``cells`` with ``probability``: of all tokens a ``rate`` is kept, in the target shares as far as tokens reach."""
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    state = cells.withColumn("probability", F.lit(float(rate)))
    for dim, target in targets.items():
        state = state.join(target.select(dim, F.col("share").alias(f"{dim}_share")), dim, "left")
    state = written(state, "cells")
    for i in range(rounds):
        for dim in targets:
            have = F.sum(F.col("probability") * F.col("tokens")).over(Window.partitionBy(dim))
            want = F.coalesce(F.col(f"{dim}_share"), F.lit(0.0)) * F.lit(float(rate * total))
            state = state.withColumn("probability", F.when(have > 0, F.least(F.lit(1.0), F.col("probability") * want / have)).otherwise(F.col("probability")))
        if i % 4 == 3:
            state = written(state, "cells")
    return state.select(*cells.columns, F.round("probability", 9).alias("probability"))


def uniform(col: Column) -> Column:
    """A number in [0, 1) from a hash of the id."""
    return F.conv(F.substring(F.sha2(F.coalesce(col.cast("string"), F.lit("")), 256), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(docs: DataFrame, rate: float = 0.5, tempers: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None, rounds: int = 8, id_col: str = "doc_id") -> DataFrame:
    """(row, source, lang, topic, n_tokens, probability, kept), one row per input row.

    Targets are given as (value, share) tables by dimension, or tempered from
    the corpus. ``row`` holds all columns of ``docs``.
    """
    given = with_dimensions(docs)
    cells = written(given.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    targets = targets or {d: tempered(cells, d, p) for d, p in (tempers or TEMPERS).items()}
    raked = written(rake(cells, targets, rate, rounds).select(*DIMS, "probability"), "raked")
    joined = given.join(raked, list(DIMS))
    return joined.select("row", *DIMS, "n_tokens", "probability", (uniform(id_of_row(id_col)) < F.col("probability")).alias("kept"))


def id_of_row(id_col: str) -> Column:
    return id_of(f"row.`{id_col}`")
