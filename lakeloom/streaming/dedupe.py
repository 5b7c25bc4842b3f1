"""Stateful review dedupe on a stream (§2.9): repeats, late rows and rows of
earlier runs are routed to quarantine with a code, never dropped in silence.

``dropDuplicatesWithinWatermark`` drops repeats and late rows without a trace,
so the state is kept by ``applyInPandasWithState``: review ids are dealt to a
fixed number of buckets, and a bucket's state holds the ids accepted so far with
their event times. A Python worker holds one bucket's state at a time, so buckets
are many and small; their number must stay the same for a checkpoint. Ids whose event time lies behind the watermark leave the
state, as a repeat of them would be late; the state is as large as the
watermark's window. A bucket's rows of one micro-batch are taken chunk by chunk.

Rows pass the Python worker as one JSON text each, so their types do not matter
there. The order of codes: missing id, missing time, already ingested (in the
static key set), late, duplicate.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.operators.silver import write_routed

# Codes of quarantined stream rows.
MISSING_ID, MISSING_TIME = "missing_review_id", "missing_review_timestamp"
KNOWN, LATE, DUPLICATE = "already_ingested", "late_review", "duplicate_review"

#: Buckets of ids: of 100 million ids in the watermark's window each holds 25,000.
BUCKETS = 4096
_STATE = "ids array<string>, times array<bigint>"
_OUT = "payload string, error string"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _judge(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    watermark = state.getCurrentWatermarkMs()
    ids, times = state.get if state.exists else ([], [])
    seen = {i: t for i, t in zip(ids, times, strict=True) if t >= watermark}
    for pdf in chunks:
        errors = []
        for review, ms, error in zip(pdf["id"].tolist(), pdf["ms"].tolist(), pdf["error"].tolist(), strict=True):
            if error is None and ms < watermark:
                error = LATE
            elif error is None and review in seen:
                error = DUPLICATE
            elif error is None:
                seen[review] = ms
            errors.append(error)
        yield pd.DataFrame({"payload": pdf["payload"], "error": pd.Series(errors, dtype=object)})
    state.update((list(seen), list(seen.values())))


def dedupe_reviews(reviews: DataFrame, known: DataFrame | None = None, key: str = "review_id", event_time: str = "review_time", delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """The stream's rows with ``error``: NULL for the first row of an id, else a code.

    ``known``: a static table with the ids that earlier runs have ingested.
    Equal ids are taken as the same review, as a review id covers the review's
    time: an id leaves the state once its time lies behind the watermark. Which of
    a micro-batch's copies is the first is not defined. Rows of a watermarked window wait in no buffer:
    each is judged in the micro-batch it arrives in."""
    if buckets <= 0:
        raise ValueError("buckets must be positive")
    columns = reviews.columns
    payload = F.to_json(F.struct(*[F.col(c) for c in columns]), _JSON)
    k, t = F.col(key).cast("string"), F.col(event_time)
    error = F.when(k.isNull(), MISSING_ID).when(t.isNull(), MISSING_TIME)
    rows = reviews.withWatermark(event_time, delay)
    if known is not None:
        ids = known.select(F.col(key).cast("string").alias("_known")).where("_known IS NOT NULL").distinct()
        rows = rows.join(ids, k == F.col("_known"), "left")
        error = error.when(F.col("_known").isNotNull(), KNOWN)
    rows = rows.select(
        # rows judged already need no state: they go to any bucket
        F.pmod(F.xxhash64(F.coalesce(k, F.uuid())), F.lit(buckets)).alias("bucket"),
        t.alias("at"),  # carries the watermark to the state
        F.coalesce(k, F.lit("")).alias("id"), F.coalesce(F.unix_millis(t.cast("timestamp")), F.lit(0)).alias("ms"), payload.alias("payload"), error.alias("error"))
    judged = rows.groupBy("bucket").applyInPandasWithState(_judge, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
    row = F.from_json("payload", reviews.schema, _JSON)
    return judged.select(row.alias("row"), "error").select(*[F.col(f"row.`{c}`").alias(c) for c in columns], "error")


def stream_reviews(judged: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Starts the query that writes accepted rows to ``route=silver`` and coded
    ones to ``route=quarantine``; a micro-batch that is replayed after a failure
    replaces its own output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_routed(batch, out_path, run_id=f"batch-{batch_id:09d}")

    writer = judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
