"""x*: the raw-line ingest as a Structured Streaming job (file source,
watermark dedupe, foreachBatch sink). The stream result equals the batch
result on the same lines."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lakeloom.functions.values import field
from lakeloom.plans import roles
from lakeloom.plans.registry import register
from lakeloom.session import checkpoint_dir
from lakeloom.streaming import dedupe
from lakeloom.streaming import ingest as stream

c, lit = F.col, F.lit


def _lines(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    ts = F.date_format(c("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    good = F.concat(lit('{"event_id":'), c("event_id").cast("string"), lit(',"ts":"'), ts, lit('","props":'),
                    c("props"), lit("}"))
    return e.select("event_id", F.when(c("event_id") % 50 == 3, lit("{bad")).otherwise(good).alias("line"))


@register("x1_stream_ingest", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 50 <> 3""")
def x1_stream_ingest(spark, sf_dir):
    base = os.path.join(checkpoint_dir(spark), f"x1-{uuid.uuid4().hex}")
    lines = _lines(spark, sf_dir)
    lines.select("line").write.mode("append").text(f"{base}/in")
    # a second delivery of every tenth line: the stream must drop the repeats
    lines.where(c("event_id") % 10 == 0).select("line").write.mode("append").text(f"{base}/in")

    parsed = stream.parse_stream(stream.read_raw_stream(spark, f"{base}/in")).where("parse_error IS NULL")
    rec = c("record")
    events = parsed.select(
        F.variant_get(field(rec, "event_id"), "$", "bigint").alias("event_id"),
        F.to_timestamp(F.try_variant_get(field(rec, "ts"), "$", "string")).alias("ts"),
        F.variant_get(rec, "$.props.k", "bigint").alias("k"),
    )
    deduped = stream.dedupe_within_watermark(events, "event_id", "ts", "1 hour")
    q = stream.start_to_parquet(deduped, f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "k")


# ------------------------------------------------------- x2 review dedupe
DELAY_DAYS = 500
#: deliveries that a review's copies come in, besides its first one, by the last digit of its order
AGAIN = {0: 0, 1: 1, 2: 2}
KNOWN_DIGIT = 3
_DELIVERIES = 5


def _deliveries(spark, sf_dir):
    """Stand-in deliveries: reviews by three years, some delivered again at once, later, or much later."""
    li = roles.table(spark, sf_dir, "lineitem")
    digit = c("l_orderkey") % 10
    later = F.when(digit == 0, AGAIN[0]).when(digit == 1, AGAIN[1]).when(digit == 2, AGAIN[2])
    first = F.floor((F.year("l_shipdate") - 1995) / 3).cast("int")
    copies = F.when(later.isNull(), F.array(first)).otherwise(F.array(first, first + later))
    return li.select(
        # like the library's review ids, one that covers the review's contents and time
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(c("l_quantity") * 100).cast("bigint"), F.date_format("l_shipdate", "yyyyMMdd")).alias("review_id"), c("l_orderkey").alias("order_key"),
        c("l_quantity").alias("rating"), c("l_shipdate").cast("timestamp").alias("review_time"), F.explode(copies).alias("delivery"))


@register("x2_stream_review_dedupe", f"""
WITH f AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity * 100)::BIGINT, strftime(l_shipdate, '%Y%m%d')) AS review_id, l_orderkey AS k, l_quantity AS rating, l_shipdate AS t, (year(l_shipdate) - 1995) // 3 AS d FROM lineitem),
r AS (SELECT review_id, k, rating, t, unnest(CASE WHEN k % 10 IN (0, 1, 2) THEN [d, d + k % 10] ELSE [d] END) AS delivery FROM f),
m AS (SELECT delivery, max(max(t)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY_DAYS} DAY AS watermark FROM r GROUP BY delivery),
l AS (SELECT r.*, coalesce(t < watermark, FALSE) AS late, k % 10 = {KNOWN_DIGIT} AS known FROM r JOIN m USING (delivery)),
e AS (SELECT *, CASE WHEN known THEN 'already_ingested' WHEN late THEN 'late_review'
        WHEN row_number() OVER (PARTITION BY review_id, late ORDER BY delivery) > 1 THEN 'duplicate_review' END AS error FROM l)
SELECT review_id, rating, delivery::INTEGER AS delivery, error FROM e""")
def x2_stream_review_dedupe(spark, sf_dir):
    """§2.9: reviews arrive in deliveries with repeats within and beyond the
    watermark; the stream is stopped and started again between deliveries, and
    its state comes from the checkpoint."""
    base = os.path.join(checkpoint_dir(spark), f"x2-{uuid.uuid4().hex}")
    rows = _deliveries(spark, sf_dir)
    known = rows.where(c("order_key") % 10 == KNOWN_DIGIT).select("review_id")
    for n in range(_DELIVERIES):
        rows.where(c("delivery") == n).write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        judged = dedupe.dedupe_reviews(arriving, known, delay=f"{DELAY_DAYS} days")
        dedupe.stream_reviews(judged, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("review_id", "rating", "delivery", "error")
