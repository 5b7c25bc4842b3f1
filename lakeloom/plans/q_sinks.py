"""k*: queries that go through the sources and sinks: rendered raw lines are
written as gzip files, read, routed to silver and quarantine, published, and
the result is read back from what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeloom.operators import ingest, profile, silver
from lakeloom.plans import roles
from lakeloom.plans.q_ingest import _REVIEW_ERR_SQL, I4_SQL, _lists_as_text, _review_lines
from lakeloom.plans.q_quality import _FLAGGED_SQL, _flagged_reviews
from lakeloom.plans.registry import register, rounded
from lakeloom.session import checkpoint_dir
from lakeloom.sources import raw, sinks

RUN = "first"


def _folder(spark, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _routed(spark, sf_dir, folder: str) -> str:
    """Raw gzip lines, ingested and written to both routes; the path of the run."""
    _review_lines(spark, sf_dir).write.option("compression", "gzip").text(f"{folder}/raw")
    lines = raw.read_lines(spark, f"{folder}/raw")
    silver.write_routed(ingest.ingest(lines, "reviews"), f"{folder}/routed", RUN)
    return f"{folder}/routed/run_id={RUN}"


@register("k1_silver_files", I4_SQL)
def k1_silver_files(spark, sf_dir):
    """The silver route, published to the next layer with
    the silver schema and read from there."""
    folder = _folder(spark, "k1")
    run = _routed(spark, sf_dir, folder)
    good = spark.read.parquet(run).where(F.col(silver.ROUTE) == "silver")
    sinks.write_parquet(good.select(*ingest.REVIEW_COLUMNS), f"{folder}/silver", compression="snappy")
    sinks.publish(spark, f"{folder}/silver", f"{folder}/published")
    return rounded(_lists_as_text(spark.read.parquet(f"{folder}/published"), ["image_urls"]))


@register("k2_quarantine_files", f"""
SELECT {_REVIEW_ERR_SQL} AS error, 'reviews' AS entity, '{RUN}' AS run_id, count(*) AS n FROM lineitem
WHERE ({_REVIEW_ERR_SQL}) IS NOT NULL GROUP BY 1""")
def k2_quarantine_files(spark, sf_dir):
    """Quarantined records as JSON lines, read back and counted by error;
    each record must still be the line that was refused."""
    folder = _folder(spark, "k2")
    _, bad = ingest.split_valid(ingest.ingest(_review_lines(spark, sf_dir), "reviews"))
    sinks.write_quarantine(bad, f"{folder}/quarantine", RUN, "reviews")
    back = spark.read.schema("error string, record string, entity string, run_id string").json(f"{folder}/quarantine")
    return back.where(F.col("record").startswith("{")).groupBy("error", "entity", "run_id").agg(F.count(F.lit(1)).alias("n"))


@register("k3_report_file", _FLAGGED_SQL + """
SELECT coalesce(error, 'valid') AS value, count(*) AS count FROM flagged GROUP BY 1""")
def k3_report_file(spark, sf_dir):
    """The routes of the silver split as a JSON report, read back."""
    path = f"{_folder(spark, 'k3')}/report"
    routes = _flagged_reviews(spark, sf_dir).select(F.coalesce("error", F.lit("valid")).alias("route"))
    sinks.write_report(profile.histogram(routes, "route"), path)
    return spark.read.schema("value string, count long").json(path)


@register("k4_row_counts", "\nUNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in roles.TABLES))
def k4_row_counts(spark, sf_dir):
    """Rows of every table; no column is read, the counts are those of the footers."""
    counts = [sinks.row_count(spark, f"{sf_dir}/{t}.parquet").select(F.lit(t).alias("name"), "n_rows") for t in roles.TABLES]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out
