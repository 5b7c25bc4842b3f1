"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Every query is executed in full through the no-op sink (nothing is collected
to the driver). A short warm-up on the smallest data set runs first and is
not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "g1_product_review_stats",  # gold (flagship)
    "g2_reviewer_stats",
    "v1_silver_reviews",  # silver split
    "v2_quarantine_reviews",
    "v6_quality_report",  # quality report
    "r2_entity_mapping",  # resolution
    "r3_resolved_reviews",
    "r6_duplicate_diagnosis",
    "i3_normalize_products",  # raw JSON -> canonical
    "i4_normalize_reviews",
    "p1_field_profile",  # profiling
    "p8_review_field_profile",
    "p9_product_field_profile",
    "p6_cardinality_integrity",
    "f1_multimodal_features",
    "s1_topk_exact",
    "s2_batch_topk",
    "s3_enriched_search",
    "e1_embed_text",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from lakeloom.plans import catalog
    from lakeloom.session import checkpoint_dir, local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="lakeloom-bench")
    checkpoint_dir(spark)

    def run(name: str, d: str) -> float:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, d)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for name in ("g1_product_review_stats", "i4_normalize_reviews", "p8_review_field_profile", "s1_topk_exact"):
            run(name, warm)

    times = {}
    for name in HEADLINE:
        times[name] = round(run(name, sf_dir), 3)

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    total = round(sum(times.values()), 3)
    out = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "review_rows": rows,
        "review_normalize_rows_per_sec": round(rows / times["i4_normalize_reviews"], 1),
        "silver_split_rows_per_sec": round(rows / (times["v1_silver_reviews"] + times["v2_quarantine_reviews"]), 1),
        "review_profile_rows_per_sec": round(rows / times["p8_review_field_profile"], 1),
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
