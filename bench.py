"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with seconds per query.

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressroom.plans.registry import load_all  # noqa: E402
from pressroom.session import local_session  # noqa: E402

HEADLINE = (
    "news_score", "top_scored", "publish_upsert", "digest_counts", "digest_news", "facet_counts",
    "text_search", "paged_feed", "parse_dates", "clean_ws_v1", "dedupe_exact", "classify_themes",
    "rss_items", "json_listing", "early_stop_page", "listing_cards", "article_minus_boilerplate",
    "job_ingest", "job_translate_summarize", "job_vectorize_request", "stream_weekly_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    # BENCH_EVENT_LOG=<folder>: write Spark's event log there (stage and task
    # times for offline reading; the UI stays off).
    log_dir = os.environ.get("BENCH_EVENT_LOG")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app="pressroom-bench", extra=extra)
    reg = load_all()
    # Warm-up (session setup, not timed): JVM, parquet footers, Python workers.
    reg["scan_news"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, 64).mapInPandas(lambda it: it, "id long").write.format("noop") \
        .mode("overwrite").save()
    spark.range(0, 8).toPandas()   # driver-side Arrow conversion
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
