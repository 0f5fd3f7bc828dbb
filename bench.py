"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "steps_daily", "daily_metrics", "daily_metrics_sides", "daily_metrics_chain", "data_quality_summary", "dashboard_daily",
    "dashboard_weekly", "dashboard_monthly", "dashboard_correlations", "dashboard_trends", "dashboard_trends_split",
    "long_series_trends", "dashboard_monthly_orders", "exact_medians", "analysis_frame", "pearson_corr_lineitem",
    "regression_metrics", "max_in_group", "histogram20", "recent_means", "kpi_cards", "valid_payload", "history_rows",
    "missing_documents", "chronological_split", "radius_join", "radius_fallback", "topn_by_score", "recommend_topn",
]


def main() -> None:
    from daystrata import session
    from daystrata.plans import sample
    from daystrata.plans.queries import QUERIES
    from daystrata.session import local_session
    from daystrata.sources import raw

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="daystrata-bench")
    # The documents land once, untimed, as they lie in a lake; the queries read them from there.
    landed = session.new_folder(spark, "landed")
    raw.write_raw(sample.raw_documents(spark, folder), landed)
    sample.raw_documents = lambda spark, folder: spark.read.parquet(landed)
    # Every result is computed in full and thrown away; the best of two runs counts, after one warm-up
    # of the session.
    QUERIES["table_extent"](spark, folder).collect()
    timings: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
