"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

With ``--all`` every registered query is timed. A query is timed by computing all its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "last_event_per_day", "daily_balance", "daily_balance_incremental", "balance_as_of", "portfolio_daily_balance",
    "inventory_daily_balance", "cumulative_history", "scd2_backfill", "scd2_incremental", "activity_datelist_device",
    "datelist_to_bitmask", "monthly_activity_arrays", "eod_prices", "price_period_changes", "index_period_report",
    "mean_market_prices", "closing_price_chain", "run_suite", "rule_within_quartile_limits_by", "profile",
    "ingest_new_documents", "upsert", "rfmt_features", "cluster_profile", "log_scale", "label_encode", "vote_hard", "evaluate",
]


def main() -> None:
    from daybook.plans import registered
    from daybook.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cpus)
    queries = registered()
    chosen = [a for a in sys.argv[1:] if not a.startswith("--")] or HEADLINE
    if "--all" in sys.argv:
        chosen = list(queries)
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the executors
    seconds = {}
    for name in chosen:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        if "--verbose" in sys.argv:
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
