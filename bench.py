"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of threads. Every query runs once to warm
up; the time is the better of two further runs into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rateloom.plans.catalog import QUERIES  # noqa: E402
from rateloom.session import build_session  # noqa: E402

HEADLINE = [
    "bars_1min",
    "bars_15min",
    "bars_1day",
    "latest_bar",
    "latest_bar_of_trades",
    "snapshot",
    "convert_amounts",
    "asof_quote_of_trade",
    "rate_for_pair",
    "rate_for_pair_on_date",
    "cross_rates",
    "rebase_rates",
    "rates_historical",
    "rates_timeseries",
    "batch_audit",
    "convert_currency",
    "bars_historical",
    "snapshot_feed",
    "close_on_date",
    "classify_response",
    "enforce_schema",
    "json_string",
    "normalize_percent",
    "parse_iso_utc",
    "batch_calendar",
    "tag_string",
    "sql_query",
    "read_objects",
    "sheet_table",
    "write_parquet",
    "incremental_landing",
    "latest_responses",
    "fetch_responses",
    "outstanding_requests",
    "backfill_rates",
    "second_backfill",
    "bars_timeseries",
    "bars_timeseries_audit",
    "list_objects",
    "write_objects",
    "latest_rates_job",
    "polled_rates",
    "rejected_lines",
    "incremental_rates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    spark = build_session("bench", f"local[{cpus}]", **settings)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.stop()
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="rateloom-bench-")
        spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    chosen = sys.argv[1:] or HEADLINE
    times = {}
    for name in chosen:
        run(name)
        times[name] = round(min(run(name), run(name)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
