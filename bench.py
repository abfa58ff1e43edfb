"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once to warm up, then ``$BENCH_RUNS`` times (3 by default); its time is the
median, from building the plan to the last row written to a sink that discards them.

``report_separate`` adds up the eleven result sets of one report when each is its own query;
``report_fused`` is the report with all its sections from one stored roll-up; ``load_facts``
writes the facts as a table partitioned by month, and the ``stored_`` queries read that table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from tallyfold.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1))))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

SECTIONS = [
    "ytd_costs",
    "fy_ytd_costs",
    "fy_total_costs",
    "prior_fy_costs",
    "day_comparison",
    "week_comparison",
    "month_comparison",
    "cto_costs",
    "pillar_costs",
    "product_costs",
    "daily_trend",
]
OTHERS = [
    "period_matrix",
    "scorecard",
    "fiscal_year_averages",
    "daily_average_table",
    "trend_series",
    "env_mean_baseline",
    "filter_value_lists",
    "distinct_product_count",
    "classify_env_exact",
    "scan_cost_facts",
]


def seconds(build: Callable) -> float:
    started = time.perf_counter()
    frame = build()
    if frame is not None:
        frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def median_seconds(build: Callable) -> float:
    seconds(build)
    return round(statistics.median(seconds(build) for _ in range(RUNS)), 4)


def main() -> None:
    from tallyfold.catalog.queries import DATES, TOP_N, registered
    from tallyfold.operators import breakdowns, periods
    from tallyfold.sources import tables
    from tallyfold.sources.star import star_facts

    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    builds = registered()
    times = {name: median_seconds(lambda name=name: builds[name](spark, SF_DIR)) for name in SECTIONS + OTHERS}
    times["report_separate"] = round(sum(times[name] for name in SECTIONS), 4)
    times["report_fused"] = median_seconds(lambda: builds["cost_report"](spark, SF_DIR))

    with tempfile.TemporaryDirectory(prefix="tallyfold-bench-") as folder:
        path = f"{folder}/facts"

        def load() -> None:
            tables.replace_table(star_facts(spark, SF_DIR), path, partition="month")

        times["load_facts"] = median_seconds(load)

        def stored(*spans):
            return tables.scan_cost_facts(spark, path, spans=spans)

        year = [DATES.prior_year.range, DATES.fiscal_year.range]
        times["stored_period_matrix"] = median_seconds(lambda: periods.period_matrix(stored(*year), DATES))
        times["stored_cto_costs"] = median_seconds(lambda: breakdowns.cto_costs(stored(DATES.ytd), DATES, TOP_N))
        times["stored_product_costs"] = median_seconds(
            lambda: breakdowns.product_costs(stored(DATES.ytd), DATES, TOP_N)
        )
        spark.stop()

    total = round(sum(times[name] for name in SECTIONS + OTHERS), 4)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR}
    print(json.dumps(line))


if __name__ == "__main__":
    sys.exit(main())
