"""Time the headline queries and the load jobs; print one JSON line.

Queries run once to warm up and then ``BENCH_RUNS`` times, the median counts.
The jobs load, curate and publish one year of days (365 partitions) into a
fresh lake, the workload of the published reference figures.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import os
import statistics
import sys
import time

from saldero.plans import jobs, report, warehouse
from saldero.session import build_session, scratch_path
from saldero.sources.lake import Lake
from testbed import tables as t
from testbed.queries import all_queries

HEADLINE = (
    "E_enriched_sales",
    "A1_kpi_daily",
    "A2_kpi_monthly",
    "A1_kpi_daily_lineitem",
    "A2_kpi_monthly_lineitem",
    "J1_kpi_over_tables",
    "Q_raw_issues",
    "Q_curated_issues",
    "Q_monthly_issues",
    "A6_metrics_by_region",
    "W1_moving_avg_7d",
    "W1_moving_avg_dealer",
    "W3_mom_lineitem",
    "O2_top10_lineitem",
    "R2_secondary_cards",
    "R5_waterfall_columns",
    "R8_dealer_matrix",
    "R10_daily_trend",
    "R11_daily_detail",
)
STORED = {
    "R2_over_stored_marts": report.secondary_cards,
    "R8_over_stored_marts": report.dealer_matrix,
    "R10_over_stored_marts": report.daily_trend,
}
YEAR = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run_query(spark, sf_dir: str, name: str) -> None:
    all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        run_query(spark, sf_dir, name)
        seconds[name] = statistics.median(
            timed(lambda n=name: run_query(spark, sf_dir, n)) for _ in range(runs)
        )
        print(name, seconds[name], file=sys.stderr, flush=True)

    lake, sales = Lake(scratch_path(spark, "bench")), t.sales(spark, sf_dir)
    seconds["job_backfill_365d"] = timed(lambda: jobs.backfill(sales, *YEAR, lake))
    seconds["job_curate_365d"] = timed(lambda: jobs.curate_range(spark, *YEAR, lake))
    seconds["job_warehouse_365d"] = timed(lambda: warehouse.refresh_warehouse(spark, lake))
    views = warehouse.open_marts(spark, lake)
    seconds["job_import_marts_365d"] = timed(lambda: warehouse.import_marts(spark, lake, views))

    stored_lake = Lake(scratch_path(spark, "bench-marts"))
    stored = warehouse.import_marts(spark, stored_lake, t.marts(spark, sf_dir))
    for name, build in STORED.items():
        question = functools.partial(build, stored, t.DEALER_SLICE)
        noop = lambda q=question: q().write.format("noop").mode("overwrite").save()
        noop()
        seconds[name] = statistics.median(timed(noop) for _ in range(runs))

    print(
        json.dumps(
            {
                "metric": "headline queries and one-year load jobs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
