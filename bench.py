"""Time the query catalogue and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query).
The derived input tables are written first and timed as ``prepare_sec``; every query is then run to
completion without collecting its rows, and its best run counts (``spread``: worst less best). The three
runs of one period, with their gates, merges and writes, are timed as ``period_runs``; they and the
preparation are not part of the total, which stays comparable.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from returns_analytics.operators import risk, trees
from returns_analytics.parity import oracle
from returns_analytics.parity.fixtures import PERIOD, Fixtures
from returns_analytics.parity.queries import CATALOG
from returns_analytics.plans import pipelines
from returns_analytics.plans.runs import Inputs, Store, run_defaulters, run_monthly, run_office_revenue
from returns_analytics.session import tune
from returns_analytics.sources.sinks import staging_folder


def run(frame) -> float:
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("returns-analytics-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixtures = Fixtures(tune(spark), folder)

    start = time.perf_counter()
    for query in CATALOG.values():
        query.plan(fixtures)
    prepare = time.perf_counter() - start

    seconds, spread = {}, {}
    for name in CATALOG:
        # a plan is built anew for each run, so that planning is part of the time
        took = [_timed(name, fixtures) for _ in range(runs)]
        seconds[name], spread[name] = round(min(took), 3), round(max(took) - min(took), 3)
    rows = fixtures.table("summary").count()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "prepare_sec": round(prepare, 3),
        "spread": spread,
        "period_runs": _period_runs(fixtures),
        "summary_rows": rows,
        "summary_rows_per_sec": {
            name: round(rows / seconds[name])
            for name in ("growth_analytics", "growth_analytics_unique", "risk_profile", "office_revenue")
        },
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus),
    }))
    spark.stop()


def _period_runs(fixtures: Fixtures) -> dict[str, float]:
    """Seconds of each run of one period into empty stores."""
    spark, now = fixtures.spark, dt.datetime(2000, 8, 15)
    inputs = Inputs(*[fixtures.table(name) for name in ("summary", "registration", "dealer", "juri", "due")])
    model = trees.load_model(oracle.MODEL_PATH, risk.FEATURES)
    growth = fixtures.keep("growth", lambda: pipelines.growth_analytics(inputs.summary))
    profile = fixtures.keep("risk", lambda: pipelines.risk_profile(inputs.summary, model)[0])
    store = Store(f"{staging_folder(spark)}/bench")
    took = {}
    for name, act in (
        ("monthly", lambda: run_monthly(inputs, store, model, PERIOD, now, 1)),
        ("defaulters", lambda: run_defaulters(inputs, store, growth, profile, PERIOD, now.date(), now, "bench")),
        ("office_revenue", lambda: run_office_revenue(inputs, store, PERIOD, now, "bench")),
    ):
        start = time.perf_counter()
        act()
        took[name] = round(time.perf_counter() - start, 3)
    return took


def _timed(name: str, fixtures: Fixtures) -> float:
    start = time.perf_counter()
    frame = CATALOG[name].frame(fixtures)
    return time.perf_counter() - start + run(frame)


if __name__ == "__main__":
    main()
