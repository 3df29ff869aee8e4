"""Headline queries and pipeline stages, timed.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 2, the best of which counts) configure the run.  Every query
is executed in full; results are discarded by the noop sink.  Queries build what
they need from the raw tables.  Stages (``stage_*``) read stored layers, written
once before with many row groups and outside the timing, so each is timed alone.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tripmart import catalog  # noqa: E402
from tripmart.catalog import shapes  # noqa: E402
from tripmart.operators import core, gold, marts, profile, silver  # noqa: E402
from tripmart.plans import dashboard  # noqa: E402
from tripmart.session import build_session, materialize  # noqa: E402

HEADLINE = [
    "zone_demand_from_json",
    "normalize_trips",
    "core_table",
    "clean_impute",
    "demand_by_zone_hour",
    "fare_tip_features",
    "hourly_kpi",
    "zone_summary",
    "payment_tip_summary",
    "payment_tip_summary_exact",
    "zone_summary_share",
    "summary",
    "trend_weekday",
    "demand_features",
    "demand_lags_time",
    "trips_zone_join",
    "route_estimates",
    "null_profile",
    "distribution",
    "quality_summary",
    "volume_zone_share",
    "volume_payment_summary",
    "volume_median_exact",
    "volume_median_approx",
    "volume_dedup",
    "volume_double_join",
    "volume_quality",
]

MEASURED = ["trip_distance", "fare_amount", "total_amount", "tip_amount", "temperature_f"]


def stages(spark: SparkSession, sf_dir: str, cpus: int) -> dict[str, Callable[[], DataFrame]]:
    """The batch stages, each over its stored input in a few files per core."""

    def stored(df: DataFrame, label: str) -> DataFrame:
        return materialize(df.repartition(4 * cpus), label)

    bronze = stored(shapes.bronze_trips(spark, sf_dir), "bench-bronze")
    trips = stored(shapes.typed_trips(spark, sf_dir), "bench-trips")
    weather = materialize(shapes.typed_weather(spark, sf_dir), "bench-weather")
    joined = stored(silver.join_weather(trips, weather, window=shapes.DAYS), "bench-joined")
    facts = stored(core.build_core(joined), "bench-core")
    demand = stored(gold.demand_features(facts), "bench-demand")
    fares = stored(gold.fare_tip_features(facts), "bench-fares")
    zones = materialize(marts.pickup_zones(shapes.zone_table(spark, sf_dir)), "bench-zones")
    clean = stored(core.build_clean(facts), "bench-clean")
    hourly = materialize(marts.hourly_kpi(demand, unique_key=True), "bench-hourly")
    payment = materialize(marts.payment_tip_summary(fares), "bench-payment")
    months = tuple(dashboard.month_extent(hourly).first())
    return {
        "stage_silver": lambda: silver.normalize_trips(silver.parse_trips(bronze, "yellow")),
        "stage_weather_join": lambda: silver.join_weather(trips, weather, window=shapes.DAYS),
        "stage_core": lambda: core.build_core(joined),
        "stage_gold_demand": lambda: gold.demand_features(facts),
        "stage_gold_fares": lambda: gold.fare_tip_features(facts),
        "stage_mart_hourly": lambda: marts.hourly_kpi(demand, unique_key=True),
        "stage_mart_zones": lambda: marts.zone_summary(demand, zones),
        "stage_mart_payment": lambda: marts.payment_tip_summary(fares),
        "stage_summary": lambda: dashboard.summary(hourly, payment, *months),
        "stage_distribution": lambda: profile.distribution(clean, MEASURED, exact=True),
        "stage_mart_payment_exact": lambda: marts.payment_tip_summary(fares, exact_median=True),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "tripmart-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    work = {name: (lambda f=queries[name]: f(spark, sf_dir)) for name in HEADLINE}
    work |= stages(spark, sf_dir, int(cpus))
    timings: dict[str, float] = {}
    for name in sys.argv[1:] or work:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            work[name]().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        timings[name] = round(best, 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings[n] for n in timings if n in HEADLINE), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
