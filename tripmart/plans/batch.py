"""End-to-end batch jobs: Bronze to marts, layer by layer on shared storage.

Each layer is written before the next reads it.  That is what makes long runs
survive executor loss, lets a failed layer be rerun alone, and gives the
optimizer real sizes for the dimension joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import core as core_ops
from ..operators import features, forecast, gold, marts, ml, publish, quality, silver
from ..sources import (
    read_table,
    read_zones,
    rewrite_partitions,
    write_partitioned,
    write_report,
)
from ..sources.envelopes import trips_to_envelope
from ..sources.writers import write_csv
from ..streaming import live


class Layout(NamedTuple):
    """Locations under one root."""

    root: str

    def __call__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _store(df: DataFrame, path: str, keys: Sequence[str], month: str | None) -> None:
    """The whole dataset, or the partitions of one month only."""
    (write_partitioned if month is None else rewrite_partitions)(df, path, keys)


def _layer(spark: SparkSession, path: str, month: str | None) -> DataFrame:
    """A stored layer, or the partitions of one month of it."""
    rows = read_table(spark, path)
    return rows if month is None else rows.filter(F.col("pickup_year_month") == month)


def trips_with_weather(
    bronze: dict[str, DataFrame],
    bronze_weather: DataFrame,
    *,
    start: str = K.WINDOW_START,
    end: str = K.WINDOW_END,
) -> tuple[DataFrame, DataFrame]:
    """(trips joined with weather, hourly weather) from Bronze frames by taxi type."""
    parsed = [silver.parse_trips(df, kind) for kind, df in bronze.items()]
    trips = silver.normalize_trips(*parsed, start=start, end=end)
    readings = silver.normalize_weather(silver.parse_weather(bronze_weather), start, end)
    weather = silver.hourly_weather(readings)
    return silver.join_weather(trips, weather, window=(start, end)), weather


def run_silver(
    spark: SparkSession,
    bronze: dict[str, str],
    bronze_weather: str,
    out: Layout,
    *,
    start: str = K.WINDOW_START,
    end: str = K.WINDOW_END,
    month: str | None = None,
) -> None:
    """Bronze paths to Silver hourly weather and trips.

    The weather table is stored first and read back, so the trip job does not
    compute it a second time.
    """
    parsed_weather = silver.parse_weather(read_table(spark, bronze_weather))
    readings = silver.normalize_weather(parsed_weather, start, end)
    _store(silver.hourly_weather(readings), out("hourly_weather"), ["weather_year_month"], month)
    parsed = [silver.parse_trips(read_table(spark, p), kind) for kind, p in bronze.items()]
    trips = silver.normalize_trips(*parsed, start=start, end=end)
    joined = silver.join_weather(
        trips,
        read_table(spark, out("hourly_weather")),
        window=(start, end),
    )
    _store(joined, out("taxi_weather_trips"), ["pickup_year_month", "taxi_type"], month)


def run_core(spark: SparkSession, out: Layout, month: str | None = None) -> None:
    trips = _layer(spark, out("taxi_weather_trips"), month)
    core = core_ops.build_core(trips)
    _store(core, out("taxi_weather_trips_core"), ["pickup_year_month"], month)


def run_clean(spark: SparkSession, out: Layout, month: str | None = None) -> None:
    core = _layer(spark, out("taxi_weather_trips_core"), month)
    clean = core_ops.build_clean(core)
    _store(clean, out("taxi_weather_trips_clean"), ["pickup_year_month"], month)


def run_core_quality(spark: SparkSession, out: Layout) -> None:
    core_path = out("taxi_weather_trips_core")
    core = read_table(spark, core_path)
    dataset = quality.Dataset("silver_core", core_path)
    report = quality.check_table(core, "core", dataset).unionByName(
        quality.lineage(read_table(spark, out("taxi_weather_trips")), core, dataset)
    )
    _report_and_enforce(spark, report, out("quality_reports/silver_core"))


def run_gold(spark: SparkSession, out: Layout, month: str | None = None) -> None:
    core = _layer(spark, out("taxi_weather_trips_core"), month)
    keys = ["pickup_year_month"]
    _store(gold.demand_features(core), out("gold_demand_features"), keys, month)
    _store(gold.fare_tip_features(core), out("gold_fare_tip_features"), keys, month)


def run_gold_quality(spark: SparkSession, out: Layout) -> None:
    tables = {"demand": "gold_demand_features", "fare_tip": "gold_fare_tip_features"}
    report = None
    for table, name in tables.items():
        dataset = quality.Dataset(name, out(name))
        one = quality.check_table(read_table(spark, out(name)), table, dataset)
        report = one if report is None else report.unionByName(one)
    _report_and_enforce(spark, report, out("quality_reports/gold"))


def run_marts(
    spark: SparkSession, out: Layout, zone_file: str, month: str | None = None
) -> None:
    demand = _layer(spark, out("gold_demand_features"), month)
    fare_tip = _layer(spark, out("gold_fare_tip_features"), month)
    zones = marts.pickup_zones(read_zones(spark, zone_file))
    built = {
        "dashboard_hourly_demand_kpi": marts.hourly_kpi(demand, unique_key=True),
        "dashboard_zone_summary": marts.zone_summary(demand, zones),
        "dashboard_payment_tip_summary": marts.payment_tip_summary(fare_tip),
    }
    for name, mart in built.items():
        _store(mart, out(name), ["pickup_year_month"], month)


# Published table: mart, kind of its metrics, measure that is summed.
PUBLISHED = {
    "dashboard_hourly_demand_kpi": ("mart", "total_demand"),
    "dashboard_zone_summary": ("mart", "total_demand"),
    "dashboard_payment_tip_summary": ("mart", "trip_count"),
}


def run_publish(spark: SparkSession, out: Layout, warehouse: str) -> dict[str, int]:
    """Stage all marts as new versions, then make them visible in one step."""
    store = publish.Warehouse(spark, warehouse)
    staged = {
        name: store.stage(name, read_table(spark, out(name)), kind, measure=measure)
        for name, (kind, measure) in PUBLISHED.items()
    }
    return store.promote(staged, {name: out(name) for name in staged})


def run_validate(spark: SparkSession, out: Layout, warehouse: str) -> None:
    """Compare what readers see with the marts and close the open runs."""
    store = publish.Warehouse(spark, warehouse)
    for name, (kind, measure) in PUBLISHED.items():
        store.validate(name, read_table(spark, out(name)), kind, measure=measure)


def run_score(spark: SparkSession, out: Layout, model_path: str, start: str) -> None:
    """Predict demand for the hours from ``start`` on with a saved model.

    Writes the scored rows and, as CSV, the hold-out export with one row per zone
    and hour.
    """
    rows = features.demand_features(read_table(spark, out("gold_demand_features")))
    _, later = ml.hold_out(rows, start)
    scored = forecast.score_demand(ml.predict(PipelineModel.load(model_path), later))
    write_partitioned(scored, out("demand_scores"), ["pickup_year_month"])
    export = ["pickup_hour", "pu_location_id", "zone_name", "demand", "predicted_demand", "abs_error"]
    write_csv(read_table(spark, out("demand_scores")).select(*export), out("demand_holdout_csv"))


def run_produce(spark: SparkSession, source: str, out: Layout) -> None:
    """Trip files as they arrive in a folder to event envelopes under ``events``.

    File names tell the taxi type.  Every file is read once, as the checkpoint
    records; the run ends when all files present are done.
    """
    schema = read_table(spark, source).schema
    trips = spark.readStream.schema(schema).parquet(source)
    live.drain(trips_to_envelope(trips), out("events"), out("_checkpoints/produce"))


def run_all(
    spark: SparkSession,
    bronze: dict[str, str],
    bronze_weather: str,
    zone_file: str,
    out: Layout,
    *,
    start: str = K.WINDOW_START,
    end: str = K.WINDOW_END,
) -> None:
    run_silver(spark, bronze, bronze_weather, out, start=start, end=end)
    run_core(spark, out)
    run_core_quality(spark, out)
    run_clean(spark, out)
    run_gold(spark, out)
    run_gold_quality(spark, out)
    run_marts(spark, out, zone_file)


def run_backfill(
    spark: SparkSession,
    bronze: dict[str, str],
    bronze_weather: str,
    zone_file: str,
    out: Layout,
    month: str,
) -> None:
    """One month again, from Bronze to the marts, in the place of what the layers have of it.

    Every layer keys its partitions by month and derives a month from that month alone, so
    the others are neither read nor written.  Quality gates run over the layers as they
    then are.  A month without trips in Bronze is refused and changes nothing.
    """
    first = date.fromisoformat(f"{month}-01")
    after = (first + timedelta(days=32)).replace(day=1)
    window = {"start": first.isoformat(), "end": after.isoformat()}
    parsed = [silver.parse_trips(read_table(spark, p), kind) for kind, p in bronze.items()]
    if silver.normalize_trips(*parsed, **window).isEmpty():
        raise ValueError(f"no trips of {month} in Bronze")
    run_silver(spark, bronze, bronze_weather, out, **window, month=month)
    run_core(spark, out, month)
    run_core_quality(spark, out)
    run_clean(spark, out, month)
    run_gold(spark, out, month)
    run_gold_quality(spark, out)
    run_marts(spark, out, zone_file, month)


def _report_and_enforce(spark: SparkSession, report: DataFrame, path: str) -> None:
    """Store the report, then raise on failed checks as stored."""
    write_report(report, path)
    quality.enforce(spark.read.json(path))
