from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart import constants as K
from tripmart.operators import core as core_ops
from tripmart.operators import geo, gold, marts, profile, publish, quality, silver
from tripmart.operators.joins import of_hours
from tripmart.sources import read_report, write_report

from .test_core_gold_marts import trips


@pytest.fixture(scope="module")
def core(spark):
    rows = [{"do_location_id": n % 5 + 1, "passenger_count": None if n == 0 else 1.0,
             "trip_distance": 0.0 if n == 1 else 2.0} for n in range(10)]
    return core_ops.build_core(trips(spark, rows)).cache()


def by_name(report):
    return {r.check_name: r for r in report.collect()}


def test_core_has_68_checks_and_gold_75(spark, core):
    report = quality.check_table(core, "core").unionByName(quality.lineage(core, core))
    assert report.count() == 68 and quality.failed(report).count() == 0
    demand = quality.check_table(gold.demand_features(core), "demand")
    fares = quality.check_table(gold.fare_tip_features(core), "fare_tip")
    assert demand.count() + fares.count() == 75
    assert quality.failed(demand.unionByName(fares)).count() == 0
    checks = by_name(report)
    assert checks["known_nullable_null_passenger_count"].check_value == "1"
    assert checks["known_nullable_null_passenger_count"].details == "ratio=0.10000000"
    assert checks["outlier_rows"].check_value == "1"


def test_schema_contract_reports_missing_extra_and_wrong_types(core):
    changed = core.drop("airport_fee").withColumn("tip", F.lit(1)).withColumn(
        "vendor_id", F.col("vendor_id").cast("int"))
    checks = by_name(quality.schema_contract(changed, K.CORE_CONTRACT))
    assert checks["schema_airport_fee"].status == "fail"
    assert checks["schema_vendor_id"].check_value == "int"
    assert checks["schema_extra_columns"].status == "pass"
    assert checks["schema_missing_columns"].status == "fail"


def test_failing_checks_are_reported_then_raised(spark, core, tmp_path):
    broken = gold.demand_features(core).unionAll(gold.demand_features(core)).withColumn(
        "demand", F.lit(0))
    report = quality.check_table(broken, "demand")
    path = str(tmp_path / "report")
    write_report(report, path)
    stored = read_report(spark, path)
    failed = {r.check_name for r in quality.failed(stored).collect()}
    assert failed == {"non_positive_demand_rows", "duplicate_pu_location_pickup_hour_groups"}
    with pytest.raises(quality.QualityError, match="non_positive_demand_rows"):
        quality.enforce(stored)
    quality.enforce(report.filter("status = 'pass'"))
    kinds = {(r.check_kind, r.status): r.check_count for r in quality.summarize(stored).collect()}
    assert kinds[("value", "fail")] == 2 and kinds[("schema", "pass")] == 12


def test_value_checks_of_a_table_share_one_scan(core, plan_of):
    plan = plan_of(quality.null_checks(core, K.CORE_REQUIRED, K.CORE_NULLABLE))
    assert plan.count("InMemoryTableScan") == 1


def test_constraints(spark, core):
    demand = gold.demand_features(core)
    assert quality.failed(quality.constraints(demand, "demand")).count() == 0
    bad = demand.withColumn("hour", F.lit(24)).withColumn("month", F.lit(None).cast("tinyint"))
    failed = {r.check_name for r in quality.failed(quality.constraints(bad, "demand")).collect()}
    assert failed == {"check_hour", "not_null_month"}


def test_lineage_without_source_is_skipped(core):
    row = quality.lineage(None, core).first()
    assert (row.check_value, row.status) == ("skipped", "pass")
    unequal = by_name(quality.lineage(core, core.limit(3)))
    assert unequal["core_matches_enriched_count"].status == "fail"


def test_audits(core):
    clean = core_ops.build_clean(core)
    audit = {r.original_column: r for r in quality.imputation_audit(clean).collect()}
    assert audit["passenger_count"].original_null_count == 1
    assert {r.status for r in audit.values()} == {"pass"}
    tampered = clean.withColumn("passenger_count_clean", F.lit(7).cast("smallint"))
    row = {r.original_column: r for r in quality.imputation_audit(tampered).collect()}
    assert row["passenger_count"].imputation_violations == 1
    assert row["passenger_count"].preservation_violations == 9
    assert quality.candidate_ratio(clean).first().gold_candidate_ratio == 0.9
    assert quality.outlier_profile(clean).first().invalid_distance_rows == 1
    kept = quality.retention(core, clean.limit(5)).first()
    assert kept.rows_rejected_for_missing_critical_fields == 5


def test_reconcile_flags_missing_and_different(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", None)], "check_name string, check_value string")
    b = spark.createDataFrame([("x", "1"), ("y", "3"), ("z", None), ("w", "4")], "check_name string, check_value string")
    assert {r.check_name: r.status for r in quality.reconcile(a, b).collect()} == {
        "x": "pass", "y": "fail", "z": "pass", "w": "fail"}


def test_weather_conformance(spark, core):
    weather = spark.createDataFrame(
        [(datetime(2024, 1, 6, 8), 34.0, 50.0, 0.5, 3, 5.0, 90.0, 10.0)],
        "weather_hour timestamp, temperature_f double, humidity_percent double, "
        "precipitation_mm double, weather_code int, wind_speed_kmh double, "
        "wind_direction_deg double, cloud_cover_percent double")
    row = quality.weather_conformance(core, weather).first()
    assert row.hours_missing_in_weather == 0 and row.mismatched_temperature_f == 0
    assert row.mismatched_precipitation_mm == 10
    none = quality.weather_conformance(core, weather.filter("false")).first()
    assert none.hours_missing_in_weather == 1 and none.trips_without_weather_hour == 10


def test_continuity(spark):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t0 + timedelta(hours=h)) for h in (0, 1, 4, 6)],
                               "zone int, pickup_hour timestamp")
    gaps = [r.missing_pickup_hour.hour for r in quality.continuity(df, "zone").collect()]
    assert sorted(gaps) == [2, 3, 5]


def test_profiles(core):
    nulls = {r.column_name: r for r in profile.nulls(core, ["passenger_count", "absent"]).collect()}
    assert nulls["passenger_count"].null_ratio == 0.1 and nulls["absent"].status == "missing"
    counts = profile.counts_by(core, ["taxi_type", "do_location_id", "absent"]).collect()
    assert sum(r.row_count for r in counts if r.dimension == "do_location_id") == 10
    assert {r.dimension for r in counts} == {"taxi_type", "do_location_id"}
    dist = {r.column_name: r for r in profile.distribution(core, ["fare_amount", "x"]).collect()}
    assert list(dist) == ["fare_amount"] and dist["fare_amount"].p50 == 10.0
    shape = {(r.dimension, r.value): r.trip_count for r in profile.demand_shape(core).collect()}
    assert shape[("hour_of_day", "8")] == 10 and shape[("taxi_type", "yellow")] == 10
    assert profile.duplicates(core, ["do_location_id"]).count() == 5


def test_json_fields_read_every_payload(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": 3}',), ("{broken",)], "json_data string")
    rows = {r.expected_field: r for r in profile.json_fields(df, ["a", "b", "c"]).collect()}
    assert [rows[f].present_rows for f in "abc"] == [2, 1, 0]
    assert rows["a"].unreadable_rows == 1
    assert profile.payloads(df).first().event_rows == 3


# --- Publication -------------------------------------------------------------


@pytest.fixture
def mart(spark, tmp_path):
    def build(name, total):
        df = spark.createDataFrame([(1, total), (2, 5)], "zone int, total_demand int").withColumns(
            {c: F.lit(datetime(2025, 1, 1)) for c in
             ("source_gold_processed_timestamp", "dashboard_processed_timestamp")})
        path = str(tmp_path / name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return build


def status_of(warehouse):
    return {(r.target_table, r.publish_run_id): r for r in warehouse.runs().collect()}


def test_publication_cycle(spark, mart, tmp_path):
    store = publish.Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(LookupError):
        store.read("zones")
    first, second = mart("one", 10), mart("two", 20)
    ids = store.promote({"zones": store.stage("zones", first, "mart")}, {"zones": "one"})
    assert store.read("zones").agg(F.sum("total_demand")).first()[0] == 15
    assert store.pending_run("zones") == ids["zones"]

    # A version that was staged but not promoted stays invisible.
    staged = store.stage("zones", second, "mart")
    assert store.read("zones").agg(F.sum("total_demand")).first()[0] == 15

    again = store.promote({"zones": store.stage("zones", second, "mart", reuse=staged)}, {"zones": "two"})
    runs = status_of(store)
    assert runs[("zones", ids["zones"])].status == "failed"
    assert runs[("zones", ids["zones"])].details == publish.SUPERSEDED_NOTE
    assert runs[("zones", again["zones"])].status == "started"
    assert store.read("zones").agg(F.sum("total_demand")).first()[0] == 25

    results = store.validate("zones", second, "mart")
    assert results.count() == 6 and quality.failed(results).count() == 0
    assert status_of(store)[("zones", again["zones"])].status == "passed"
    with pytest.raises(LookupError):
        store.pending_run("zones")


def test_mismatch_is_recorded_and_raised(spark, mart, tmp_path):
    store = publish.Warehouse(spark, str(tmp_path / "wh2"))
    one, other = mart("three", 1), mart("four", 2)
    ids = store.promote({"zones": store.stage("zones", one, "mart")}, {"zones": "x"})
    with pytest.raises(quality.QualityError):
        store.validate("zones", other, "mart")
    assert status_of(store)[("zones", ids["zones"])].status == "failed"
    assert quality.failed(store.results()).count() == 1
    with pytest.raises(quality.QualityError):
        store.stage("zones", other, "mart", reuse=store.current_path("zones"))


def test_several_tables_switch_in_one_append(spark, mart, tmp_path):
    store = publish.Warehouse(spark, str(tmp_path / "wh3"))
    df = mart("five", 3)
    staged = {n: store.stage(n, df, "mart") for n in ("a", "b", "c")}
    ids = store.promote(staged, {n: n for n in staged})
    assert len(set(ids.values())) == 3
    assert len(store.run_log().inputFiles()) == 1


@pytest.mark.parametrize("kind", ["demand", "fare_tip", "mart"])
def test_pushed_down_metrics_equal_ours(spark, core, tmp_path, kind):
    """The SQL a database would run, checked in DuckDB on the same stored rows."""
    import duckdb

    stamp = F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz")
    table = {
        "demand": lambda: gold.demand_features(core).withColumns(
            {"gold_processed_timestamp": stamp, "pickup_hour": F.col("pickup_hour").cast("timestamp_ntz")}),
        "fare_tip": lambda: gold.fare_tip_features(core).withColumn("gold_processed_timestamp", stamp),
        "mart": lambda: core.select(
            F.col("do_location_id").cast("int").alias("total_demand"),
            stamp.alias("source_gold_processed_timestamp"),
            stamp.alias("dashboard_processed_timestamp")),
    }[kind]()
    path = str(tmp_path / kind)
    table.write.parquet(path)
    sql = publish.metrics_query(f"'{path}/*.parquet'", kind)
    row = duckdb.connect().execute(sql)
    names = [d[0] for d in row.description]
    theirs = dict(zip(names, [str(v) for v in row.fetchall()[0]], strict=True))
    ours = {r.check_name: r.check_value
            for r in publish.metrics(spark.read.parquet(path), kind).collect()}
    assert ours == theirs


# --- Geometry -----------------------------------------------------------------


def test_polygon_centroids(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    hole = [(2, 2), (2, 4), (4, 4), (4, 2)]
    shapes = {
        ("open", 0): square,
        ("closed", 0): [*square, square[0]],
        ("holed", 0): square,
        ("holed", 1): hole,
        ("short", 0): square,
        ("short", 1): [(9, 9), (10, 10)],
        ("flat", 0): [(0, 0), (1, 1), (2, 2)],
    }
    rows = [(p, r, i, float(x), float(y)) for (p, r), pts in shapes.items()
            for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "polygon_id string, ring_id int, seq int, x double, y double")
    got = {r.polygon_id: r for r in geo.polygon_centroids(df).collect()}
    for name in ("open", "closed", "short"):
        assert (got[name].centroid_x, got[name].centroid_y) == pytest.approx((2, 2))
    want = (16 * 2 - 4 * 3) / 12
    assert (got["holed"].centroid_x, got["holed"].centroid_y) == pytest.approx((want, want))
    assert not got["flat"].has_area and got["flat"].centroid_x is None


def test_failures_are_counted_in_full(spark):
    checks = spark.range(250).select(
        F.format_string("c%03d", "id").alias("check_name"), F.lit("1").alias("check_value"),
        F.lit("fail").alias("status"))
    with pytest.raises(quality.QualityError, match="250 checks failed: c000=1.*150 more not listed"):
        quality.enforce(checks)


def test_transport_dedup_reads_its_input_once(spark, tmp_path, plan_of):
    rows = [("t", 0, 1, "a"), ("t", 0, 1, "a"), ("t", 0, None, "b"), ("t", 0, None, "b"), ("t", 1, 1, "c")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, v string")
    df = df.withColumn("kafka_timestamp", F.lit("2024-01-01").cast("timestamp"))
    df.write.parquet(str(tmp_path / "log"))
    unique = silver.dedup_transport(spark.read.parquet(str(tmp_path / "log")))
    assert plan_of(unique).count("FileScan") == 1
    assert sorted(r.v for r in unique.collect()) == ["a", "b", "b", "c"]


def test_weather_hours_are_bounded_before_a_broadcast(spark):
    hours = [("2024-01-01T00:00:00",), ("2024-01-01T00:00:00",), ("2024-01-02T23:00:00",),
             ("2024-01-03T00:00:00",), ("2024-01-01T00:30:00",)]
    df = spark.createDataFrame(hours, "h string").select(F.col("h").cast("timestamp").alias("h"))
    assert of_hours(df, "h", "2024-01-01", "2024-01-02").count() == 2


def test_zone_names_take_one_row_per_id(spark):
    mart = spark.createDataFrame(
        [(1, "x", "y", 5)], "pu_location_id smallint, pickup_borough string, pickup_zone string, n int")
    lookup = spark.createDataFrame(
        [(1, "b", "z"), (1, "a", "z"), (70_000, "c", "z")], "location_id int, borough string, zone string")
    rows = marts.refresh_zone_names(mart, lookup).collect()
    assert [(r.pickup_borough, r.n) for r in rows] == [("a", 5)]


def test_another_open_run_is_noticed(spark, tmp_path, monkeypatch):
    store = publish.Warehouse(spark, str(tmp_path / "w"))
    df = spark.createDataFrame([(1, 10)], "zone int, total_demand int").withColumns(
        {c: F.lit("2024-01-01").cast("timestamp") for c in
         ("source_gold_processed_timestamp", "dashboard_processed_timestamp")})
    path = str(tmp_path / "src")
    df.write.parquet(path)
    staged = store.stage("zones", spark.read.parquet(path), "mart")
    store.promote({"zones": staged}, {"zones": "one"})
    # A publisher that did not see the open run leaves two of them.
    real = store.runs
    monkeypatch.setattr(store, "runs", lambda: real().limit(0) if not seen else real())
    seen = []
    append = store._append
    monkeypatch.setattr(store, "_append", lambda *a: (append(*a), seen.append(1)))
    with pytest.raises(RuntimeError, match="another publisher"):
        store.promote({"zones": staged}, {"zones": "two"})


def test_exact_distribution_takes_all_figures_from_value_counts(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    far = (1e9 + rng.integers(0, 40, 999) / 8).tolist()
    rows = [(v, float(i % 7), None if i % 3 else i, None) for i, v in enumerate(far)]
    df = spark.createDataFrame(rows, "far double, small float, some int, none double")
    got = {r.column_name: r for r in profile.distribution(df, [*df.columns, "absent"], exact=True).collect()}
    assert set(got) == set(df.columns)
    for at, name in enumerate(df.columns[:3]):
        values = np.sort(np.array([r[at] for r in rows if r[at] is not None], float))
        row = got[name]
        assert (row.non_null_count, row.min_value, row.max_value) == (len(values), values[0], values[-1])
        assert row.avg_value == pytest.approx(values.mean(), rel=1e-12)
        assert row.stddev_value == pytest.approx(values.std(ddof=1), rel=1e-9)
        for q, share in (("p25", 25), ("p50", 50), ("p99", 99)):
            assert row[q] == values[max(1, -(-len(values) * share // 100)) - 1]
    none = got["none"]
    assert none.non_null_count == 0 and none.avg_value is none.p50 is none.stddev_value is None
    one = profile.distribution(df.limit(1), ["small"], exact=True).first()
    assert one.stddev_value is None and one.p95 == one.max_value
