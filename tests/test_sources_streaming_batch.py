import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart import constants as K
from tripmart.operators import publish, silver
from tripmart.plans.batch import Layout, run_all, run_produce, run_publish, run_validate
from tripmart.session import shared_dir
from tripmart.sources import (
    collect_small,
    path_status,
    read_jdbc,
    read_tagged_union,
    read_zones,
    sample,
    trips_to_envelope,
    try_read,
    weather_to_envelope,
    write_csv,
    write_partitioned,
)
from tripmart.streaming import bronze, live

T0 = datetime(2024, 1, 1)


# --- Sources and sinks ----------------------------------------------------------


def test_zone_file_layout_is_checked(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("LocationID,Borough,Zone,Latitude,Longitude\n1,EWR,Newark Airport,40.69,-74.17\n"
                    "2,Queens,Jamaica Bay,,\n")
    bad.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n')
    rows = read_zones(spark, str(good)).orderBy("location_id").collect()
    assert rows[0].zone == "Newark Airport" and rows[1].latitude is None
    with pytest.raises(Exception, match="(?i)header|column"):
        read_zones(spark, str(bad)).collect()


def test_partitioned_write_and_tagged_union(spark, tmp_path):
    df = spark.range(100).select(
        F.when(F.col("id") < 90, "2024-01").otherwise("2024-02").alias("pickup_year_month"), "id")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    write_partitioned(df, a, ["pickup_year_month"])
    write_partitioned(df.withColumn("extra", F.lit(1)), b, [])
    assert (tmp_path / "a" / "pickup_year_month=2024-02").is_dir()
    union = read_tagged_union(spark, {"yellow": a, "green": b})
    counts = {r[0]: r[1] for r in union.groupBy("taxi_type_from_path").count().collect()}
    assert counts == {"yellow": 100, "green": 100}
    assert try_read(spark, str(tmp_path / "none")) is None
    status = {r.dataset_name: r.status for r in
              path_status(spark, {"a": a, "none": str(tmp_path / "none")}).collect()}
    assert status == {"a": "available", "none": "missing"}
    write_csv(df.limit(3), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == df.columns


def test_small_results_only(spark):
    assert len(collect_small(spark.range(10), 10)) == 10
    with pytest.raises(ValueError):
        collect_small(spark.range(11), 10)
    part = sample({"yellow": spark.range(50), "green": spark.range(3)}, 5)
    assert part.count() == 8
    part.unpersist()


def test_jdbc_options_are_checked(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", query="select 1", partition_column="id")


def test_trip_envelopes_keep_nulls_micros_and_zones(spark):
    trips = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 8, 0, 0, 123456), 132, 999, None)],
        "VendorID bigint, tpep_pickup_datetime timestamp, PULocationID bigint, "
        "DOLocationID bigint, airport_fee double")
    zones = spark.createDataFrame([(132, "Queens", "JFK Airport", 40.6, -73.8)],
                                  "location_id bigint, borough string, zone string, "
                                  "latitude double, longitude double")
    name = F.lit("yellow_tripdata_2024-01.parquet")
    row = trips_to_envelope(trips, source_file=name, zones=zones).first()
    doc = json.loads(row.value)
    assert row.topic == "nyc_taxi_yellow" and doc["_taxi_type"] == "yellow"
    assert doc["tpep_pickup_datetime"] == doc["pickup_datetime"] == "2024-01-01T08:00:00.123456"
    assert doc["airport_fee"] is None and doc["pickup_zone_name"] == "JFK Airport"
    assert doc["dropoff_zone_name"] is None
    with pytest.raises(Exception, match="no taxi type"):
        trips_to_envelope(trips, source_file=F.lit("trips.parquet")).collect()


def test_weather_response_to_events(spark):
    body = json.dumps({"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                  "temperature_2m": [30.5, None], "weather_code": [61, None]}})
    rows = weather_to_envelope(spark.createDataFrame([(body,)], "body string")).collect()
    docs = [json.loads(r.value) for r in rows]
    assert [d["timestamp"] for d in docs] == ["2024-01-01T00:00", "2024-01-01T01:00"]
    assert docs[0]["weather_description"] == "Slight rain" and docs[0]["temperature_f"] == 30.5
    assert docs[1]["weather_description"] is None and docs[1]["temperature_f"] is None


# --- Streaming --------------------------------------------------------------------


def log_records(spark, offsets, value=b"{}"):
    rows = [(None, value, "nyc_taxi_yellow", 0, o, T0 + timedelta(minutes=o), 0) for o in offsets]
    return spark.createDataFrame(rows, bronze.LOG_SCHEMA)


def test_bronze_stream_resumes_without_duplicates(spark, tmp_path):
    source, sink = str(tmp_path / "log"), str(tmp_path / "bronze")
    checkpoint = str(tmp_path / "checkpoint")

    def ingest():
        events = bronze.read_envelope_stream(spark, source, max_files_per_trigger=1)
        feed = bronze.Feed(events, *bronze.topic_tag("nyc_taxi_yellow"), sink, checkpoint)
        bronze.run_ingestion(spark, [feed])

    log_records(spark, range(5)).write.parquet(source)
    ingest()
    ingest()
    assert spark.read.parquet(sink).count() == 5
    log_records(spark, range(5, 8)).write.mode("append").parquet(source)
    ingest()
    stored = spark.read.parquet(sink)
    assert sorted(r.offset for r in stored.collect()) == list(range(8))
    assert {r.taxi_type for r in stored.collect()} == {"yellow"}
    assert dict(stored.dtypes)["json_data"] == "string"


def test_failing_feed_stops_the_others(spark, tmp_path):
    source = str(tmp_path / "log")
    log_records(spark, range(2)).write.parquet(source)
    events = bronze.read_envelope_stream(spark, source)
    broken = events.withColumn("value", F.raise_error(F.lit("boom")).cast("binary"))
    feeds = [bronze.Feed(e, "taxi_type", "yellow", str(tmp_path / f"o{i}"), str(tmp_path / f"c{i}"))
             for i, e in enumerate((events, broken))]
    with pytest.raises(Exception, match="boom"):
        bronze.run_ingestion(spark, feeds)
    assert not spark.streams.active


def test_topic_tags():
    assert bronze.topic_tag("weather_stream") == ("data_type", "weather")
    assert bronze.topic_tag("nyc_taxi_green") == ("taxi_type", "green")


def test_streamed_demand_equals_batch_for_closed_hours(spark, tmp_path):
    source = str(tmp_path / "trips")
    rows = [(T0 + timedelta(minutes=17 * n), n % 3) for n in range(120)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, pu_location_id int")
    df.write.parquet(source)
    stream = live.stream_demand(spark.readStream.schema(df.schema).parquet(source))
    live.drain(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = df.groupBy("pu_location_id", F.date_trunc("hour", "pickup_datetime").alias("pickup_hour")).agg(
        F.count("*").cast("int").alias("demand"))
    closed = rows[-1][0] - timedelta(hours=1)
    want = batch.filter(F.col("pickup_hour") + F.expr("interval 1 hour") <= F.lit(closed))
    assert streamed.count() > 50
    assert streamed.exceptAll(want).count() == 0 and want.exceptAll(streamed).count() == 0


def test_stream_dedup_within_watermark(spark, tmp_path):
    source = str(tmp_path / "log")
    log_records(spark, [1, 1, 2, 3, 3, 3]).write.parquet(source)
    unique = live.dedup_stream(bronze.read_envelope_stream(spark, source), "timestamp")
    live.drain(unique.select("offset"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


# --- Whole batch run -----------------------------------------------------------------


def test_bronze_to_marts(spark, tmp_path):
    def trip(n, hour):
        pickup = T0 + timedelta(hours=hour, minutes=n)
        return json.dumps({
            "VendorID": 1, "tpep_pickup_datetime": pickup.isoformat(),
            "tpep_dropoff_datetime": (pickup + timedelta(minutes=9)).isoformat(),
            "passenger_count": 1.0, "trip_distance": 1.0 + n, "RatecodeID": 1.0,
            "PULocationID": 1 + n % 2, "DOLocationID": 2, "payment_type": 1.0, "fare_amount": 10.0,
            "extra": 0.0, "mta_tax": 0.5, "tip_amount": 2.0, "tolls_amount": 0.0,
            "improvement_surcharge": 1.0, "total_amount": 13.5, "_source_file": "y"})

    trips = [("t", 0, i, T0, trip(n, h)) for i, (h, n) in
             enumerate((h, n) for h in range(4) for n in range(6))]
    weather = [("w", 0, h, T0, json.dumps({
        "timestamp": (T0 + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M"), "temperature_f": 30.0,
        "humidity_percent": 50.0, "precipitation_mm": 0.0, "weather_code": 3,
        "wind_speed_kmh": 5.0, "wind_direction_deg": 10.0, "cloud_cover_percent": 80.0}))
        for h in range(4)]
    schema = ("topic string, partition int, offset bigint, kafka_timestamp timestamp, "
              "json_data string")
    paths = {n: str(tmp_path / n) for n in ("yellow", "weather")}
    spark.createDataFrame(trips + trips[:3], schema).write.parquet(paths["yellow"])
    spark.createDataFrame(weather, schema).write.parquet(paths["weather"])
    zone_file = tmp_path / "zones.csv"
    zone_file.write_text("LocationID,Borough,Zone,Latitude,Longitude\n1,EWR,Newark Airport,40.69,-74.17\n")
    out = Layout(str(tmp_path / "lake"))
    run_all(spark, {"yellow": paths["yellow"]}, paths["weather"], str(zone_file), out)

    core = spark.read.parquet(out("taxi_weather_trips_core"))
    assert core.count() == 24 == spark.read.parquet(out("taxi_weather_trips_clean")).count()
    demand = spark.read.parquet(out("gold_demand_features"))
    assert demand.agg(F.sum("demand")).first()[0] == 24
    zones = {r.pu_location_id: r for r in
             spark.read.parquet(out("dashboard_zone_summary")).collect()}
    assert zones[1].pickup_zone == "Newark Airport" and zones[2].pickup_zone is None
    assert zones[1].total_demand == zones[2].total_demand == 12
    kpi = spark.read.parquet(out("dashboard_hourly_demand_kpi"))
    assert kpi.count() == 4 and {r.active_zones for r in kpi.collect()} == {2}
    payment = spark.read.parquet(out("dashboard_payment_tip_summary")).first()
    assert payment.trip_count == 24 and payment.median_tip_percent == pytest.approx(20.0)
    report = spark.read.json(out("quality_reports/gold"))
    assert report.count() == 75 and report.filter("status = 'fail'").count() == 0
    assert silver.window_hours("2024-01-01", "2024-01-02") == 25

    store = publish.Warehouse(spark, str(tmp_path / "serving"))
    ids = run_publish(spark, out, store.root)
    assert len(set(ids.values())) == 3
    run_validate(spark, out, store.root)
    assert {r.status for r in store.runs().collect()} == {"passed"}
    assert store.read("dashboard_zone_summary").agg(F.sum("total_demand")).first()[0] == 24


def test_produce_sends_every_file_once(spark, tmp_path):
    out = Layout(str(tmp_path / "lake"))
    drop = tmp_path / "drop"
    frame = spark.range(3).select(F.lit(1).alias("VendorID"), "id")
    frame.coalesce(1).write.parquet(str(tmp_path / "one"))
    drop.mkdir()
    part = next((tmp_path / "one").glob("part-*"))
    (drop / "yellow_tripdata_2024-01.parquet").write_bytes(part.read_bytes())
    run_produce(spark, str(drop), out)
    (drop / "green_tripdata_2024-01.parquet").write_bytes(part.read_bytes())
    run_produce(spark, str(drop), out)
    run_produce(spark, str(drop), out)
    rows = spark.read.parquet(out("events")).collect()
    assert sorted(r.topic for r in rows) == sorted([K.YELLOW_TOPIC, K.GREEN_TOPIC] * 3)
    assert {json.loads(r.value)["_source_file"] for r in rows} == {
        "yellow_tripdata_2024-01.parquet", "green_tripdata_2024-01.parquet"}


def test_damaged_data_is_not_taken_for_missing(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        try_read(spark, str(tmp_path / "bad")).count()


def test_shared_folder_is_refused_or_beside_the_warehouse(spark):
    class Other:
        class sparkContext:
            master, applicationId = "yarn", "x"

        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Other)
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
