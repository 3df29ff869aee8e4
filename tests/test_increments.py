"""Tables that grow: merged stream counts, several feeds, backfills, sketches that add up."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmart.operators import sketches
from tripmart.plans.batch import Layout, run_all, run_backfill
from tripmart.sources import rewrite_partitions, trips_to_envelope, write_partitioned
from tripmart.streaming import bronze, merged

T0 = datetime(2024, 1, 1)


def counts(df):
    return {(r.pu_location_id, r.pickup_hour): r.demand for r in df.collect()}


def trips(spark, rows):
    return spark.createDataFrame(rows, "pu_location_id int, pickup_datetime timestamp")


def arrivals(seed, files, rows):
    """Files of trips in no order of time: hours long past come up again in later files."""
    rng = random.Random(seed)
    return [
        [(rng.randint(1, 4), T0 + timedelta(minutes=rng.randint(0, 3000))) for _ in range(rows)]
        for _ in range(files)
    ]


def plain(files):
    out = {}
    for rows in files:
        for zone, at in rows:
            key = zone, at.replace(minute=0)
            out[key] = out.get(key, 0) + 1
    return out


def start(spark, source, table, checkpoint, fold_every):
    stream = spark.readStream.schema("pu_location_id int, pickup_datetime timestamp")
    stream = stream.option("maxFilesPerTrigger", 1).parquet(source)
    merged.merge_demand(stream, table, checkpoint, fold_every=fold_every).awaitTermination()


@pytest.mark.parametrize("fold_every", [2, 100])
def test_late_and_open_hours_are_counted_and_a_replay_changes_nothing(spark, tmp_path, fold_every):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    table = merged.demand_table(spark, str(tmp_path / "t"))
    assert counts(table.read()) == {}
    files = arrivals(1, 5, 40)
    for rows in files[:4]:
        trips(spark, rows).coalesce(1).write.mode("append").parquet(source)
    start(spark, source, table, checkpoint, fold_every)
    assert counts(table.read()) == plain(files[:4])
    # The last batch as if the run had died before it was committed.
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    start(spark, source, table, checkpoint, fold_every)
    assert counts(table.read()) == plain(files[:4])
    trips(spark, files[4]).coalesce(1).write.mode("append").parquet(source)
    start(spark, source, table, checkpoint, fold_every)
    assert counts(table.read()) == plain(files)
    assert table.folded() == (3 if fold_every == 2 else -1)


def test_folding_keeps_sums_and_reads_no_folded_batch(spark, tmp_path, plan_of):
    table = merged.demand_table(spark, str(tmp_path / "t"))
    rows = trips(spark, arrivals(2, 1, 50)[0]).select(
        "pu_location_id", F.date_trunc("hour", "pickup_datetime").alias("pickup_hour"),
        F.lit(1).cast("long").alias("demand"))
    for batch in range(4):
        table.merge(rows, batch)
    before = counts(table.read())
    table.fold(2)
    table.fold(1)
    assert table.folded() == 2 and counts(table.read()) == before
    # A fold that died before its log entry is written again, whole.
    rows.limit(3).write.mode("overwrite").parquet(f"{tmp_path}/t/base/3")
    assert counts(table.read()) == before
    table.fold(3)
    assert table.folded() == 3 and counts(table.read()) == before
    folded = spark.read.schema("batch long").parquet(f"{tmp_path}/t/batches").filter("batch > 3")
    assert folded.count() == 0 and "PartitionFilters: [isnotnull(batch" in plan_of(table.read())


def log(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.lit(None).cast("binary").alias("key"), F.lit(b"{}").alias("value"),
        F.lit("nyc_taxi_yellow").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.lit(T0).alias("timestamp"), F.lit(0).alias("timestampType"))


def feed(spark, tmp_path, name, events):
    return bronze.Feed(events, "taxi_type", "yellow", str(tmp_path / f"o-{name}"), str(tmp_path / f"c-{name}"))


def test_feeds_tell_their_batches_and_rows(spark, tmp_path):
    feeds = []
    for name, n in (("a", 7), ("b", 12), ("none", 0)):
        source = str(tmp_path / name)
        for start_ in range(0, max(n, 1), 5):
            log(spark, min(5, n - start_), start_).coalesce(1).write.mode("append").parquet(source)
        feeds.append(feed(spark, tmp_path, name, bronze.read_envelope_stream(spark, source, max_files_per_trigger=1)))
    done = bronze.run_ingestion(spark, feeds)
    assert [(d.rows, d.batches) for d in done] == [(7, 2), (12, 3), (0, 0)]
    again = bronze.run_ingestion(spark, feeds)
    assert [(d.rows, d.batches) for d in again] == [(0, 0)] * 3
    assert spark.read.parquet(feeds[1].path).count() == 12


def test_a_failing_feed_stops_endless_ones(spark, tmp_path):
    source = str(tmp_path / "log")
    log(spark, 3).write.parquet(source)
    events = bronze.read_envelope_stream(spark, source)
    broken = events.withColumn("value", F.raise_error(F.lit("boom")).cast("binary"))
    feeds = [feed(spark, tmp_path, name, e) for name, e in (("ok", events), ("also", events), ("bad", broken))]
    with pytest.raises(Exception, match="boom"):
        bronze.run_ingestion(spark, feeds, available_now=False)
    assert not spark.streams.active


def files_of(path):
    return {
        os.path.join(base, n): os.stat(os.path.join(base, n)).st_mtime_ns
        for base, _, names in os.walk(path) for n in names if n.endswith(".parquet")
    }


def test_backfill_leaves_other_months_as_they_are(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.range(90).select(
        "id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1)).alias("pickup_year_month"))
    write_partitioned(df, path, ["pickup_year_month"])
    before = files_of(path)
    fixed = df.filter("pickup_year_month = '2024-02'").withColumn("id", F.col("id") + 1000)
    rewrite_partitions(fixed, path, ["pickup_year_month"])
    after = files_of(path)
    kept = {f for f in before if "2024-02" not in f}
    assert {f: before[f] for f in kept} == {f: after[f] for f in kept}
    assert not {f for f in before if "2024-02" in f} & set(after)
    rows = spark.read.parquet(path)
    assert rows.count() == 90 and rows.filter("id >= 1000").count() == 30
    rewrite_partitions(fixed.filter("false"), path, ["pickup_year_month"])
    assert files_of(path) == after


def bronze_rows(fares):
    """A trip and a reading for each hour of some days of two months; fares by month."""
    hours = [datetime(2024, m, d, h) for m in (1, 2) for d in (3, 4) for h in range(3)]
    trips_ = [("t", 0, i, at, json.dumps({
        "VendorID": 1, "tpep_pickup_datetime": at.isoformat(),
        "tpep_dropoff_datetime": (at + timedelta(minutes=9)).isoformat(), "passenger_count": 1.0,
        "trip_distance": 2.0, "RatecodeID": 1.0, "PULocationID": 1, "DOLocationID": 2,
        "payment_type": 1.0, "fare_amount": fares[at.month], "extra": 0.0, "mta_tax": 0.5,
        "tip_amount": 2.0, "tolls_amount": 0.0, "improvement_surcharge": 1.0,
        "total_amount": fares[at.month] + 3.5, "_source_file": "y"})) for i, at in enumerate(hours)]
    weather = [("w", 0, i, at, json.dumps({
        "timestamp": at.strftime("%Y-%m-%dT%H:%M"), "temperature_f": 30.0, "humidity_percent": 50.0,
        "precipitation_mm": 0.0, "weather_code": 3, "wind_speed_kmh": 5.0,
        "wind_direction_deg": 10.0, "cloud_cover_percent": 80.0})) for i, at in enumerate(hours)]
    return trips_, weather


def test_backfill_of_a_month_through_all_layers(spark, tmp_path):
    schema = "topic string, partition int, offset bigint, kafka_timestamp timestamp, json_data string"

    def land(name, fares):
        trips_, weather = bronze_rows(fares)
        paths = str(tmp_path / f"y-{name}"), str(tmp_path / f"w-{name}")
        spark.createDataFrame(trips_, schema).write.parquet(paths[0])
        spark.createDataFrame(weather, schema).write.parquet(paths[1])
        return {"yellow": paths[0]}, paths[1]

    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,Latitude,Longitude\n1,EWR,Newark Airport,40.69,-74.17\n")
    out, want = Layout(str(tmp_path / "lake")), Layout(str(tmp_path / "want"))
    run_all(spark, *land("wrong", {1: 10.0, 2: 11.0}), str(zones), out)
    layers = [
        "taxi_weather_trips", "taxi_weather_trips_core", "taxi_weather_trips_clean", "hourly_weather",
        "gold_demand_features", "gold_fare_tip_features", "dashboard_hourly_demand_kpi",
        "dashboard_zone_summary", "dashboard_payment_tip_summary",
    ]
    before = {x: files_of(out(x)) for x in layers}
    corrected = land("right", {1: 10.0, 2: 15.0})
    run_backfill(spark, *corrected, str(zones), out, "2024-02")
    run_all(spark, *corrected, str(zones), want)
    for x in layers:
        after = files_of(out(x))
        january = {f for f in before[x] if "2024-01" in f}
        assert january and {f: before[x][f] for f in january} == {f: after.get(f) for f in january}
        stamps = [c for c in spark.read.parquet(out(x)).columns if "processed" in c]
        got, fresh = (spark.read.parquet(at(x)).drop(*stamps) for at in (out, want))
        assert got.exceptAll(fresh).isEmpty() and fresh.exceptAll(got).isEmpty()
    with pytest.raises(ValueError, match="2024-03"):
        run_backfill(spark, *corrected, str(zones), out, "2024-03")


def test_sketches_of_days_add_up(spark, tmp_path):
    rng = random.Random(4)
    rows = [("t", 0, i, "x" * int(rng.expovariate(0.01)), f"2024-01-{i % 9 + 1:02d}") for i in range(20_000)]
    rows += [("t", 0, i, "again", "2024-01-20") for i in range(500)]
    rows += [("empty", 0, 1, None, "2024-01-01")]
    schema = "topic string, partition int, offset long, json_data string, ingestion_date string"
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "s")
    write_partitioned(sketches.daily_sketches(df), path, ["ingestion_date"])
    got = {r.topic: r for r in sketches.merged_profile(spark.read.parquet(path), quantiles=(0.5, 0.9)).collect()}
    t, sizes = got["t"], sorted(len(r[3]) for r in rows if r[0] == "t")
    assert (t.event_rows, t.missing_payloads, t.payload_chars) == (20_500, 0, sum(sizes))
    assert (t.min_payload_chars, t.max_payload_chars) == (sizes[0], sizes[-1])
    for q, value in ((0.5, t.p50_payload_chars), (0.9, t.p90_payload_chars)):
        below, upto = sum(s < value for s in sizes), sum(s <= value for s in sizes)
        assert below / len(sizes) - sketches.RANK_ERROR <= q <= upto / len(sizes) + sketches.RANK_ERROR
    assert abs(t.distinct_records - 20_000) <= 3 * sketches.KEY_ERROR * 20_000
    empty = got["empty"]
    assert (empty.event_rows, empty.missing_payloads, empty.payload_chars) == (1, 1, 0)
    assert empty.p50_payload_chars is None
    some = sketches.merged_profile(spark.read.parquet(path).filter("ingestion_date = '2024-01-20'")).first()
    assert some.event_rows == 500 and some.p95_payload_chars == 5
    assert sketches.merged_profile(sketches.daily_sketches(df.limit(0))).count() == 0


def test_rows_tell_their_trip_file(spark, tmp_path):
    for name, n in (("yellow_tripdata_2024-01.parquet", 3), ("green_tripdata_2024-02.parquet", 2)):
        spark.range(n).withColumnRenamed("id", "VendorID").write.parquet(str(tmp_path / "a b+c" / name))
    rows = spark.read.parquet(str(tmp_path / "a b+c" / "*"))
    fields = F.from_json("value", "_source_file string, VendorID int")
    got = trips_to_envelope(rows).select("topic", fields.alias("r")).select("topic", "r.*").collect()
    assert sorted((r.topic, r._source_file, r.VendorID) for r in got) == [
        *[("nyc_taxi_green", "green_tripdata_2024-02.parquet", i) for i in range(2)],
        *[("nyc_taxi_yellow", "yellow_tripdata_2024-01.parquet", i) for i in range(3)],
    ]
