"""Sources, sinks and audits over what was written from the benchmark tables, and tampered data."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import forecast, ml, profile, publish, quality, silver, sketches
from ..session import materialize, scratch_path
from ..sources import (
    read_report,
    read_tagged_union,
    read_zones,
    rewrite_partitions,
    trips_to_envelope,
    write_partitioned,
    write_report,
)
from ..sources.readers import collect_small, read_metrics, sample, try_read
from ..sources.writers import write_csv
from . import shapes
from .quality import MEASURES
from .registry import query


@query("zones_from_csv", "SELECT location_id, borough, zone, latitude, longitude FROM zones")
def _(spark, sf_dir):
    """Zones written as the CSV layout that ``read_zones`` checks, and read back."""
    path = scratch_path(spark, "zones-csv")
    names = {"location_id": "LocationID", "borough": "Borough", "zone": "Zone",
             "latitude": "Latitude", "longitude": "Longitude"}
    zones = shapes.zone_table(spark, sf_dir)
    write_csv(zones.select(*[F.col(a).alias(b) for a, b in names.items()]), path)
    return read_zones(spark, path)


@query(
    "tagged_union",
    "SELECT taxi_type AS taxi_type_from_path, count(*) AS trips, sum(pu_location_id)::BIGINT AS zones "
    "FROM trips GROUP BY 1",
)
def _(spark, sf_dir):
    """Trips of each type in a dataset of their own, read as one with the type as a tag."""
    trips = shapes.typed_trips(spark, sf_dir)
    paths = {}
    for kind in ("yellow", "green"):
        paths[kind] = scratch_path(spark, f"trips-{kind}")
        write_partitioned(trips.filter(F.col("taxi_type") == kind), paths[kind], [])
    union = read_tagged_union(spark, paths)
    return union.groupBy("taxi_type_from_path").agg(
        F.count("*").alias("trips"), F.sum("pu_location_id").alias("zones")
    )


@query(
    "partitioned_months",
    "SELECT strftime(l_shipdate, '%Y-%m') AS pickup_year_month, count(*) AS items, "
    "sum(l_linenumber)::BIGINT AS line_sum FROM lineitem GROUP BY 1",
)
def _(spark, sf_dir):
    """Line items laid out by month and read back through the partition column."""
    path = scratch_path(spark, "months")
    items = shapes.table(spark, sf_dir, "lineitem").select(
        "l_linenumber", F.date_format("l_shipdate", "yyyy-MM").alias("pickup_year_month")
    )
    write_partitioned(items, path, ["pickup_year_month"])
    back = spark.read.schema("l_linenumber bigint, pickup_year_month string").parquet(path)
    return back.groupBy("pickup_year_month").agg(
        F.count("*").alias("items"), F.sum("l_linenumber").alias("line_sum")
    )


@query(
    "partition_backfill",
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS pickup_year_month, count(*) AS items,
      (sum(l_linenumber) * CASE strftime(l_shipdate, '%Y-%m') WHEN '1995-03' THEN 10 ELSE 1 END)
        ::BIGINT AS line_sum
    FROM lineitem GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """Line items by month; the corrected rows of one month then take that month's place."""
    path = scratch_path(spark, "backfill")
    items = shapes.table(spark, sf_dir, "lineitem").select(
        "l_linenumber", F.date_format("l_shipdate", "yyyy-MM").alias("pickup_year_month")
    )
    write_partitioned(items, path, ["pickup_year_month"])
    corrected = items.filter("pickup_year_month = '1995-03'").withColumn(
        "l_linenumber", F.col("l_linenumber") * 10
    )
    rewrite_partitions(corrected, path, ["pickup_year_month"])
    back = spark.read.schema("l_linenumber bigint, pickup_year_month string").parquet(path)
    return back.groupBy("pickup_year_month").agg(
        F.count("*").alias("items"), F.sum("l_linenumber").alias("line_sum")
    )


@query(
    "payload_sketches",
    """
    SELECT topic, count(*) AS event_rows, 0::BIGINT AS missing_payloads,
      true AS p50_in_bounds, true AS p95_in_bounds, true AS distinct_in_bounds,
      true AS sums_agree
    FROM (SELECT 'nyc_taxi_' || taxi_type AS topic FROM copies
          UNION ALL SELECT 'weather_stream' FROM events) GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """Sketches of all envelopes by topic and day, stored, merged, and held against exact counts."""
    columns = ["topic", "partition", "offset", "json_data"]
    trips = shapes.bronze_trips(spark, sf_dir).select(*columns, "ingestion_date")
    weather = shapes.bronze_weather(spark, sf_dir).select(
        *columns, F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("ingestion_date")
    )
    envelopes = materialize(trips.unionByName(weather), "envelopes")
    path = scratch_path(spark, "sketches")
    write_partitioned(sketches.daily_sketches(envelopes), path, ["ingestion_date"])
    merged = sketches.merged_profile(spark.read.parquet(path))
    size = F.length("json_data")
    exact = (
        envelopes.join(F.broadcast(merged), "topic")
        .groupBy("topic", "event_rows", "missing_payloads", "distinct_records", "payload_chars")
        .agg(
            # Share of rows below, and up to, the estimated quantiles.
            *[
                F.struct(F.avg((size < F.col(c)).cast("int")), F.avg((size <= F.col(c)).cast("int")))
                .alias(name)
                for name, c in (("p50", "p50_payload_chars"), ("p95", "p95_payload_chars"))
            ],
            F.countDistinct("partition", "offset").alias("records"),
            F.sum(size).alias("chars"),
        )
    )

    def in_bounds(name, p):
        low, high = F.col(f"{name}.col1"), F.col(f"{name}.col2")
        off = F.lit(sketches.RANK_ERROR)
        return ((low <= p + off) & (high >= p - off)).alias(f"{name}_in_bounds")

    apart = F.abs(F.col("distinct_records") - F.col("records"))
    return exact.select(
        "topic",
        "event_rows",
        "missing_payloads",
        in_bounds("p50", F.lit(0.5)),
        in_bounds("p95", F.lit(0.95)),
        (apart <= 3 * sketches.KEY_ERROR * F.col("records")).alias("distinct_in_bounds"),
        (F.col("payload_chars") == F.col("chars")).alias("sums_agree"),
    )


@query(
    "envelope_source_files",
    """
    SELECT e AS event, 'nyc_taxi_' || taxi_type AS topic,
      taxi_type || '_tripdata_2024-' || lpad(month(pickup)::VARCHAR, 2, '0') || '.parquet'
        AS source_file,
      z.borough AS pickup_zone_borough, z.zone AS pickup_zone_name
    FROM trip_rows LEFT JOIN zones z ON z.location_id = pu_location_id
    """,
)
def _(spark, sf_dir):
    """Trip files of each type and month to envelopes; every row tells the file it is from."""
    drop = scratch_path(spark, "drop")
    trips = shapes.typed_trips(spark, sf_dir).select(
        "taxi_type",
        F.col("offset").alias("event"),
        F.col("pu_location_id").alias("PULocationID"),
        F.col("do_location_id").alias("DOLocationID"),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup"),
    )
    trips = materialize(trips, "trips")
    months = F.date_format("pickup", "yyyy-MM")
    found = collect_small(trips.select("taxi_type", months.alias("month")).distinct())
    for kind, month in found:
        one = trips.filter((F.col("taxi_type") == kind) & (months == month)).drop("taxi_type")
        one.write.parquet(f"{drop}/{kind}_tripdata_{month}.parquet")
    rows = spark.read.parquet(f"{drop}/*")
    events = trips_to_envelope(rows, zones=shapes.zone_table(spark, sf_dir))
    fields = F.from_json(
        "value", "event bigint, _source_file string, pickup_zone_borough string, pickup_zone_name string"
    )
    return events.select("topic", fields.alias("r")).select(
        F.col("r.event").alias("event"), "topic", F.col("r._source_file").alias("source_file"),
        "r.pickup_zone_borough", "r.pickup_zone_name",
    )


@query(
    "older_envelopes",
    """
    SELECT topic, "partition", "offset", kafka_timestamp, taxi_type, pickup_datetime,
      pu_location_id FROM parsed
    """,
)
def _(spark, sf_dir):
    """Envelopes of an older layout, without type tag and ingestion columns, still parse."""
    older = shapes.bronze_trips(spark, sf_dir).drop("ingestion_timestamp", "ingestion_date", "key")
    path = scratch_path(spark, "older")
    older.write.parquet(path)
    # A dataset that isn't there is left out; one that is there is read.
    parts = [try_read(spark, p) for p in (f"{path}-absent", path)]
    (stored,) = [silver.ensure_envelope(df) for df in parts if df is not None]
    typed = silver.type_trips(silver.parse_trips(stored)).dropna(subset=["pickup_datetime"])
    return typed.select(
        "topic", "partition", "offset", "kafka_timestamp", "taxi_type", "pickup_datetime",
        "pu_location_id",
    )


@query(
    "sampled_sources",
    """
    SELECT taxi_type, least(count(*), 500) AS sampled, true AS all_from_source
    FROM trips GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """The first 500 rows of each type, and whether each of them is a row of its source."""
    trips = shapes.stored(shapes.typed_trips(spark, sf_dir).select("taxi_type", "offset"))
    kinds = {k: trips.filter(F.col("taxi_type") == k).select("offset") for k in ("yellow", "green")}
    rows = sample(kinds, 500)
    source = trips.withColumn("there", F.lit(True))
    return (
        rows.join(source, ["taxi_type", "offset"], "left")
        .groupBy("taxi_type")
        .agg(
            F.count("*").alias("sampled"),
            F.bool_and(F.coalesce("there", F.lit(False))).alias("all_from_source"),
        )
    )


@query(
    "stored_report",
    "SELECT 'critical_null_pickup_datetime' AS check_name, "
    "(count(*) - count(pickup_datetime))::VARCHAR AS check_value, "
    "CASE WHEN count(*) = count(pickup_datetime) THEN 'pass' ELSE 'fail' END AS status FROM core",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(quality.null_checks(shapes.core(spark, sf_dir), ["pickup_datetime"], []), path)
    return read_report(spark, path).select("check_name", "check_value", "status")


@query(
    "quality_gate",
    "SELECT count(*) FILTER (n > 1) > 0 AS stopped FROM "
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)
def _(spark, sf_dir):
    """Whether repeated line items stop a run."""
    items = shapes.table(spark, sf_dir, "lineitem")
    report = quality.key_checks(items, ["l_orderkey", "l_linenumber"], "duplicate_items")
    stored = shapes.stored(report)
    try:
        quality.enforce(stored)
        stopped = False
    except quality.QualityError:
        stopped = True
    return stored.select(F.lit(stopped).alias("stopped"))


@query(
    "stored_metrics",
    """
    SELECT 'demand' AS model, metric, value FROM (
      SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae
      FROM (SELECT demand - predicted_demand AS e FROM scored))
    UNPIVOT (value FOR metric IN (rmse, mae))
    """,
)
def _(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    ml.write_metrics(forecast.metrics(shapes.scored(spark, sf_dir)), path)
    return read_metrics(spark, {"demand": path}).filter(F.col("metric").isin("rmse", "mae"))


@query(
    "publish_reuse",
    "SELECT 'zone_summary' AS target_table, count(*) AS target_row_count, 'passed' AS status "
    "FROM zone_mart",
)
def _(spark, sf_dir):
    """A version left by an interrupted run is compared again and promoted."""
    store = publish.Warehouse(spark, scratch_path(spark, "warehouse"))
    mart = shapes.stored(shapes.zone_mart(spark, sf_dir))
    left = store.stage("zone_summary", mart, "mart")
    again = store.stage("zone_summary", mart, "mart", reuse=left)
    store.promote({"zone_summary": again}, {"zone_summary": "marts/zone_summary"})
    store.validate("zone_summary", mart, "mart")
    return store.runs().select("target_table", "target_row_count", "status")


_CHANGED = """SELECT * REPLACE (
        temperature_f + CASE WHEN hour(weather_hour) % 6 = 0 THEN 5 ELSE 0 END AS temperature_f,
        CASE WHEN hour(weather_hour) % 4 = 0 THEN NULL ELSE precipitation_mm END AS precipitation_mm)
      FROM weather"""


@query(
    "weather_conformance_tampered",
    f"""
    SELECT (SELECT count(DISTINCT pickup_hour) FROM core c
            WHERE NOT EXISTS (SELECT 1 FROM changed w WHERE w.weather_hour = c.pickup_hour))
        AS hours_missing_in_weather,
      (SELECT count(*) FROM joined WHERE NOT has_weather) AS trips_without_weather_hour,
      {", ".join(
          f"(SELECT count(*) FROM core c JOIN changed w ON w.weather_hour = c.pickup_hour "
          f"WHERE c.{m} IS DISTINCT FROM w.{m}) AS mismatched_{m}" for m in MEASURES)}
    """.replace(" changed w", f" ({_CHANGED}) w"),
)
def _(spark, sf_dir):
    """Weather changed at some hours after the join: every trip of these hours is found."""
    hour = F.hour("weather_hour")
    changed = shapes.typed_weather(spark, sf_dir).withColumns(
        {
            "temperature_f": F.col("temperature_f") + F.when(hour % 6 == 0, 5).otherwise(0),
            "precipitation_mm": F.when(hour % 4 != 0, F.col("precipitation_mm")),
        }
    )
    return quality.weather_conformance(shapes.core(spark, sf_dir), changed)


@query(
    "imputation_audit_tampered",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS original_column, '{c}_clean' AS clean_column,
          '{d}' AS default_value, count(*) - count({c}) AS original_null_count,
          count(*) FILTER (is_{c}_missing) AS missing_flag_true_count,
          count(*) FILTER ({c} IS NULL AND {c}_clean IS DISTINCT FROM {d}) AS imputation_violations,
          count(*) FILTER ({c} IS NOT NULL AND {c}_clean IS DISTINCT FROM {c})
            AS preservation_violations,
          CASE WHEN count(*) FILTER ({c} IS NULL AND {c}_clean IS DISTINCT FROM {d}) = 0
            AND count(*) FILTER ({c} IS NOT NULL AND {c}_clean IS DISTINCT FROM {c}) = 0
            AND count(*) - count({c}) = count(*) FILTER (is_{c}_missing)
            THEN 'pass' ELSE 'fail' END AS status
        FROM (SELECT * REPLACE (CASE WHEN pu_location_id % 5 = 0 THEN 9 ELSE passenger_count_clean END
              AS passenger_count_clean) FROM clean)"""
        for c, d in K.IMPUTE_DEFAULTS.items()
    ),
)
def _(spark, sf_dir):
    """Imputed passenger counts overwritten in every fifth zone."""
    clean = shapes.clean(spark, sf_dir)
    kind = clean.schema["passenger_count_clean"].dataType
    wrong = F.when(F.col("pu_location_id") % 5 == 0, F.lit(9).cast(kind))
    return quality.imputation_audit(
        clean.withColumn("passenger_count_clean", wrong.otherwise(F.col("passenger_count_clean")))
    )


@query(
    "column_presence",
    """
    SELECT 'trips' AS dataset_name, 'pickup_datetime' AS column_name, true AS is_present,
      count(pickup_datetime) AS value_rows FROM trips
    UNION ALL SELECT 'trips', 'temperature_f', false, 0 FROM trips GROUP BY 1
    UNION ALL SELECT 'core', 'pickup_datetime', true, count(pickup_datetime) FROM core
    UNION ALL SELECT 'core', 'temperature_f', true, count(temperature_f) FROM core
    """,
)
def _(spark, sf_dir):
    """Which dataset has which column, and in how many of its rows with a value."""
    datasets = {"trips": shapes.typed_trips(spark, sf_dir), "core": shapes.core(spark, sf_dir)}
    wanted = ["pickup_datetime", "temperature_f"]
    counts = None
    for name, df in datasets.items():
        present = [c for c in wanted if c in df.columns]
        wide = df.agg(*[F.count(c).alias(c) for c in present])
        rows = [
            {"dataset_name": F.lit(name), "column_name": F.lit(c),
             "value_rows": F.col(c) if c in present else F.lit(0).cast("bigint")}
            for c in wanted
        ]
        one = profile.unpivot_row(wide, rows)
        counts = one if counts is None else counts.unionByName(one)
    found = profile.schemas(datasets, wanted).drop("data_type")
    return found.join(counts, ["dataset_name", "column_name"])
