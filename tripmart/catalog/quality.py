"""Profiles, contract checks, audits, geometry and publication metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import geo, gold, profile, publish, quality, silver
from . import shapes
from .registry import query


def _long(table: str, columns: list[str], row: str) -> str:
    """UNION ALL of one aggregate row per column."""
    return "\nUNION ALL ".join(row.format(c=c, table=table) for c in columns)


# --- Profiles -----------------------------------------------------------------------

_NULLS = ["passenger_count", "ratecode_id", "payment_type", "congestion_surcharge", "airport_fee",
          "temperature_f", "fare_amount"]


@query(
    "null_profile",
    _long(
        "core",
        _NULLS,
        "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        "(count(*) - count({c}))::DOUBLE / count(*) AS null_ratio, 'present' AS status FROM {table}",
    )
    + " UNION ALL SELECT 'ehail_fee', NULL, NULL, 'missing'",
)
def _(spark, sf_dir):
    return profile.nulls(shapes.core(spark, sf_dir), [*_NULLS, "ehail_fee"])


@query(
    "duplicate_keys",
    """
    SELECT topic, "partition", "offset", count(*) AS row_count FROM parsed
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def _(spark, sf_dir):
    typed = silver.type_trips(silver.parse_trips(shapes.bronze_trips(spark, sf_dir)))
    return profile.duplicates(typed.dropna(subset=["pickup_datetime"]), K.TRANSPORT_KEY)


@query(
    "duplicate_orders",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def _(spark, sf_dir):
    return profile.duplicates(
        shapes.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "counts_by_dimension",
    """
    SELECT 'ingestion_date' AS dimension, strftime(kafka_timestamp, '%Y-%m-%d') AS "value",
      count(*) AS row_count FROM delivered GROUP BY 2
    UNION ALL SELECT 'topic', topic, count(*) FROM delivered GROUP BY 2
    UNION ALL SELECT 'taxi_type', taxi_type, count(*) FROM delivered GROUP BY 2
    """.replace(
        "delivered",
        "(SELECT pickup + to_hours(copy) AS kafka_timestamp, taxi_type, "
        "'nyc_taxi_' || taxi_type AS topic FROM copies)",
    ),
)
def _(spark, sf_dir):
    bronze = shapes.bronze_trips(spark, sf_dir)
    return profile.counts_by(bronze, ["ingestion_date", "topic", "taxi_type", "data_type"])


_DIST = ["trip_distance", "fare_amount", "total_amount", "temperature_f", "precipitation_mm"]


@query(
    "distribution",
    _long(
        "clean",
        _DIST,
        "SELECT '{c}' AS column_name, count(v) AS non_null_count, min(v) AS min_value, "
        "max(v) AS max_value, round(avg(v), 6) AS avg_value, round(stddev_samp(v), 6) AS stddev_value, "
        "quantile_disc(v, 0.25) AS p25, quantile_disc(v, 0.5) AS p50, "
        "quantile_disc(v, 0.75) AS p75, quantile_disc(v, 0.95) AS p95, "
        "quantile_disc(v, 0.99) AS p99 FROM (SELECT {c}::DOUBLE AS v FROM {table})",
    ),
)
def _(spark, sf_dir):
    rows = profile.distribution(shapes.clean(spark, sf_dir), _DIST, exact=True)
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("avg_value", "stddev_value")}
    )


@query(
    "payload_profile",
    """
    SELECT count(*) AS event_rows, 0::BIGINT AS required_metadata_nulls,
      min(length(props)) AS min_payload_chars, avg(length(props)) AS avg_payload_chars,
      quantile_disc(length(props), 0.95) AS p95_payload_chars,
      max(length(props)) AS max_payload_chars FROM events
    """.replace("min(length(props))", "min(length(props))::INT")
    .replace("max(length(props))", "max(length(props))::INT")
    .replace("quantile_disc(length(props), 0.95)", "quantile_disc(length(props), 0.95)::INT"),
)
def _(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("json_data"),
    )
    return profile.payloads(events)


_PAYLOAD_ROWS = """(
      SELECT 'yellow' AS kind, e % 97 = 13 AS broken, taxi_type = 'yellow' AS own FROM copies
        WHERE taxi_type = 'yellow'
      UNION ALL SELECT 'green', e % 97 = 13, true FROM copies WHERE taxi_type = 'green'
      UNION ALL SELECT 'weather', false, true FROM events)"""


@query(
    "json_fields",
    f"""
    SELECT kind, f AS expected_field,
      count(*) FILTER (NOT broken AND f <> 'pickup_zone_name') AS present_rows,
      count(*) AS total_rows, count(*) FILTER (broken) AS unreadable_rows
    FROM {_PAYLOAD_ROWS} JOIN (VALUES
      {", ".join(f"('{kind}', '{f}')" for kind, fields in K.EXPECTED_PAYLOAD_FIELDS.items()
                 for f in [*fields, "pickup_zone_name"])}) t(k, f) ON k = kind
    GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    """Expected payload fields of all three feeds, and one that no payload has."""
    trips = shapes.bronze_trips(spark, sf_dir)
    feeds = {kind: trips.filter(F.col("taxi_type") == kind) for kind in ("yellow", "green")}
    feeds["weather"] = shapes.bronze_weather(spark, sf_dir)
    found = None
    for kind, feed in feeds.items():
        expected = [*K.EXPECTED_PAYLOAD_FIELDS[kind], "pickup_zone_name"]
        one = profile.json_fields(feed, expected).withColumn("kind", F.lit(kind))
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "time_coverage",
    """
    SELECT 'pickup_datetime' AS column_name, min(pickup_datetime) AS min_value,
      max(pickup_datetime) AS max_value FROM joined
    UNION ALL SELECT 'dropoff_datetime', min(dropoff_datetime), max(dropoff_datetime) FROM joined
    UNION ALL SELECT 'weather_timestamp', min(weather_timestamp), max(weather_timestamp)
    FROM joined
    """,
)
def _(spark, sf_dir):
    return profile.time_coverage(
        shapes.joined_trips(spark, sf_dir),
        ["pickup_datetime", "dropoff_datetime", "weather_timestamp"],
    )


@query(
    "demand_shape",
    """
    SELECT 'hour_of_day' AS dimension, hour(pickup_hour)::VARCHAR AS "value",
      count(*) AS trip_count FROM clean GROUP BY 2
    UNION ALL SELECT 'day_of_week', (dayofweek(pickup_date) + 1)::VARCHAR, count(*) FROM clean
      GROUP BY 2
    UNION ALL SELECT 'pickup_month', month(pickup_date)::VARCHAR, count(*) FROM clean GROUP BY 2
    UNION ALL SELECT 'taxi_type', taxi_type, count(*) FROM clean GROUP BY 2
    """,
)
def _(spark, sf_dir):
    return profile.demand_shape(shapes.clean(spark, sf_dir))


@query(
    "trips_by_type",
    """
    SELECT taxi_type, count(*) AS trip_count, min(pickup_datetime) AS min_pickup_time,
      max(pickup_datetime) AS max_pickup_time, round(avg(trip_distance), 2) AS avg_trip_distance,
      round(avg(fare_amount), 2) AS avg_fare_amount, round(avg(tip_amount), 2) AS avg_tip_amount
    FROM trips GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return profile.by_type(shapes.typed_trips(spark, sf_dir))


@query(
    "weather_profile",
    """
    SELECT count(*) AS row_count, count(DISTINCT weather_hour) AS distinct_hours,
      min(weather_hour) AS min_time, max(weather_hour) AS max_time,
      count(*) - count(temperature_f) AS null_temperature_f,
      count(*) - count(precipitation_mm) AS null_precipitation_mm
    FROM readings
    """,
)
def _(spark, sf_dir):
    parsed = silver.parse_weather(shapes.bronze_weather(spark, sf_dir))
    return profile.weather(silver.normalize_weather(parsed, dedup=False))


@query("zones_per_borough", "SELECT borough, count(*) AS zone_count FROM zones GROUP BY 1")
def _(spark, sf_dir):
    return profile.zones(shapes.zone_table(spark, sf_dir))


# --- Checks -----------------------------------------------------------------------------


def _null_check_sql(table: str, required: list[str], nullable: list[str]) -> str:
    row = (
        "SELECT '{p}_{c}' AS check_name, (count(*) - count({c}))::VARCHAR AS check_value, {s} "
        "AS status FROM {t}"
    )
    failing = "CASE WHEN count(*) = count({c}) THEN 'pass' ELSE 'fail' END"
    parts = [row.format(p="critical_null", c=c, s=failing.format(c=c), t=table) for c in required]
    parts += [row.format(p="known_nullable_null", c=c, s="'pass'", t=table) for c in nullable]
    return "\nUNION ALL ".join(parts)


def _checks(report):
    return report.select("check_name", "check_value", "status")


@query("null_checks", _null_check_sql("core", K.CORE_REQUIRED, K.CORE_NULLABLE))
def _(spark, sf_dir):
    core = shapes.core(spark, sf_dir)
    return _checks(quality.null_checks(core, K.CORE_REQUIRED, K.CORE_NULLABLE))


@query(
    "key_checks",
    """
    SELECT 'duplicate_trips' AS check_name, count(*)::VARCHAR AS check_value,
      CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    """,
)
def _(spark, sf_dir):
    items = shapes.table(spark, sf_dir, "lineitem")
    return _checks(quality.key_checks(items, ["l_orderkey", "l_linenumber"], "duplicate_trips"))


def _zero_rules(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) FILTER ({c})::VARCHAR AS check_value, "
        f"CASE WHEN count(*) FILTER ({c}) = 0 THEN 'pass' ELSE 'fail' END AS status FROM {table}"
        for n, c in rules.items()
    )


_CALENDAR = {
    "invalid_hour_rows": '"hour" < 0 OR "hour" > 23',
    "invalid_day_of_week_rows": "day_of_week < 1 OR day_of_week > 7",
    "invalid_month_rows": '"month" < 1 OR "month" > 12',
}


@query(
    "rule_checks_demand",
    _zero_rules("demand", {"non_positive_demand_rows": "demand <= 0", **_CALENDAR})
    + """
    UNION ALL SELECT 'min_pickup_hour', min(pickup_hour)::VARCHAR, 'pass' FROM demand
    UNION ALL SELECT 'max_pickup_hour', max(pickup_hour)::VARCHAR, 'pass' FROM demand
    UNION ALL SELECT 'total_demand', sum(demand)::VARCHAR, 'pass' FROM demand
    UNION ALL SELECT 'pickup_year_month_count', count(DISTINCT pickup_year_month)::VARCHAR, 'pass'
    FROM demand
    """,
)
def _(spark, sf_dir):
    return _checks(quality.rule_checks(shapes.demand(spark, sf_dir), "demand"))


@query(
    "rule_checks_fare_tip",
    _zero_rules(
        "wide_fares",
        {
            "non_positive_fare_rows": "fare_amount <= 0",
            "below_min_tip_model_fare_rows": "fare_amount < 2.5",
            "above_max_fare_model_amount_rows": "fare_amount > 300",
            "non_positive_distance_rows": "trip_distance <= 0",
            "negative_tip_percent_rows": "tip_percent < 0",
            "high_tip_percent_rows": "tip_percent > 100",
            **_CALENDAR,
        },
    ).replace(
        "FROM wide_fares",
        "FROM (SELECT *, pct::FLOAT AS tip_percent, hour(pickup_datetime) AS \"hour\", "
        "dayofweek(pickup_datetime) + 1 AS day_of_week, month(pickup_datetime) AS \"month\" "
        "FROM tipped)",
    )
    + """
    UNION ALL SELECT 'credit_card_payment_rows', count(*) FILTER (payment_type = 1)::VARCHAR,
      'pass' FROM tipped
    """,
)
def _(spark, sf_dir):
    """Rules over all candidate trips, so that the policy limits find something to report."""
    ts = F.col("pickup_datetime")
    trips = gold.candidates(shapes.core(spark, sf_dir)).withColumns(
        {
            "tip_percent": gold.tip_percent().cast("float"),
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "month": F.month(ts),
        }
    )
    return _checks(quality.rule_checks(trips, "fare_tip"))


_RULES = {
    "null_passengers": "passenger_count IS NULL",
    "zero_distance": "trip_distance = 0",
    "negative_fare": "fare_amount < 0",
    "tip_above_fare": "tip_amount > fare_amount",
    "early_dropoff": "dropoff_datetime < pickup_datetime",
}


@query(
    "rule_counts",
    "SELECT "
    + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _RULES.items())
    + " FROM core",
)
def _(spark, sf_dir):
    rules = {n: F.expr(c) for n, c in _RULES.items()}
    return quality.rule_counts(shapes.core(spark, sf_dir), rules)


# Column names of each warehouse table that must have a value, and its key.
_NOT_NULL = {
    "hourly_kpi": [
        "pickup_hour", "hour", "day_of_week", "month", "pickup_year_month", "total_demand",
        "active_zones", "avg_demand_per_active_zone", "max_zone_hour_demand", "avg_temperature_f",
        "avg_precipitation_mm", "source_gold_processed_timestamp", "dashboard_processed_timestamp",
    ],
    "zone_summary": [
        "pickup_year_month", "pu_location_id", "total_demand", "avg_hourly_demand",
        "max_hourly_demand", "active_hours", "first_pickup_hour", "last_pickup_hour",
        "avg_temperature_f", "avg_precipitation_mm", "source_gold_processed_timestamp",
        "dashboard_processed_timestamp",
    ],
    "payment_tip_summary": [
        "pickup_year_month", "trip_count", "avg_fare_amount", "avg_tip_amount", "avg_tip_percent",
        "median_tip_percent", "median_fare_amount", "avg_trip_distance", "min_fare_amount",
        "max_fare_amount", "min_tip_percent", "max_tip_percent", "month",
        "source_gold_processed_timestamp", "dashboard_processed_timestamp",
    ],
    "demand": [
        "pu_location_id", "pickup_hour", "demand", "hour", "day_of_week", "month", "temperature_f",
        "precipitation_mm", "pickup_year_month", "gold_processed_timestamp",
    ],
    "fare_tip": [
        "fare_amount", "tip_amount", "tip_percent", "trip_distance", "pu_location_id",
        "do_location_id", "hour", "day_of_week", "month", "temperature_f", "precipitation_mm",
        "pickup_year_month", "gold_processed_timestamp",
    ],
}
_MART_OF = {
    "hourly_kpi": "hourly_mart", "zone_summary": "zone_mart", "payment_tip_summary": "payment_mart",
    "demand": "demand", "fare_tip": "fare_tip",
}


def _constraint_sql(name: str) -> str:
    source = _MART_OF[name]
    rules = {f"not_null_{c}": f'"{c}" IS NULL' for c in _NOT_NULL[name]}
    for column, condition in quality.TABLE_CONSTRAINTS[name].items():
        for word in ("hour", "month"):
            if column == word:
                condition = f'"{word}"' + condition.removeprefix(word)
        rules[f"check_{column}"] = f"NOT ({condition})"
    parts = [f"SELECT '{name}' AS table_name, * FROM ({_zero_rules(source, rules)})"]
    if keys := quality.PRIMARY_KEYS.get(name):
        parts.append(f"""SELECT '{name}', 'primary_key', count(*)::VARCHAR,
          CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
        FROM (SELECT 1 FROM {source} GROUP BY {", ".join(keys)} HAVING count(*) > 1)""")
    return "\nUNION ALL ".join(parts)


@query("constraint_checks", "\nUNION ALL ".join(map(_constraint_sql, _MART_OF)))
def _(spark, sf_dir):
    """Constraints of all five warehouse tables."""
    tables = {
        "hourly_kpi": shapes.hourly_mart, "zone_summary": shapes.zone_mart,
        "payment_tip_summary": shapes.payment_mart, "demand": shapes.demand,
        "fare_tip": shapes.fare_tip,
    }
    found = None
    for name, build in tables.items():
        report = _checks(quality.constraints(build(spark, sf_dir), name))
        one = report.withColumn("table_name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


def _summary_sql(table: str, types: str, contract: dict[str, str]) -> str:
    """Statuses per kind: null checks and row counts from the rows, the schema from ``types``.

    ``types`` is a query that gives column names and kinds as DuckDB sees them.
    """
    kinds = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
             "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp": "TIMESTAMP", "date": "DATE"}
    wanted = ", ".join(
        f"('{c}', '{kinds.get(k, k.upper())}')" for c, k in contract.items()
    )
    return f"""
    SELECT 'null' AS check_kind, status, count(*) AS check_count
    FROM ({_null_check_sql(table, K.CORE_REQUIRED, K.CORE_NULLABLE)}) GROUP BY 2
    UNION ALL
    SELECT 'schema', status, count(*) FROM (
      SELECT CASE WHEN replace(t.kind, ' ', '') = replace(w.kind, ' ', '') THEN 'pass' ELSE 'fail' END
        AS status
      FROM (VALUES {wanted}) w(name, kind) LEFT JOIN ({types}) t ON t.name = w.name
      UNION ALL SELECT unnest(['pass', 'pass'])
      UNION ALL SELECT CASE WHEN count(t.name) = count(*) THEN 'pass' ELSE 'fail' END
      FROM (VALUES {wanted}) w(name, kind) LEFT JOIN ({types}) t ON t.name = w.name) GROUP BY 2
    UNION ALL
    SELECT 'value', status, count(*) FROM (
      SELECT CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM {table}
      UNION ALL SELECT unnest(['pass', 'pass', 'pass', 'pass'])) GROUP BY 2"""


# The kinds of the columns, from a row of each.
_CORE_TYPES = """SELECT name, kind FROM (
      SELECT unnest([{names}]) AS name, unnest([{kinds}]) AS kind FROM (SELECT * FROM {table} LIMIT 1))"""


def _types_of(table: str, columns: list[str]) -> str:
    return _CORE_TYPES.format(
        table=table,
        names=", ".join(f"'{c}'" for c in columns),
        kinds=", ".join(f'typeof("{c}")' for c in columns),
    )


# The twins have no processing time: its column always passes.
_CORE_COLUMNS = {c: k for c, k in K.CORE_CONTRACT.items() if c != "core_processed_timestamp"}


@query("quality_summary", _summary_sql("core", _types_of("core", list(_CORE_COLUMNS)), _CORE_COLUMNS))
def _(spark, sf_dir):
    return quality.summarize(quality.check_table(shapes.core(spark, sf_dir), "core"))


_BROKEN = """(SELECT * REPLACE (CASE WHEN pu_location_id % 5 = 0 THEN NULL ELSE pickup_datetime END
        AS pickup_datetime, fare_amount::DOUBLE AS fare_amount) FROM core)"""


@query(
    "quality_summary_tampered",
    _summary_sql(_BROKEN, _types_of(_BROKEN, [c for c in _CORE_COLUMNS if c != "extra"]), _CORE_COLUMNS),
)
def _(spark, sf_dir):
    """Core with lost pickup times, fares of another type and a column less."""
    core = shapes.core(spark, sf_dir).withColumns(
        {
            "pickup_datetime": F.when(F.col("pu_location_id") % 5 != 0, F.col("pickup_datetime")),
            "fare_amount": F.col("fare_amount").cast("double"),
        }
    )
    return quality.summarize(quality.check_table(core.drop("extra"), "core"))


@query(
    "core_profile",
    """
    SELECT min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime,
      count(*) FILTER (is_outlier_trip) AS outlier_rows,
      count(*) FILTER (NOT is_outlier_trip) AS non_outlier_rows FROM core
    """,
)
def _(spark, sf_dir):
    return quality.core_profile(shapes.core(spark, sf_dir))


@query(
    "retention",
    """
    SELECT *, core_rows - clean_rows AS rows_rejected_for_missing_critical_fields,
      clean_rows::DOUBLE / core_rows AS clean_retention_ratio
    FROM (SELECT (SELECT count(*) FROM core) AS core_rows,
            (SELECT count(*) FROM clean) AS clean_rows)
    """,
)
def _(spark, sf_dir):
    return quality.retention(shapes.core(spark, sf_dir), shapes.clean(spark, sf_dir))


def _lineage_sql(source: str, target: str) -> str:
    return f"""
    SELECT unnest(['enriched_row_count', 'core_row_count_for_compare', 'core_matches_enriched_count'])
        AS check_name,
      unnest([s::VARCHAR, t::VARCHAR, (s = t)::VARCHAR]) AS check_value,
      unnest(['pass', 'pass', CASE WHEN s = t THEN 'pass' ELSE 'fail' END]) AS status
    FROM (SELECT (SELECT count(*) FROM {source}) AS s, (SELECT count(*) FROM {target}) AS t)"""


@query("lineage", _lineage_sql("joined", "core"))
def _(spark, sf_dir):
    return _checks(
        quality.lineage(shapes.joined_trips(spark, sf_dir), shapes.core(spark, sf_dir))
    )


@query("lineage_broken", _lineage_sql("joined", "clean"))
def _(spark, sf_dir):
    """A target that has lost rows on the way fails."""
    return _checks(
        quality.lineage(shapes.joined_trips(spark, sf_dir), shapes.clean(spark, sf_dir))
    )


@query(
    "candidate_ratio",
    """
    SELECT count(*) AS clean_rows, count(*) FILTER (is_gold_candidate) AS gold_candidate_true_rows,
      count(*) FILTER (NOT is_gold_candidate) AS gold_candidate_false_rows,
      count(*) FILTER (is_gold_candidate IS NULL) AS gold_candidate_null_rows,
      count(*) FILTER (is_gold_candidate)::DOUBLE / count(*) AS gold_candidate_ratio
    FROM clean
    """,
)
def _(spark, sf_dir):
    return quality.candidate_ratio(shapes.clean(spark, sf_dir))


@query(
    "outlier_profile",
    """
    SELECT count(*) AS total_rows, count(*) FILTER (NOT is_valid_distance) AS invalid_distance_rows,
      count(*) FILTER (NOT is_valid_fare) AS invalid_fare_rows,
      count(*) FILTER (NOT is_valid_total_amount) AS invalid_total_amount_rows,
      count(*) FILTER (is_outlier_trip) AS outlier_trip_rows FROM clean
    """,
)
def _(spark, sf_dir):
    return quality.outlier_profile(shapes.clean(spark, sf_dir))


@query(
    "imputation_audit",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS original_column, '{c}_clean' AS clean_column,
          '{d}' AS default_value, count(*) - count({c}) AS original_null_count,
          count(*) FILTER (is_{c}_missing) AS missing_flag_true_count,
          count(*) FILTER ({c} IS NULL AND {c}_clean IS DISTINCT FROM {d}) AS imputation_violations,
          count(*) FILTER ({c} IS NOT NULL AND {c}_clean IS DISTINCT FROM {c})
            AS preservation_violations, 'pass' AS status FROM clean"""
        for c, d in K.IMPUTE_DEFAULTS.items()
    ),
)
def _(spark, sf_dir):
    return quality.imputation_audit(shapes.clean(spark, sf_dir))


@query(
    "join_coverage",
    _long(
        "joined",
        ["weather_timestamp", "temperature_f", "precipitation_mm"],
        "SELECT '{c}' AS weather_field, count(*) AS total_rows, "
        "count(*) - count({c}) AS null_rows, count({c})::DOUBLE / count(*) AS coverage_ratio "
        "FROM {table}",
    ),
)
def _(spark, sf_dir):
    return quality.join_coverage(shapes.joined_trips(spark, sf_dir))


def _cardinality_sql(table: str) -> str:
    return f"""
    SELECT *, CASE WHEN duplicate_weather_hours = 0 THEN 'pass' ELSE 'fail' END
      AS weather_join_cardinality_status
    FROM (SELECT count(*) AS weather_hour_count, count(*) FILTER (n > 1) AS duplicate_weather_hours,
            max(n) AS max_rows_per_weather_hour
          FROM (SELECT weather_hour, count(*) AS n FROM {table} GROUP BY 1))"""


@query("join_cardinality", _cardinality_sql("first_readings"))
def _(spark, sf_dir):
    readings = silver.normalize_weather(silver.parse_weather(shapes.bronze_weather(spark, sf_dir)))
    return quality.join_cardinality(silver.hourly_weather(readings))


@query("join_cardinality_readings", _cardinality_sql("readings"))
def _(spark, sf_dir):
    """Readings not yet reduced to one an hour would multiply trips, and fail."""
    readings = silver.normalize_weather(silver.parse_weather(shapes.bronze_weather(spark, sf_dir)))
    return quality.join_cardinality(readings)


MEASURES = ["temperature_f", "humidity_percent", "precipitation_mm", "weather_code",
             "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent"]


@query(
    "weather_conformance",
    f"""
    SELECT (SELECT count(DISTINCT pickup_hour) FROM core c
            WHERE NOT EXISTS (SELECT 1 FROM weather w WHERE w.weather_hour = c.pickup_hour))
        AS hours_missing_in_weather,
      (SELECT count(*) FROM joined WHERE NOT has_weather) AS trips_without_weather_hour,
      {", ".join(f"0::BIGINT AS mismatched_{m}" for m in MEASURES)}
    """,
)
def _(spark, sf_dir):
    return quality.weather_conformance(
        shapes.core(spark, sf_dir), shapes.typed_weather(spark, sf_dir)
    )


# --- Publication metrics --------------------------------------------------------------


@query(
    "publish_metrics_demand",
    """
    SELECT 'row_count' AS check_name, count(*)::VARCHAR AS check_value FROM demand
    UNION ALL SELECT 'total_demand', sum(demand)::VARCHAR FROM demand
    UNION ALL SELECT 'pickup_year_month_count', count(DISTINCT pickup_year_month)::VARCHAR
      FROM demand
    UNION ALL SELECT 'min_pickup_hour', min(pickup_hour)::VARCHAR FROM demand
    UNION ALL SELECT 'max_pickup_hour', max(pickup_hour)::VARCHAR FROM demand
    UNION ALL SELECT 'min_gold_processed_timestamp', min(gold_processed_timestamp)::VARCHAR
      FROM demand
    UNION ALL SELECT 'max_gold_processed_timestamp', max(gold_processed_timestamp)::VARCHAR
      FROM demand
    """,
)
def _(spark, sf_dir):
    return publish.metrics(shapes.demand(spark, sf_dir), "demand")


@query(
    "publish_metrics_fare_tip",
    """
    SELECT 'row_count' AS check_name, count(*)::VARCHAR AS check_value FROM fare_tip
    UNION ALL SELECT 'total_fare_amount', sum(fare_amount)::VARCHAR FROM fare_tip
    UNION ALL SELECT 'total_tip_amount', sum(tip_amount)::VARCHAR FROM fare_tip
    UNION ALL SELECT 'credit_card_payment_rows', count(*) FILTER (payment_type = 1)::VARCHAR
      FROM fare_tip
    UNION ALL SELECT 'pickup_year_month_count', count(DISTINCT pickup_year_month)::VARCHAR
      FROM fare_tip
    UNION ALL SELECT 'min_gold_processed_timestamp', min(gold_processed_timestamp)::VARCHAR
      FROM fare_tip
    UNION ALL SELECT 'max_gold_processed_timestamp', max(gold_processed_timestamp)::VARCHAR
      FROM fare_tip
    """,
)
def _(spark, sf_dir):
    return publish.metrics(shapes.fare_tip(spark, sf_dir), "fare_tip")


@query(
    "publish_metrics_mart",
    """
    SELECT 'row_count' AS check_name, count(*)::VARCHAR AS check_value FROM zone_mart
    UNION ALL SELECT 'total_total_demand', sum(total_demand)::VARCHAR FROM zone_mart
    UNION ALL SELECT 'min_source_gold_processed_timestamp',
      min(source_gold_processed_timestamp)::VARCHAR FROM zone_mart
    UNION ALL SELECT 'max_source_gold_processed_timestamp',
      max(source_gold_processed_timestamp)::VARCHAR FROM zone_mart
    UNION ALL SELECT 'min_dashboard_processed_timestamp',
      min(dashboard_processed_timestamp)::VARCHAR FROM zone_mart
    UNION ALL SELECT 'max_dashboard_processed_timestamp',
      max(dashboard_processed_timestamp)::VARCHAR FROM zone_mart
    """,
)
def _(spark, sf_dir):
    return publish.metrics(shapes.zone_mart(spark, sf_dir), "mart")


@query(
    "reconcile",
    """
    SELECT check_name, expected_value, actual_value,
      CASE WHEN expected_value IS NOT DISTINCT FROM actual_value THEN 'pass' ELSE 'fail' END
        AS status
    FROM (SELECT 'row_count' AS check_name, count(*)::VARCHAR AS expected_value,
            count(*)::VARCHAR AS actual_value FROM zone_mart
          UNION ALL SELECT 'total_demand', sum(total_demand)::VARCHAR,
            sum(total_demand + pu_location_id % 2)::VARCHAR FROM zone_mart
          UNION ALL SELECT 'only_in_source', max(total_demand)::VARCHAR, NULL FROM zone_mart
          UNION ALL SELECT 'only_in_target', NULL, max(active_hours)::VARCHAR FROM zone_mart)
    """,
)
def _(spark, sf_dir):
    mart = shapes.zone_mart(spark, sf_dir)

    def long(**aggregates):
        wide = mart.agg(*[a.alias(n) for n, a in aggregates.items()])
        return profile.unpivot_row(
            wide,
            [
                {"check_name": F.lit(n), "check_value": F.col(n).cast("string")}
                for n in aggregates
            ],
        )

    source = long(
        row_count=F.count("*"),
        total_demand=F.sum("total_demand"),
        only_in_source=F.max("total_demand"),
    )
    target = long(
        row_count=F.count("*"),
        total_demand=F.sum(F.col("total_demand") + F.col("pu_location_id") % 2),
        only_in_target=F.max("active_hours"),
    )
    return quality.reconcile(source, target)


# --- Geometry ---------------------------------------------------------------------------

HAVERSINE = """2 * 3958.7613 * asin(sqrt(
      pow(sin(radians(d.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude))
      * cos(radians(d.latitude)) * pow(sin(radians(d.longitude - p.longitude) / 2), 2)))"""


def _pairs(spark, sf_dir):
    trips = shapes.typed_trips(spark, sf_dir)
    return trips.groupBy("pu_location_id", "do_location_id").agg(F.count("*").alias("trips"))


@query(
    "route_estimates",
    f"""
    SELECT pu_location_id, do_location_id, trips, p.zone AS pickup_zone_name,
      d.zone AS dropoff_zone_name, round({HAVERSINE}, 3) AS trip_distance,
      'haversine_zone_centroid' AS distance_method,
      pu_location_id = do_location_id AS same_zone,
      coalesce(pu_location_id <> do_location_id AND {HAVERSINE} > 0, false) AS can_predict,
      CASE WHEN p.location_id IS NULL THEN 'unknown pickup zone'
        WHEN d.location_id IS NULL THEN 'unknown dropoff zone'
        WHEN p.latitude IS NULL OR d.latitude IS NULL THEN 'missing centroid coordinates' END
        AS route_error
    FROM (SELECT pu_location_id, do_location_id, count(*) AS trips FROM trips GROUP BY 1, 2)
    LEFT JOIN zones p ON pu_location_id = p.location_id
    LEFT JOIN zones d ON do_location_id = d.location_id
    """,
)
def _(spark, sf_dir):
    zones = shapes.zone_table(spark, sf_dir)
    return geo.route_estimates(_pairs(spark, sf_dir), zones, proven_rows=shapes.ZONES)


@query(
    "polygon_centroids",
    """
    SELECT polygon_id, mx / (3 * c) AS centroid_x, my / (3 * c) AS centroid_y, true AS has_area
    FROM (
      SELECT polygon_id, sum(cr) AS c, sum(mx) AS mx, sum(my) AS my FROM (
        SELECT a.polygon_id, a.ring_id, sum(a.x * b.y - b.x * a.y) AS cr,
          sum((a.x + b.x) * (a.x * b.y - b.x * a.y)) AS mx,
          sum((a.y + b.y) * (a.x * b.y - b.x * a.y)) AS my
        FROM vertices a JOIN vertices b ON a.polygon_id = b.polygon_id
          AND a.ring_id = b.ring_id AND b.seq = (a.seq + 1) % 4
        GROUP BY 1, 2 HAVING count(*) >= 3 AND abs(sum(a.x * b.y - b.x * a.y)) >= 1e-12)
      GROUP BY 1)
    """.replace(
        "vertices",
        "(SELECT c_custkey // 8 AS polygon_id, c_custkey // 4 % 2 AS ring_id, "
        "c_custkey % 4 AS seq, "
        "(c_custkey // 8 % 100 + CASE WHEN c_custkey % 4 IN (0, 3) THEN 0 "
        "ELSE 8 - c_custkey // 4 % 2 * 4 END)::DOUBLE AS x, "
        "(c_custkey // 8 % 50 + CASE WHEN c_custkey % 4 IN (0, 1) THEN 0 "
        "ELSE 8 - c_custkey // 4 % 2 * 4 END)::DOUBLE AS y FROM customer)",
    ),
)
def _(spark, sf_dir):
    """Customers as corners: per eight keys one polygon of two rectangles."""
    key = F.col("c_custkey")
    corner, ring = key % 4, F.floor(key / 4) % 2
    polygon = F.floor(key / 8)
    side = 8 - ring * 4
    vertices = shapes.table(spark, sf_dir, "customer").select(
        polygon.alias("polygon_id"),
        ring.alias("ring_id"),
        corner.alias("seq"),
        (polygon % 100 + F.when(corner.isin(0, 3), 0).otherwise(side)).cast("double").alias("x"),
        (polygon % 50 + F.when(corner.isin(0, 1), 0).otherwise(side)).cast("double").alias("y"),
    )
    return geo.polygon_centroids(vertices)
