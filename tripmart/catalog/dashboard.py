"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import dashboard as q
from ..sources import collect_small
from . import shapes
from .registry import query

START, END = "2024-01", "2024-03"


def rounded(df, *columns, digits=6):
    """Sums of doubles depend on row order in the last bits; compare to six digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- Period summary -------------------------------------------------------------


def _summary(spark, sf_dir, start, end):
    return q.summary(shapes.hourly_mart(spark, sf_dir), shapes.payment_mart(spark, sf_dir), start, end)


_FIGURES = """
    SELECT coalesce(sum(total_demand), 0)::BIGINT AS total_demand, count(*) AS hourly_points,
      round(coalesce(avg(active_zones), 0), 6)::DOUBLE AS avg_active_zones,
      round(coalesce(avg(avg_demand_per_active_zone), 0), 6)::DOUBLE AS avg_demand_per_active_zone,
      round(coalesce(avg(avg_temperature_f), 0), 6)::DOUBLE AS avg_temperature_f,
      round(coalesce(avg(avg_precipitation_mm), 0), 6)::DOUBLE AS avg_precipitation_mm,
      min(pickup_hour) AS first_data_hour, max(pickup_hour) AS last_data_hour,
      max(source_gold_processed_timestamp) AS latest_source_processed_at,
      max(dashboard_processed_timestamp) AS latest_dashboard_processed_at,
      coalesce(sum(total_demand) FILTER (isodow(pickup_hour) IN (6, 7)), 0)::BIGINT
        AS weekend_demand,
      coalesce(sum(total_demand) FILTER ("hour" IN (7, 8, 9, 17, 18, 19)), 0)::BIGINT
        AS rush_hour_demand
    FROM hourly_mart
"""
_PEAK = """
    SELECT pickup_hour AS peak_hour, total_demand AS peak_total_demand FROM hourly_mart
    ORDER BY total_demand DESC, pickup_hour LIMIT 1
"""
_PAYMENT = """
    SELECT coalesce(sum(trip_count), 0)::BIGINT AS fare_tip_trip_count,
      round(coalesce(sum(avg_fare_amount * trip_count) / nullif(sum(trip_count), 0), 0), 6)
        AS avg_fare_amount,
      round(coalesce(sum(avg_tip_percent * trip_count) / nullif(sum(trip_count), 0), 0), 6)
        AS avg_tip_percent
    FROM payment_mart
"""
_LEADER = """
    SELECT payment_type AS leading_payment_type,
      sum(trip_count)::BIGINT AS leading_payment_trip_count
    FROM payment_mart GROUP BY payment_type
    ORDER BY 2 DESC, payment_type NULLS LAST LIMIT 1
"""
_DERIVED = """
      round(total_demand::DOUBLE / nullif(hourly_points, 0), 6) AS avg_hourly_demand,
      round(coalesce(weekend_demand::DOUBLE / nullif(total_demand, 0), 0), 6) AS weekend_share,
      round(coalesce(rush_hour_demand::DOUBLE / nullif(total_demand, 0), 0), 6)
        AS rush_hour_share,
      round(coalesce(leading_payment_trip_count::DOUBLE / nullif(fare_tip_trip_count, 0), 0), 6)
        AS leading_payment_share
"""
_SUMMARY_DOUBLES = [
    "avg_active_zones", "avg_demand_per_active_zone", "avg_temperature_f", "avg_precipitation_mm",
    "avg_fare_amount", "avg_tip_percent", "avg_hourly_demand", "weekend_share",
    "rush_hour_share", "leading_payment_share",
]


@query(
    "summary",
    f"""
    SELECT *, {_DERIVED} FROM ({_FIGURES}), ({_PEAK}), ({_PAYMENT}), ({_LEADER})
    """,
)
def _(spark, sf_dir):
    return rounded(_summary(spark, sf_dir, None, None), *_SUMMARY_DOUBLES)


@query(
    "previous_period",
    f"""
    SELECT *, {_DERIVED},
      0::BIGINT AS prev_total_demand, 0.0::DOUBLE AS prev_avg_hourly_demand,
      0.0::DOUBLE AS prev_avg_active_zones, 0.0::DOUBLE AS prev_avg_demand_per_active_zone,
      0.0::DOUBLE AS prev_avg_fare_amount
    FROM ({_FIGURES}), ({_PEAK}), ({_PAYMENT}), ({_LEADER})
    """,
)
def _(spark, sf_dir):
    return rounded(_summary(spark, sf_dir, START, END), *_SUMMARY_DOUBLES)


@query(
    "coverage",
    """
    SELECT max(pickup_hour) AS last_data_hour, '2024-03' AS requested_month,
      strftime(max(pickup_hour), '%Y-%m') < '2024-03' AS is_behind
    FROM hourly_mart
    """,
)
def _(spark, sf_dir):
    return q.coverage(shapes.hourly_mart(spark, sf_dir), END)


# --- Trends ------------------------------------------------------------------------


@query(
    "trend_monthly",
    """
    SELECT pickup_year_month, sum(total_demand)::BIGINT AS total_demand,
      round(avg(active_zones), 6) AS avg_active_zones,
      round(avg(avg_temperature_f), 6) AS avg_temperature_f,
      round(avg(avg_precipitation_mm), 6) AS avg_precipitation_mm
    FROM hourly_mart WHERE pickup_year_month BETWEEN '2024-01' AND '2024-03' GROUP BY 1
    """,
)
def _(spark, sf_dir):
    rows = q.demand_trends(shapes.hourly_mart(spark, sf_dir), "monthly", START, END)
    return rounded(rows, "avg_active_zones", "avg_temperature_f", "avg_precipitation_mm")


@query(
    "trend_hourly",
    """
    SELECT "hour", sum(total_demand)::BIGINT AS total_demand,
      round(avg(avg_temperature_f), 6) AS avg_temperature_f,
      round(avg(avg_precipitation_mm), 6) AS avg_precipitation_mm
    FROM hourly_mart GROUP BY 1
    """,
)
def _(spark, sf_dir):
    rows = q.demand_trends(shapes.hourly_mart(spark, sf_dir), "hourly")
    return rounded(rows, "avg_temperature_f", "avg_precipitation_mm")


@query(
    "trend_weekday",
    """
    SELECT isodow(pickup_hour)::INT AS iso_day_of_week, sum(total_demand)::BIGINT AS total_demand,
      round(avg(avg_temperature_f), 6) AS avg_temperature_f
    FROM hourly_mart GROUP BY 1
    """,
)
def _(spark, sf_dir):
    rows = q.demand_trends(shapes.hourly_mart(spark, sf_dir), "weekday")
    return rounded(rows, "avg_temperature_f")


_PAGE = """
    SELECT pickup_hour, pickup_year_month, "hour", day_of_week, "month", total_demand,
      active_zones, avg_demand_per_active_zone, avg_temperature_f, avg_precipitation_mm,
      (SELECT count(*) FROM hourly_mart) AS total_rows
    FROM hourly_mart ORDER BY pickup_hour DESC LIMIT 200 OFFSET 100
"""


def _page(spark, sf_dir):
    return q.hourly_demand(shapes.stored(shapes.hourly_mart(spark, sf_dir)), limit=200, offset=100)


@query("hourly_page", _PAGE)
def _(spark, sf_dir):
    return _page(spark, sf_dir)


@query(
    "hourly_detail",
    f"""
    SELECT pickup_hour, total_demand, hour(pickup_hour)::INT AS hour_of_day,
      dayname(pickup_hour) AS day_name, isodow(pickup_hour)::INT AS day_order,
      CASE isodow(pickup_hour) WHEN 1 THEN 'Thứ Hai' WHEN 2 THEN 'Thứ Ba' WHEN 3 THEN 'Thứ Tư'
        WHEN 4 THEN 'Thứ Năm' WHEN 5 THEN 'Thứ Sáu' WHEN 6 THEN 'Thứ Bảy' ELSE 'Chủ Nhật' END
        AS day_label,
      date_trunc('month', pickup_hour)::DATE AS pickup_month
    FROM ({_PAGE})
    """,
)
def _(spark, sf_dir):
    return q.hourly_detail(_page(spark, sf_dir)).select(
        "pickup_hour", "total_demand", "hour_of_day", "day_name", "day_order", "day_label",
        "pickup_month",
    )


@query(
    "weather_daily",
    """
    SELECT pickup_hour::DATE AS pickup_date, sum(total_demand)::BIGINT AS daily_demand,
      round(avg(avg_temperature_f), 6) AS temp_f, round(avg(avg_precipitation_mm), 6) AS precip_mm
    FROM hourly_mart GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return rounded(q.weather_daily(shapes.hourly_mart(spark, sf_dir)), "temp_f", "precip_mm")


# --- Zones ---------------------------------------------------------------------------

_ZONES = """
    SELECT *, total_demand::DOUBLE / (SELECT sum(total_demand) FROM zone_mart) AS demand_share,
      total_demand::DOUBLE / nullif(active_hours, 0) AS avg_hourly_demand,
      total_demand::DOUBLE / nullif(active_hours, 0) AS demand_intensity,
      row_number() OVER (ORDER BY total_demand DESC, pu_location_id)::INT AS zone_rank
    FROM (
      SELECT pu_location_id, max(pickup_borough) AS pickup_borough,
        max(pickup_zone) AS pickup_zone, max(pickup_latitude) AS pickup_latitude,
        max(pickup_longitude) AS pickup_longitude, sum(total_demand)::BIGINT AS total_demand,
        sum(active_hours)::BIGINT AS active_hours,
        max(max_hourly_demand)::INT AS max_hourly_demand,
        min(first_pickup_hour) AS first_pickup_hour, max(last_pickup_hour) AS last_pickup_hour,
        round(sum(avg_temperature_f * active_hours) / nullif(sum(active_hours), 0), 6)
          AS avg_temperature_f,
        round(sum(avg_precipitation_mm * active_hours) / nullif(sum(active_hours), 0), 6)
          AS avg_precipitation_mm
      FROM zone_mart GROUP BY pu_location_id)
"""


@query("zone_summary_share", f"{_ZONES} ORDER BY total_demand DESC, pu_location_id LIMIT 25")
def _(spark, sf_dir):
    top = q.zone_summary(shapes.stored(shapes.zone_mart(spark, sf_dir)), limit=25)
    return rounded(top, "avg_temperature_f", "avg_precipitation_mm")


_TREND = """
    SELECT s.pickup_year_month, t.pickup_zone, sum(s.total_demand)::BIGINT AS total_demand
    FROM zone_mart s JOIN (
      SELECT pu_location_id, pickup_zone FROM zone_mart GROUP BY 1, 2
      ORDER BY sum(total_demand) DESC, pu_location_id LIMIT 5) t
    ON s.pu_location_id = t.pu_location_id GROUP BY 1, 2
"""


@query("zone_trend", _TREND)
def _(spark, sf_dir):
    return q.zone_trend(shapes.stored(shapes.zone_mart(spark, sf_dir)), limit=5)


@query(
    "zone_trend_pivot",
    """
    SELECT pickup_year_month,
      coalesce(sum(total_demand) FILTER (pickup_borough = 'AFRICA'), 0)::BIGINT AS "AFRICA",
      coalesce(sum(total_demand) FILTER (pickup_borough = 'ASIA'), 0)::BIGINT AS "ASIA",
      coalesce(sum(total_demand) FILTER (pickup_borough = 'EUROPE'), 0)::BIGINT AS "EUROPE",
      coalesce(sum(total_demand) FILTER (pickup_borough = 'NOWHERE'), 0)::BIGINT AS "NOWHERE"
    FROM zone_mart GROUP BY 1
    """,
)
def _(spark, sf_dir):
    trend = shapes.zone_mart(spark, sf_dir).select(
        "pickup_year_month",
        F.col("pickup_borough").alias("pickup_zone"),
        F.col("total_demand").cast("bigint").alias("total_demand"),
    )
    return q.zone_trend_pivot(trend, ["AFRICA", "ASIA", "EUROPE", "NOWHERE"])


@query(
    "borough_summary",
    """
    SELECT pickup_borough, sum(total_demand)::BIGINT AS total_demand,
      sum(active_hours)::BIGINT AS active_hours
    FROM zone_mart WHERE pickup_borough IS NOT NULL GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return q.borough_summary(shapes.zone_mart(spark, sf_dir))


@query(
    "zones_all",
    "SELECT location_id AS zone_id, zone AS zone_name, borough, latitude, longitude FROM zones",
)
def _(spark, sf_dir):
    return q.zones_all(shapes.zone_table(spark, sf_dir))


# --- Payments --------------------------------------------------------------------------

_LABEL = """CASE payment_type WHEN 1 THEN 'Thẻ tín dụng' WHEN 2 THEN 'Tiền mặt'
      WHEN 3 THEN 'Miễn phí' WHEN 4 THEN 'Tranh chấp' WHEN 5 THEN 'Không xác định'
      WHEN 6 THEN 'Chuyến hủy' ELSE 'Type ' || payment_type END"""


@query(
    "payment_tip_rows",
    """
    SELECT pickup_year_month, payment_type, trip_count, avg_fare_amount, avg_tip_amount,
      avg_tip_percent, median_tip_percent, median_fare_amount, avg_trip_distance
    FROM payment_mart
    """,
)
def _(spark, sf_dir):
    return q.payment_tip_summary(shapes.payment_mart(spark, sf_dir))


@query(
    "payment_detail",
    f"""
    SELECT pickup_year_month, payment_type, trip_count, {_LABEL} AS payment_label,
      trip_count::DOUBLE / (SELECT sum(trip_count) FROM payment_mart) AS trip_share,
      round(avg_tip_amount / nullif(avg_fare_amount, 0), 6) AS tip_per_fare
    FROM payment_mart
    """,
)
def _(spark, sf_dir):
    rows = q.payment_detail(shapes.stored(shapes.payment_mart(spark, sf_dir)))
    return rounded(rows, "tip_per_fare").select(
        "pickup_year_month", "payment_type", "trip_count", "payment_label", "trip_share",
        "tip_per_fare",
    )


_ROLLUP = """sum(trip_count)::BIGINT AS trip_count,
      round(sum(avg_fare_amount * trip_count) / sum(trip_count), 6) AS avg_fare_amount,
      round(sum(avg_tip_percent * trip_count) / sum(trip_count), 6) AS avg_tip_percent"""


@query("payment_monthly", f"SELECT pickup_year_month, {_ROLLUP} FROM payment_mart GROUP BY 1")
def _(spark, sf_dir):
    rows = q.payment_monthly(shapes.payment_mart(spark, sf_dir))
    return rounded(rows, "avg_fare_amount", "avg_tip_percent")


@query("payment_mix", f"SELECT {_LABEL} AS payment_label, {_ROLLUP} FROM payment_mart GROUP BY 1")
def _(spark, sf_dir):
    rows = q.payment_mix(shapes.payment_mart(spark, sf_dir))
    return rounded(rows, "avg_fare_amount", "avg_tip_percent")


# --- Metadata ------------------------------------------------------------------------------


@query(
    "meta",
    """
    SELECT 'dashboard_hourly_demand_kpi' AS table_name, count(*) AS row_count FROM hourly_mart
    UNION ALL SELECT 'dashboard_payment_tip_summary', count(*) FROM payment_mart
    UNION ALL SELECT 'dashboard_zone_summary', count(*) FROM zone_mart
    """,
)
def _(spark, sf_dir):
    return q.meta_counts(
        {
            "dashboard_hourly_demand_kpi": shapes.hourly_mart(spark, sf_dir),
            "dashboard_zone_summary": shapes.zone_mart(spark, sf_dir),
            "dashboard_payment_tip_summary": shapes.payment_mart(spark, sf_dir),
        }
    )


@query("available_months", "SELECT DISTINCT pickup_year_month FROM hourly_mart")
def _(spark, sf_dir):
    return q.available_months(shapes.hourly_mart(spark, sf_dir))


@query(
    "month_selections",
    """
    SELECT selection, count(*) AS "hours", sum(total_demand)::BIGINT AS total_demand
    FROM hourly_mart JOIN (
      SELECT unnest(['reversed', 'unknown', 'one']) AS selection,
        unnest([min(pickup_year_month), min(pickup_year_month), min(pickup_year_month)]) AS a,
        unnest([max(pickup_year_month), max(pickup_year_month), min(pickup_year_month)]) AS b
      FROM hourly_mart) ON pickup_year_month BETWEEN a AND b
    GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """Hours of three selections: bounds the wrong way round, an unknown month, a single one."""
    hourly = shapes.stored(shapes.hourly_mart(spark, sf_dir))
    months = [r.pickup_year_month for r in collect_small(q.available_months(hourly))]
    picks = {"reversed": (months[-1], months[0]), "unknown": ("1900-01", months[0]),
             "one": (months[0], months[0])}
    found = None
    for name, (start, end) in picks.items():
        chosen = q.month_range(hourly, *q.month_bounds(months, start, end))
        one = chosen.select(F.lit(name).alias("selection"), "total_demand")
        found = one if found is None else found.unionByName(one)
    return found.groupBy("selection").agg(
        F.count("*").alias("hours"), F.sum("total_demand").cast("bigint").alias("total_demand")
    )


@query(
    "month_extent",
    """
    SELECT min(pickup_year_month) AS min_month, max(pickup_year_month) AS max_month
    FROM hourly_mart
    """,
)
def _(spark, sf_dir):
    return q.month_extent(shapes.hourly_mart(spark, sf_dir))


# --- Described extras ----------------------------------------------------------------------


@query(
    "moving_average",
    """
    SELECT pickup_date, daily_demand, avg(daily_demand) OVER (
        ORDER BY pickup_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS mean_7d
    FROM (SELECT pickup_hour::DATE AS pickup_date, sum(total_demand)::BIGINT AS daily_demand
          FROM hourly_mart GROUP BY 1)
    """,
)
def _(spark, sf_dir):
    return q.moving_average(shapes.hourly_mart(spark, sf_dir), 7)


@query(
    "moving_average_30",
    """
    SELECT pickup_date, daily_demand, avg(daily_demand) OVER (
        ORDER BY pickup_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS mean_30d
    FROM (SELECT pickup_hour::DATE AS pickup_date, sum(total_demand)::BIGINT AS daily_demand
          FROM hourly_mart GROUP BY 1)
    """,
)
def _(spark, sf_dir):
    return q.moving_average(shapes.hourly_mart(spark, sf_dir), 30)


@query(
    "spikes",
    """
    SELECT d.pu_location_id, d.pickup_hour, d.demand, zone_mean,
      round(zone_std, 6) AS zone_std, round((d.demand - zone_mean) / zone_std, 6) AS z_score
    FROM dense_demand d JOIN (
      SELECT pu_location_id, avg(demand) AS zone_mean, stddev_pop(demand) AS zone_std
      FROM dense_demand GROUP BY 1) s ON s.pu_location_id = d.pu_location_id
    WHERE zone_std > 0 AND abs((d.demand - zone_mean) / zone_std) > 2.5
    """,
)
def _(spark, sf_dir):
    found = q.spikes(shapes.stored(shapes.dense_demand(spark, sf_dir)), 2.5)
    return rounded(found, "zone_std", "z_score")


@query(
    "weather_corr",
    """
    SELECT pu_location_id, count(*) AS hours,
      round(covar_pop(demand, temperature_f::DOUBLE) / nullif(
        stddev_pop(demand) FILTER (temperature_f IS NOT NULL) * stddev_pop(temperature_f), 0), 6)
        AS corr_temperature,
      round(covar_pop(demand, precipitation_mm::DOUBLE) / nullif(
        stddev_pop(demand) FILTER (precipitation_mm IS NOT NULL) * stddev_pop(precipitation_mm),
        0), 6) AS corr_precipitation
    FROM district_demand GROUP BY 1
    """,
)
def _(spark, sf_dir):
    rows = q.weather_corr(shapes.district_demand(spark, sf_dir))
    return rounded(rows, "corr_temperature", "corr_precipitation")


@query(
    "compare_zones",
    """
    SELECT pu_location_id, sum(demand)::BIGINT AS total_demand, min(demand) AS min_demand,
      max(demand) AS max_demand, avg(demand) AS mean_demand,
      round(stddev_samp(demand), 6) AS std_demand
    FROM district_demand GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return rounded(q.compare_zones(shapes.district_demand(spark, sf_dir)), "std_demand")


@query(
    "zone_hour_matrix",
    f"""
    SELECT pu_location_id, {", ".join(
        f'coalesce(sum(demand) FILTER ("hour" = {h}), 0)::BIGINT AS h{h:02d}' for h in range(24))}
    FROM demand GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return q.zone_hour_matrix(shapes.demand(spark, sf_dir))


@query(
    "continuity",
    """
    SELECT pu_location_id, unnest(generate_series(prev + INTERVAL 1 HOUR,
        pickup_hour - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS missing_pickup_hour
    FROM (SELECT pu_location_id, pickup_hour,
            lag(pickup_hour) OVER (PARTITION BY pu_location_id ORDER BY pickup_hour) AS prev
          FROM district_demand)
    WHERE pickup_hour > prev + INTERVAL 1 HOUR
    """,
)
def _(spark, sf_dir):
    return quality.continuity(shapes.district_demand(spark, sf_dir), "pu_location_id")
