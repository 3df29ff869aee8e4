"""The operators that carry the load, over ``lineitem`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, quality, silver
from ..operators.quantiles import cumulative_counts, exact_quantile
from ..plans import dashboard as q
from . import shapes
from .dashboard import rounded
from .registry import query


def _items(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem")


def _zone_months(spark, sf_dir):
    """Supplier x month figures: aggregate line items first, then join the supplier's place."""
    daily = (
        _items(spark, sf_dir)
        .groupBy(
            F.col("l_suppkey").alias("pu_location_id"), F.col("l_shipdate").alias("pickup_hour")
        )
        .agg(F.count("*").alias("demand"))
    )
    months = daily.groupBy(
        F.date_format("pickup_hour", "yyyy-MM").alias("pickup_year_month"), "pu_location_id"
    ).agg(
        F.sum("demand").alias("total_demand"),
        F.max("demand").alias("max_hourly_demand"),
        F.count("*").alias("active_hours"),
        F.min("pickup_hour").alias("first_pickup_hour"),
        F.max("pickup_hour").alias("last_pickup_hour"),
    )
    places = (
        shapes.table(spark, sf_dir, "supplier")
        .join(shapes.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(shapes.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("pu_location_id"),
            F.col("r_name").alias("pickup_borough"),
            F.col("s_name").alias("pickup_zone"),
        )
    )
    nothing = F.lit(None).cast("double")
    return months.join(places, "pu_location_id", "left").withColumns(
        {
            "pickup_latitude": nothing,
            "pickup_longitude": nothing,
            "avg_temperature_f": nothing,
            "avg_precipitation_mm": nothing,
        }
    )


_ZONE_MONTHS = """(
      SELECT m.*, r_name AS pickup_borough, s_name AS pickup_zone FROM (
        SELECT strftime(t, '%Y-%m') AS pickup_year_month, pu_location_id, sum(d) AS total_demand,
          max(d) AS max_hourly_demand, count(*) AS active_hours, min(t) AS first_pickup_hour,
          max(t) AS last_pickup_hour
        FROM (SELECT l_suppkey AS pu_location_id, l_shipdate AS t, count(*) AS d FROM lineitem
              GROUP BY 1, 2) GROUP BY 1, 2) m
      LEFT JOIN supplier ON s_suppkey = pu_location_id
      LEFT JOIN nation ON s_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "volume_zone_share",
    f"""
    SELECT pu_location_id, max(pickup_borough) AS pickup_borough, max(pickup_zone) AS pickup_zone,
      sum(total_demand)::BIGINT AS total_demand, sum(active_hours)::BIGINT AS active_hours,
      max(max_hourly_demand) AS max_hourly_demand, min(first_pickup_hour) AS first_pickup_hour,
      max(last_pickup_hour) AS last_pickup_hour,
      sum(total_demand)::DOUBLE / (SELECT count(*) FROM lineitem) AS demand_share,
      row_number() OVER (ORDER BY sum(total_demand) DESC, pu_location_id)::INT AS zone_rank
    FROM {_ZONE_MONTHS} GROUP BY 1 ORDER BY total_demand DESC, pu_location_id LIMIT 25
    """,
)
def _(spark, sf_dir):
    return q.zone_summary(shapes.stored(_zone_months(spark, sf_dir)), limit=25).drop(
        "pickup_latitude", "pickup_longitude", "avg_temperature_f", "avg_precipitation_mm",
        "avg_hourly_demand", "demand_intensity",
    )


@query(
    "volume_zone_trend",
    f"""
    SELECT s.pickup_year_month, t.pickup_zone, sum(s.total_demand)::BIGINT AS total_demand
    FROM {_ZONE_MONTHS} s JOIN (
      SELECT pu_location_id, pickup_zone FROM {_ZONE_MONTHS} GROUP BY 1, 2
      ORDER BY sum(total_demand) DESC, pu_location_id LIMIT 5) t
    ON s.pu_location_id = t.pu_location_id GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    return q.zone_trend(shapes.stored(_zone_months(spark, sf_dir)), limit=5)


@query(
    "volume_borough",
    f"""
    SELECT pickup_borough, sum(total_demand)::BIGINT AS total_demand,
      sum(active_hours)::BIGINT AS active_hours
    FROM {_ZONE_MONTHS} WHERE pickup_year_month BETWEEN '1994-01' AND '1996-12' GROUP BY 1
    """,
)
def _(spark, sf_dir):
    return q.borough_summary(_zone_months(spark, sf_dir), "1994-01", "1996-12")


_PAID = """(SELECT strftime(o_orderdate, '%Y-%m') AS pickup_year_month,
      l_returnflag AS payment_type, l_extendedprice::DECIMAL(12, 2) AS fare_amount,
      round(l_discount * 100)::INT AS tip_percent, l_quantity AS trip_distance
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _paid(spark, sf_dir):
    items, orders = _items(spark, sf_dir), shapes.table(spark, sf_dir, "orders")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.date_format("o_orderdate", "yyyy-MM").alias("pickup_year_month"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("fare_amount"),
        F.round(F.col("l_discount") * 100).cast("int").alias("tip_percent"),
        F.col("l_quantity").alias("trip_distance"),
    )


@query(
    "volume_payment_summary",
    f"""
    SELECT pickup_year_month, payment_type, count(*) AS trip_count,
      sum(fare_amount)::DOUBLE / count(*) AS avg_fare_amount,
      avg(tip_percent) AS avg_tip_percent, avg(trip_distance) AS avg_trip_distance,
      min(fare_amount) AS min_fare_amount, max(fare_amount) AS max_fare_amount
    FROM {_PAID} GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    return (
        _paid(spark, sf_dir)
        .groupBy("pickup_year_month", "payment_type")
        .agg(
            F.count("*").alias("trip_count"),
            (F.sum("fare_amount").cast("double") / F.count("*")).alias("avg_fare_amount"),
            F.avg("tip_percent").alias("avg_tip_percent"),
            F.avg("trip_distance").alias("avg_trip_distance"),
            F.min("fare_amount").alias("min_fare_amount"),
            F.max("fare_amount").alias("max_fare_amount"),
        )
    )


@query(
    "volume_median_exact",
    f"""
    SELECT payment_type, quantile_disc(fare_amount, 0.5) AS quantile FROM {_PAID} GROUP BY 1
    """,
)
def _(spark, sf_dir):
    """Three groups hold everything, yet no task sees more than one price bucket of a group."""
    bucket = F.floor(F.col("fare_amount") / 100)
    return exact_quantile(
        _paid(spark, sf_dir), ["payment_type"], "fare_amount", 0.5, bucket=bucket
    )


@query("volume_median_approx")
def _(spark, sf_dir):
    median = F.percentile_approx("fare_amount", 0.5, 10000).alias("quantile")
    return _paid(spark, sf_dir).groupBy("payment_type").agg(median)


@query(
    "volume_value_ranks",
    """
    SELECT l_returnflag, l_quantity, count(*) AS n,
      min(rn) AS first_rank, max(rn) AS last_rank, min(total) AS group_rows
    FROM (SELECT l_returnflag, l_quantity,
            row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rn,
            count(*) OVER (PARTITION BY l_returnflag) AS total FROM lineitem)
    GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    return cumulative_counts(
        _items(spark, sf_dir), ["l_returnflag"], "l_quantity", F.floor(F.col("l_quantity") / 10)
    )


_ITEM_COLUMNS = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


@query(
    "volume_dedup",
    f"""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {", ".join(_ITEM_COLUMNS)}) = 1
    """,
)
def _(spark, sf_dir):
    """First row per business key; the group limit below the shuffle absorbs repeats."""
    items = _items(spark, sf_dir)
    return silver.keep_first(items, ["l_orderkey", "l_linenumber"], _ITEM_COLUMNS).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity"
    )


@query(
    "volume_time_order",
    """
    SELECT l_returnflag, count(*) AS kept FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate >= o_orderdate GROUP BY 1
    """,
)
def _(spark, sf_dir):
    items, orders = _items(spark, sf_dir), shapes.table(spark, sf_dir, "orders")
    trips = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumnsRenamed(
        {"l_shipdate": "dropoff_datetime", "o_orderdate": "pickup_datetime"}
    )
    kept = silver.ordered_times(trips)
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("kept"))


@query(
    "volume_double_join",
    """
    SELECT pn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS trips,
      sum(l_extendedprice::DECIMAL(12, 2))::DECIMAL(22, 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation pn ON c_nationkey = pn.n_nationkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    GROUP BY 1, 2
    """,
)
def _(spark, sf_dir):
    """Both ends of a trip looked up in their dimensions, then rolled up.

    Orders learn their customer's nation first; line items meet them in the one
    join on the order key and collapse to (nation, supplier) before the second
    dimension is looked up, so they are shuffled once.
    """
    nation = shapes.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = (
        shapes.table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("customer_nation"))
    )
    suppliers = (
        shapes.table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("supplier_nation"))
    )
    orders = (
        shapes.table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        .join(customers, "o_custkey", "left")
        .drop("o_custkey")
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    per_supplier = (
        _items(spark, sf_dir)
        .select("l_orderkey", "l_suppkey", price.alias("price"))
        .join(orders, "l_orderkey")
        .groupBy("customer_nation", "l_suppkey")
        .agg(F.count("*").alias("trips"), F.sum("price").alias("revenue"))
    )
    return (
        per_supplier.join(suppliers, "l_suppkey", "left")
        .groupBy("customer_nation", "supplier_nation")
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("revenue").cast("decimal(22,2)").alias("revenue"),
        )
    )


@query(
    "volume_quality",
    """
    SELECT count(*) FILTER (l_quantity <= 0) AS non_positive_quantity,
      count(*) FILTER (l_extendedprice > 50000) AS high_price,
      count(*) FILTER (l_discount NOT BETWEEN 0 AND 0.05) AS high_discount,
      count(*) FILTER (l_shipdate IS NULL) AS no_date,
      count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) AS unknown_flag FROM lineitem
    """,
)
def _(spark, sf_dir):
    return quality.rule_counts(
        _items(spark, sf_dir),
        {
            "non_positive_quantity": F.col("l_quantity") <= 0,
            "high_price": F.col("l_extendedprice") > 50000,
            "high_discount": ~F.col("l_discount").between(0, 0.05),
            "no_date": F.col("l_shipdate").isNull(),
            "unknown_flag": ~F.col("l_returnflag").isin("A", "N", "R"),
        },
    )


@query(
    "volume_counts_by",
    """
    SELECT 'l_returnflag' AS dimension, l_returnflag AS "value", count(*) AS row_count
    FROM lineitem GROUP BY 2
    UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
    UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY 2
    """,
)
def _(spark, sf_dir):
    return profile.counts_by(
        _items(spark, sf_dir), ["l_returnflag", "l_linestatus", "l_linenumber"]
    )


@query(
    "volume_spread",
    """
    SELECT l_suppkey AS pu_location_id, sum(l_quantity)::BIGINT AS total_demand,
      round(avg(l_quantity), 6) AS mean_demand, round(stddev_samp(l_quantity), 6) AS std_demand
    FROM lineitem GROUP BY 1
    """,
)
def _(spark, sf_dir):
    rows = _items(spark, sf_dir).select(
        F.col("l_suppkey").alias("pu_location_id"), F.col("l_quantity").alias("demand")
    )
    spread = q.compare_zones(rows).drop("min_demand", "max_demand")
    return rounded(spread, "mean_demand", "std_demand")
