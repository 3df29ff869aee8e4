"""One-pass data profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from .quantiles import cumulative_counts


def unpivot_row(wide: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row frame into one output row per entry of ``rows``."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))


def nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and ratio per column; requested columns that are absent are listed.

    All columns are counted in one scan.
    """
    wanted = list(columns) if columns is not None else df.columns
    present = [c for c in wanted if c in df.columns]
    wide = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present],
    )
    rows = []
    for c in wanted:
        if c in present:
            count, status = F.col(f"null_{c}"), "present"
            ratio = F.coalesce(F.try_divide(count, F.col("_rows")), F.lit(0.0))
        else:
            count, ratio = F.lit(None).cast("bigint"), F.lit(None).cast("double")
            status = "missing"
        rows.append(
            {
                "column_name": F.lit(c),
                "null_count": count,
                "null_ratio": ratio.cast("double"),
                "status": F.lit(status),
            }
        )
    return unpivot_row(wide, rows)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def counts_by(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Row counts by each available dimension: (dimension, value, row_count).

    Every row is turned into one (dimension, value) pair per dimension and
    counted in a single shuffle; partial counts shrink the pairs before it.
    """
    present = [d for d in dimensions if d in df.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
            for d in present
        ]
    )
    return (
        df.select(*present)
        .select(F.inline(pairs))
        .groupBy("dimension", "value")
        .agg(F.count("*").alias("row_count"))
    )


def payloads(bronze: DataFrame, body: str = "json_data") -> DataFrame:
    """Event count, metadata nulls and payload length profile (p95 approximate)."""
    required = [c for c in K.ENVELOPE_METADATA if c != "key" and c in bronze.columns]
    size = F.length(body)
    null_cells = [F.count_if(F.col(c).isNull()) for c in required]
    total_nulls = sum(null_cells[1:], null_cells[0]) if null_cells else F.lit(0)
    return bronze.agg(
        F.count("*").alias("event_rows"),
        total_nulls.alias("required_metadata_nulls"),
        F.min(size).alias("min_payload_chars"),
        F.avg(size).alias("avg_payload_chars"),
        F.percentile_approx(size, 0.95).alias("p95_payload_chars"),
        F.max(size).alias("max_payload_chars"),
    )


def json_fields(bronze: DataFrame, expected: Sequence[str], body: str = "json_data") -> DataFrame:
    """In how many payloads does each expected field occur?  Reads every payload."""
    keys = bronze.select(F.json_object_keys(body).alias("_keys"))
    wide = keys.agg(
        F.count("*").alias("_rows"),
        F.count_if(F.col("_keys").isNull()).alias("_unreadable"),
        *[F.count_if(F.array_contains("_keys", f)).alias(f"has_{f}") for f in expected],
    )
    return unpivot_row(
        wide,
        [
            {
                "expected_field": F.lit(f),
                "present_rows": F.col(f"has_{f}"),
                "total_rows": F.col("_rows"),
                "unreadable_rows": F.col("_unreadable"),
            }
            for f in expected
        ],
    )


def schemas(datasets: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Which dataset has which column, and under which type."""
    spark = next(iter(datasets.values())).sparkSession
    rows = []
    for name, df in datasets.items():
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        rows += [(name, c, c in types, types.get(c)) for c in columns]
    return spark.createDataFrame(
        rows, "dataset_name string, column_name string, is_present boolean, data_type string"
    )


def time_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Earliest and latest value of each available time column."""
    present = [c for c in columns if c in df.columns]
    wide = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in present],
        *[F.max(c).alias(f"max_{c}") for c in present],
    )
    return unpivot_row(
        wide,
        [
            {
                "column_name": F.lit(c),
                "min_value": F.col(f"min_{c}"),
                "max_value": F.col(f"max_{c}"),
            }
            for c in present
        ],
    )


QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def distribution(
    df: DataFrame, columns: Sequence[str], *, accuracy: int = 10_000, exact: bool = False
) -> DataFrame:
    """Count, range, mean, spread and five quantiles per column.

    Quantiles come from mergeable sketches with relative rank error 1/accuracy, in
    the same scan; with ``exact`` all figures come from counts of the distinct values.
    """
    present = [c for c in columns if c in df.columns]
    if exact:
        return _exact_distribution(df, present)
    aggs: list[Column] = []
    for c in present:
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"{c}__n"),
            F.min(v).alias(f"{c}__min"),
            F.max(v).alias(f"{c}__max"),
            F.avg(v).alias(f"{c}__avg"),
            F.stddev(v).alias(f"{c}__std"),
            F.percentile_approx(v, list(QUANTILES.values()), accuracy).alias(f"{c}__q"),
        ]
    rows = [
        {
            "column_name": F.lit(c),
            "non_null_count": F.col(f"{c}__n"),
            "min_value": F.col(f"{c}__min"),
            "max_value": F.col(f"{c}__max"),
            "avg_value": F.col(f"{c}__avg"),
            "stddev_value": F.col(f"{c}__std"),
            **{q: F.col(f"{c}__q")[i] for i, q in enumerate(QUANTILES)},
        }
        for c in present
    ]
    return unpivot_row(df.agg(*aggs), rows)


def _exact_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All figures from one scan: the columns' distinct values are counted and stored."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in columns
    ]
    values = df.select(F.inline(F.array(*pairs))).filter("_v IS NOT NULL")
    counts = materialize(
        values.groupBy("column_name", "_v").agg(F.count("*").alias("_rows")), "value-counts"
    )
    v, rows = F.col("_v"), F.col("_rows")
    sums = counts.groupBy("column_name").agg(
        F.sum("_rows").alias("non_null_count"),
        F.min("_v").alias("min_value"),
        F.max("_v").alias("max_value"),
        F.try_divide(F.sum(v * rows), F.sum("_rows")).alias("avg_value"),
    )
    # A row per column.  Squares of distances from the mean lose no digits to its size.
    sums = F.broadcast(sums)
    apart = v - F.col("avg_value")
    spread = counts.join(sums, "column_name").groupBy("column_name").agg(
        F.sqrt(F.try_divide(F.sum(apart * apart * rows), F.sum("_rows") - 1)).alias("stddev_value")
    )
    ranked = cumulative_counts(counts, ["column_name"], "_v", F.floor("_v"), weight="_rows")
    picks = []
    for name, share in QUANTILES.items():
        # Whole percents in whole numbers, so that no border moves by rounding.
        rank = F.expr(f"greatest(1, (group_rows * {round(share * 100)} + 99) div 100)")
        hit = (F.col("first_rank") <= rank) & (rank <= F.col("last_rank"))
        picks.append(F.max(F.when(hit, v)).alias(name))
    quantiles = ranked.groupBy("column_name").agg(*picks)
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    found = every.join(sums, "column_name", "left").fillna(0, ["non_null_count"])
    for part in (spread, quantiles):
        found = found.join(F.broadcast(part), "column_name", "left")
    return found


def demand_shape(trips: DataFrame) -> DataFrame:
    """Trip counts by hour of day, weekday, month and taxi type: (dimension, value, trip_count)."""
    parts = trips.select(
        F.hour("pickup_hour").alias("hour_of_day"),
        F.dayofweek("pickup_date").alias("day_of_week"),
        F.month("pickup_date").alias("pickup_month"),
        "taxi_type",
    )
    return counts_by(parts, parts.columns).withColumnRenamed("row_count", "trip_count")


def by_type(trips: DataFrame) -> DataFrame:
    """Time range and rounded averages per taxi type."""
    return trips.groupBy("taxi_type").agg(
        F.count("*").alias("trip_count"),
        F.min("pickup_datetime").alias("min_pickup_time"),
        F.max("pickup_datetime").alias("max_pickup_time"),
        F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"),
        F.round(F.avg("fare_amount"), 2).alias("avg_fare_amount"),
        F.round(F.avg("tip_amount"), 2).alias("avg_tip_amount"),
    )


def weather(
    readings: DataFrame,
    time_column: str = "weather_hour",
    measures: Sequence[str] = ("temperature_f", "precipitation_mm"),
) -> DataFrame:
    """Rows, distinct hours, range and nulls of a weather table."""
    present = [m for m in measures if m in readings.columns]
    return readings.agg(
        F.count("*").alias("row_count"),
        F.count_distinct(time_column).alias("distinct_hours"),
        F.min(time_column).alias("min_time"),
        F.max(time_column).alias("max_time"),
        *[F.count_if(F.col(m).isNull()).alias(f"null_{m}") for m in present],
    )


def zones(zone_table: DataFrame) -> DataFrame:
    """Zones per borough, most first."""
    return (
        zone_table.groupBy("borough")
        .agg(F.count("*").alias("zone_count"))
        .orderBy(F.desc("zone_count"), "borough")
    )
