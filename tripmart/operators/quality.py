"""Contract checks, audits and the failing gate.

A check is one row (dataset_name, dataset_path, check_name, check_value, status,
details), all strings.  Every value that needs data comes from one aggregation
per table, however many checks there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .profile import duplicates, unpivot_row

CHECK_SCHEMA = (
    "dataset_name string, dataset_path string, check_name string, "
    "check_value string, status string, details string"
)


class QualityError(RuntimeError):
    """At least one check failed."""


class Dataset(NamedTuple):
    name: str
    path: str = ""


class Check(NamedTuple):
    """A value with the condition (over the aggregated row) under which it passes."""

    name: str
    value: Column
    passes: Column | None = None
    details: Column | str = ""


def _status(passes: Column | None) -> Column:
    if passes is None:
        return F.lit("pass")
    return F.when(passes, "pass").otherwise("fail")


def _rows(wide: DataFrame, dataset: Dataset, checks: Sequence[Check]) -> DataFrame:
    return unpivot_row(
        wide,
        [
            {
                "dataset_name": F.lit(dataset.name),
                "dataset_path": F.lit(dataset.path),
                "check_name": F.lit(c.name),
                "check_value": c.value.cast("string"),
                "status": _status(c.passes),
                "details": F.lit(c.details) if isinstance(c.details, str) else c.details,
            }
            for c in checks
        ],
    )


def schema_contract(
    df: DataFrame, contract: Mapping[str, str], dataset: Dataset = Dataset("")
) -> DataFrame:
    """Column-by-column comparison of the schema; extra columns pass, missing ones fail.

    Uses schema metadata only.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []

    def add(name: str, value: object, good: bool, details: str = "") -> None:
        status = "pass" if good else "fail"
        rows.append((dataset.name, dataset.path, name, str(value), status, details))

    for column, kind in contract.items():
        found = actual.get(column)
        add(f"schema_{column}", found, found == kind, f"expected={kind}")
    missing = sorted(set(contract) - set(actual))
    add("schema_extra_columns", sorted(set(actual) - set(contract)), True)
    add("schema_missing_columns", missing, not missing)
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


class _Plan:
    """Collects aggregates and the checks over them, so that one pass computes all."""

    def __init__(self) -> None:
        self.aggregates: dict[str, Column] = {}
        self.checks: list[Check] = []

    def value(self, name: str, aggregate: Column) -> Column:
        self.aggregates.setdefault(name, aggregate)
        return F.col(name)

    def info(self, name: str, aggregate: Column, details: str = "") -> None:
        self.checks.append(Check(name, self.value(name, aggregate), None, details))

    def must_be_zero(self, name: str, condition: Column, details: str = "") -> None:
        count = self.value(name, F.count_if(condition))
        self.checks.append(Check(name, count, count == 0, details))

    def run(self, df: DataFrame, dataset: Dataset) -> DataFrame:
        wide = df.agg(*[a.alias(n) for n, a in self.aggregates.items()])
        return _rows(wide, dataset, self.checks)


def _row_count(plan: _Plan, name: str) -> Column:
    total = plan.value(name, F.count("*"))
    plan.checks.append(Check(name, total, total > 0))
    return total


def _null_plan(
    plan: _Plan, total: Column, required: Sequence[str], nullable: Sequence[str]
) -> None:
    for prefix, columns in (("critical_null", required), ("known_nullable_null", nullable)):
        for c in columns:
            count = plan.value(f"{prefix}_{c}", F.count_if(F.col(c).isNull()))
            ratio = F.coalesce(F.try_divide(count, total), F.lit(0.0))
            details = F.concat(F.lit("ratio="), F.format_string("%.8f", ratio))
            passes = count == 0 if prefix == "critical_null" else None
            plan.checks.append(Check(f"{prefix}_{c}", count, passes, details))


def null_checks(
    df: DataFrame,
    required: Sequence[str],
    nullable: Sequence[str] = (),
    dataset: Dataset = Dataset(""),
) -> DataFrame:
    """Nulls in required columns fail; nulls in known nullable columns are reported."""
    plan = _Plan()
    total = plan.value("_rows", F.count("*"))
    _null_plan(plan, total, required, nullable)
    return plan.run(df, dataset)


def key_checks(
    df: DataFrame, keys: Sequence[str], name: str, dataset: Dataset = Dataset("")
) -> DataFrame:
    """Number of key values that occur more than once; must be zero."""
    plan = _Plan()
    groups = plan.value(name, F.count("*"))
    plan.checks.append(Check(name, groups, groups == 0))
    return plan.run(duplicates(df, keys), dataset)


def _outside(name: str, low: int, high: int) -> Column:
    return (F.col(name) < low) | (F.col(name) > high)


def _calendar_rules(plan: _Plan) -> None:
    plan.must_be_zero("invalid_hour_rows", _outside("hour", 0, 23))
    plan.must_be_zero("invalid_day_of_week_rows", _outside("day_of_week", 1, 7))
    plan.must_be_zero("invalid_month_rows", _outside("month", 1, 12))


_BASELINE_NOTE = "Compared again after publication."


def _demand_rules(plan: _Plan) -> None:
    plan.info("min_pickup_hour", F.min("pickup_hour"))
    plan.info("max_pickup_hour", F.max("pickup_hour"))
    plan.info("total_demand", F.coalesce(F.sum("demand"), F.lit(0)), _BASELINE_NOTE)
    plan.info(
        "pickup_year_month_count", F.count_distinct("pickup_year_month"), _BASELINE_NOTE
    )
    plan.must_be_zero("non_positive_demand_rows", F.col("demand") <= 0)
    _calendar_rules(plan)


def _fare_tip_rules(
    plan: _Plan,
    min_fare: float = K.MIN_MODEL_FARE,
    max_fare: float = K.MAX_MODEL_FARE,
    max_tip_percent: float = K.MAX_TIP_PERCENT,
) -> None:
    fare, tip = F.col("fare_amount"), F.col("tip_percent")
    plan.must_be_zero("non_positive_fare_rows", fare <= 0)
    plan.must_be_zero(
        "below_min_tip_model_fare_rows", fare < min_fare, f"minimum={min_fare}"
    )
    plan.must_be_zero(
        "above_max_fare_model_amount_rows", fare > max_fare, f"maximum={max_fare}"
    )
    plan.must_be_zero("non_positive_distance_rows", F.col("trip_distance") <= 0)
    plan.must_be_zero("negative_tip_percent_rows", tip < 0)
    plan.must_be_zero("high_tip_percent_rows", tip > max_tip_percent, f"maximum={max_tip_percent}")
    _calendar_rules(plan)
    plan.info(
        "credit_card_payment_rows",
        F.count_if(F.col("payment_type") == K.CARD_PAYMENT),
        "Tip shares are learned from these rows only.",
    )


def _core_rules(plan: _Plan) -> None:
    plan.info("min_pickup_datetime", F.min("pickup_datetime"))
    plan.info("max_pickup_datetime", F.max("pickup_datetime"))
    plan.info("outlier_rows", F.count_if(F.col("is_outlier_trip")))
    plan.info("non_outlier_rows", F.count_if(~F.col("is_outlier_trip")))


def rule_checks(df: DataFrame, table: str, dataset: Dataset | None = None) -> DataFrame:
    """Value rules of one table (``core``, ``demand`` or ``fare_tip``)."""
    plan = _Plan()
    _RULES[table](plan)
    return plan.run(df, dataset or Dataset(table))


_RULES = {"core": _core_rules, "demand": _demand_rules, "fare_tip": _fare_tip_rules}
_CONTRACTS = {
    "core": (K.CORE_CONTRACT, K.CORE_REQUIRED, K.CORE_NULLABLE, "core_row_count"),
    "demand": (K.DEMAND_CONTRACT, K.DEMAND_REQUIRED, [], "demand_row_count"),
    "fare_tip": (K.FARE_TIP_CONTRACT, K.FARE_TIP_REQUIRED, K.FARE_TIP_NULLABLE,
                 "fare_tip_row_count"),
}


def check_table(df: DataFrame, table: str, dataset: Dataset | None = None) -> DataFrame:
    """All checks of a table: schema, row count, nulls, rules and, for demand, the key.

    Row count, nulls and rules share one scan; the key check adds one shuffle.
    """
    dataset = dataset or Dataset(table)
    contract, required, nullable, count_name = _CONTRACTS[table]
    plan = _Plan()
    total = _row_count(plan, count_name)
    _null_plan(plan, total, required, nullable)
    _RULES[table](plan)
    report = schema_contract(df, contract, dataset).unionByName(plan.run(df, dataset))
    if table == "demand":
        keyed = key_checks(
            df,
            ["pu_location_id", "pickup_hour"],
            "duplicate_pu_location_pickup_hour_groups",
            dataset,
        )
        report = report.unionByName(keyed)
    return report


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows violating each named condition, as one wide row."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])


# Declarative table constraints: column -> (nullable, condition that must hold).
TABLE_CONSTRAINTS: dict[str, dict[str, str]] = {
    "hourly_kpi": {
        "hour": "hour BETWEEN 0 AND 23",
        "day_of_week": "day_of_week BETWEEN 1 AND 7",
        "month": "month BETWEEN 1 AND 12",
        "total_demand": "total_demand > 0",
        "active_zones": "active_zones > 0",
        "max_zone_hour_demand": "max_zone_hour_demand > 0",
    },
    "zone_summary": {
        "total_demand": "total_demand > 0",
        "max_hourly_demand": "max_hourly_demand > 0",
        "active_hours": "active_hours > 0",
    },
    "payment_tip_summary": {
        "trip_count": "trip_count > 0",
        "month": "month BETWEEN 1 AND 12",
    },
    "demand": {
        "demand": "demand > 0",
        "hour": "hour BETWEEN 0 AND 23",
        "day_of_week": "day_of_week BETWEEN 1 AND 7",
        "month": "month BETWEEN 1 AND 12",
    },
    "fare_tip": {
        "fare_amount": "fare_amount BETWEEN 2.50 AND 300.00",
        "tip_amount": "tip_amount >= 0",
        "tip_percent": "tip_percent BETWEEN 0 AND 100",
        "trip_distance": "trip_distance > 0",
        "hour": "hour BETWEEN 0 AND 23",
        "day_of_week": "day_of_week BETWEEN 1 AND 7",
        "month": "month BETWEEN 1 AND 12",
    },
}
NULLABLE_COLUMNS = {
    "hourly_kpi": set(),
    "zone_summary": {
        "pickup_borough", "pickup_zone", "pickup_latitude", "pickup_longitude",
    },
    "payment_tip_summary": {"payment_type"},
    "demand": set(),
    "fare_tip": set(K.FARE_TIP_NULLABLE),
}
PRIMARY_KEYS = {
    "hourly_kpi": ["pickup_hour"],
    "zone_summary": ["pickup_year_month", "pu_location_id"],
    "demand": ["pu_location_id", "pickup_hour"],
}


def constraints(df: DataFrame, table: str, dataset: Dataset | None = None) -> DataFrame:
    """NOT NULL, range and primary-key constraints as checks."""
    dataset = dataset or Dataset(table)
    plan = _Plan()
    for c in df.columns:
        if c not in NULLABLE_COLUMNS[table]:
            plan.must_be_zero(f"not_null_{c}", F.col(c).isNull())
    for c, condition in TABLE_CONSTRAINTS[table].items():
        plan.must_be_zero(f"check_{c}", ~F.expr(condition), condition)
    report = plan.run(df, dataset)
    if table in PRIMARY_KEYS:
        report = report.unionByName(
            key_checks(df, PRIMARY_KEYS[table], "primary_key", dataset)
        )
    return report


# --- Lineage and audits -----------------------------------------------------


def lineage(
    source: DataFrame | None, target: DataFrame, dataset: Dataset = Dataset("core")
) -> DataFrame:
    """Target row count must equal source row count; skipped when there is no source."""
    if source is None:
        row = (dataset.name, dataset.path, "core_matches_enriched_count", "skipped", "pass",
               "source not available")
        return target.sparkSession.createDataFrame([row], CHECK_SCHEMA)
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    plan = _Plan()
    s = plan.value("s", F.coalesce(F.sum("s"), F.lit(0)))
    t = plan.value("t", F.coalesce(F.sum("t"), F.lit(0)))
    plan.checks += [
        Check("enriched_row_count", s),
        Check("core_row_count_for_compare", t),
        Check("core_matches_enriched_count", s == t, s == t),
    ]
    return plan.run(sides, dataset)


def retention(core: DataFrame, clean: DataFrame) -> DataFrame:
    """How many Core rows survive into Clean."""
    sides = core.select(F.lit(1).alias("core"), F.lit(0).alias("clean")).unionAll(
        clean.select(F.lit(0).alias("core"), F.lit(1).alias("clean"))
    )
    return sides.agg(
        F.coalesce(F.sum("core"), F.lit(0)).alias("core_rows"),
        F.coalesce(F.sum("clean"), F.lit(0)).alias("clean_rows"),
    ).withColumns(
        {
            "rows_rejected_for_missing_critical_fields": F.col("core_rows") - F.col("clean_rows"),
            "clean_retention_ratio": F.try_divide(F.col("clean_rows"), F.col("core_rows")),
        }
    )


def candidate_ratio(clean: DataFrame) -> DataFrame:
    flag = F.col("is_gold_candidate")
    return clean.agg(
        F.count("*").alias("clean_rows"),
        F.count_if(flag).alias("gold_candidate_true_rows"),
        F.count_if(~flag).alias("gold_candidate_false_rows"),
        F.count_if(flag.isNull()).alias("gold_candidate_null_rows"),
    ).withColumn(
        "gold_candidate_ratio",
        F.try_divide(F.col("gold_candidate_true_rows"), F.col("clean_rows")),
    )


def outlier_profile(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~F.col("is_valid_distance")).alias("invalid_distance_rows"),
        F.count_if(~F.col("is_valid_fare")).alias("invalid_fare_rows"),
        F.count_if(~F.col("is_valid_total_amount")).alias("invalid_total_amount_rows"),
        F.count_if(F.col("is_outlier_trip")).alias("outlier_trip_rows"),
    )


def core_profile(core: DataFrame) -> DataFrame:
    return core.agg(
        F.min("pickup_datetime").alias("min_pickup_datetime"),
        F.max("pickup_datetime").alias("max_pickup_datetime"),
        F.count_if(F.col("is_outlier_trip")).alias("outlier_rows"),
        F.count_if(~F.col("is_outlier_trip")).alias("non_outlier_rows"),
    )


def imputation_audit(clean: DataFrame) -> DataFrame:
    """Per imputed column: were nulls replaced by the default and values kept?

    All columns are audited in one scan.
    """
    aggs = []
    for c, default in K.IMPUTE_DEFAULTS.items():
        value, twin = F.col(c), F.col(f"{c}_clean")
        flag = F.col(f"is_{c}_missing")
        wrong_fill = ~(flag & twin.eqNullSafe(F.lit(default).cast(K.CORE_CONTRACT[c])))
        wrong_copy = ~(~flag & twin.eqNullSafe(value))
        aggs += [
            F.count_if(value.isNull()).alias(f"{c}__nulls"),
            F.count_if(flag).alias(f"{c}__flags"),
            F.count_if(value.isNull() & wrong_fill).alias(f"{c}__fill"),
            F.count_if(value.isNotNull() & wrong_copy).alias(f"{c}__copy"),
        ]
    rows = [
        {
            "original_column": F.lit(c),
            "clean_column": F.lit(f"{c}_clean"),
            "default_value": F.lit(default),
            "original_null_count": F.col(f"{c}__nulls"),
            "missing_flag_true_count": F.col(f"{c}__flags"),
            "imputation_violations": F.col(f"{c}__fill"),
            "preservation_violations": F.col(f"{c}__copy"),
            "status": _status((F.col(f"{c}__fill") == 0) & (F.col(f"{c}__copy") == 0)),
        }
        for c, default in K.IMPUTE_DEFAULTS.items()
    ]
    return unpivot_row(clean.agg(*aggs), rows)


def join_coverage(
    joined: DataFrame,
    fields: Sequence[str] = ("weather_timestamp", "temperature_f", "precipitation_mm"),
) -> DataFrame:
    """Share of rows for which the joined fields are present."""
    present = [f for f in fields if f in joined.columns]
    wide = joined.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in present],
    )
    return unpivot_row(
        wide,
        [
            {
                "weather_field": F.lit(f),
                "total_rows": F.col("_rows"),
                "null_rows": F.col(f"null_{f}"),
                "coverage_ratio": F.coalesce(
                    F.try_divide(F.col("_rows") - F.col(f"null_{f}"), F.col("_rows")), F.lit(0.0)
                ),
            }
            for f in present
        ],
    )


def join_cardinality(dim: DataFrame, key: str = "weather_hour") -> DataFrame:
    """Proof that joining ``dim`` on ``key`` cannot multiply rows."""
    per_key = dim.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count("*").alias("weather_hour_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_weather_hours"),
        F.max("n").alias("max_rows_per_weather_hour"),
    ).withColumn(
        "weather_join_cardinality_status", _status(F.col("duplicate_weather_hours") == 0)
    )


def weather_conformance(core: DataFrame, weather: DataFrame) -> DataFrame:
    """Do Core's weather values match the hourly table, and does every hour exist there?

    Core is reduced to its distinct (hour, values) combinations first, so the
    join works on hours rather than trips.
    """
    measures = [
        "temperature_f", "humidity_percent", "precipitation_mm", "weather_code",
        "wind_speed_kmh", "wind_direction_deg", "cloud_cover_percent",
    ]
    hours = core.groupBy("pickup_hour", *measures).agg(F.count("*").alias("trips"))
    expected = weather.select(
        F.col("weather_hour").alias("pickup_hour"),
        *[F.col(m).try_cast(K.CORE_CONTRACT[m]).alias(f"w_{m}") for m in measures],
        F.lit(True).alias("_known"),
    )
    joined = hours.join(expected, "pickup_hour", "left")
    known = F.col("_known").isNotNull()
    return joined.agg(
        F.count_distinct(F.when(~known, F.col("pickup_hour"))).alias("hours_missing_in_weather"),
        F.coalesce(F.sum(F.when(~known, F.col("trips"))), F.lit(0)).alias(
            "trips_without_weather_hour"
        ),
        *[
            F.coalesce(
                F.sum(
                    F.when(known & ~F.col(m).eqNullSafe(F.col(f"w_{m}")), F.col("trips"))
                ),
                F.lit(0),
            ).alias(f"mismatched_{m}")
            for m in measures
        ],
    )


def continuity(df: DataFrame, key: str, ts: str = "pickup_hour") -> DataFrame:
    """Hours missing inside each key's own time span.

    Gaps are found from neighbouring hours and expanded; no full grid is built.
    """
    from pyspark.sql import Window

    hours = df.select(key, F.col(ts).cast("timestamp").alias(ts)).distinct()
    before = F.lag(ts).over(Window.partitionBy(key).orderBy(ts))
    hour = F.expr("interval 1 hour")
    return (
        hours.withColumn("_before", before)
        .filter(F.col(ts) > F.col("_before") + hour)
        .select(
            key,
            F.explode(F.sequence(F.col("_before") + hour, F.col(ts) - hour, hour)).alias(
                f"missing_{ts}"
            ),
        )
    )


# --- Reports ------------------------------------------------------------------


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare two long metric tables (check_name, check_value) name by name."""
    left = expected.select("check_name", F.col("check_value").alias("expected_value"))
    right = actual.select("check_name", F.col("check_value").alias("actual_value"))
    equal = F.col("expected_value").eqNullSafe(F.col("actual_value"))
    return left.join(right, "check_name", "full_outer").withColumn("status", _status(equal))


def summarize(report: DataFrame) -> DataFrame:
    """Checks per kind (name prefix) and status."""
    name = F.col("check_name")
    kind = (
        F.when(name.startswith("schema_"), "schema")
        .when(name.startswith("critical_null_") | name.startswith("known_nullable_null_"), "null")
        .otherwise("value")
    )
    return report.groupBy(kind.alias("check_kind"), "status").agg(
        F.count("*").alias("check_count")
    )


def failed(report: DataFrame) -> DataFrame:
    return report.filter("status = 'fail'")


def raise_on_failures(checks: DataFrame, what: str, *, show: int = 100) -> None:
    """Raise with the number of rows whose status is 'fail' and the first of their texts."""
    bad = checks.filter("status = 'fail'")
    found = bad.agg(F.count("*")).first()[0]
    if found:
        first = [r.text for r in bad.orderBy("text").limit(show).collect()]
        more = f"; {found - len(first)} more not listed" if found > len(first) else ""
        raise QualityError(f"{what}: {found} checks failed: {'; '.join(first)}{more}")


def enforce(report: DataFrame, *, show: int = 100) -> None:
    """Raise when any check failed; a report holds a few rows per column.

    Call after the report has been written, so that a failing run leaves it.
    """
    text = F.concat_ws("=", "check_name", F.col("check_value").cast("string"))
    raise_on_failures(report.select("status", text.alias("text")), "quality gate", show=show)
