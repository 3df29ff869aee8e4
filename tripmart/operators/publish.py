"""Staged publication with an audit log.

Tables are published as immutable versions: a version is written to its own
directory, compared with its source, and becomes visible by one append to the
run log.  Because the log append is a single committed file, several tables
switch together, and a reader never sees an empty or half-written table.
"""

from __future__ import annotations

import secrets
import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import read_jdbc
from ..sources.readers import is_missing
from ..sources.writers import write_jdbc
from .profile import unpivot_row
from .quality import QualityError, raise_on_failures, reconcile

RUN_LOG_SCHEMA = (
    "publish_run_id bigint, target_table string, source_dataset string, version_path string, "
    "source_row_count bigint, target_row_count bigint, status string, details string, "
    "recorded_at timestamp"
)
RESULT_SCHEMA = (
    "publish_run_id bigint, check_name string, expected_value string, actual_value string, "
    "status string, checked_at timestamp"
)
PENDING_NOTE = "Readers see this version; its figures are still to be compared."
SUPERSEDED_NOTE = "A later publication took its place while it was still open."
CLOSED_NOTES = {
    "passed": "Validated against the source dataset.",
    "failed": "Some figures of the published version differ from the source.",
}


# --- Publication metrics --------------------------------------------------


def _range(column: str) -> dict[str, Column]:
    return {f"min_{column}": F.min(column), f"max_{column}": F.max(column)}


def _metric_columns(kind: str, measure: str) -> dict[str, Column]:
    rows = {"row_count": F.count("*")}
    if kind == "demand":
        return {
            **rows,
            "total_demand": F.sum("demand"),
            "pickup_year_month_count": F.count_distinct("pickup_year_month"),
            **_range("pickup_hour"),
            **_range("gold_processed_timestamp"),
        }
    if kind == "fare_tip":
        return {
            **rows,
            "total_fare_amount": F.sum("fare_amount"),
            "total_tip_amount": F.sum("tip_amount"),
            "credit_card_payment_rows": F.count_if(F.col("payment_type") == 1),
            "pickup_year_month_count": F.count_distinct("pickup_year_month"),
            **_range("gold_processed_timestamp"),
        }
    if kind == "mart":
        return {
            **rows,
            f"total_{measure}": F.sum(measure),
            **_range("source_gold_processed_timestamp"),
            **_range("dashboard_processed_timestamp"),
        }
    raise ValueError(f"unknown metric kind {kind!r}")


def metrics(df: DataFrame, kind: str, measure: str = "total_demand") -> DataFrame:
    """Publication metrics in long form (check_name, check_value), one aggregation."""
    columns = _metric_columns(kind, measure)
    wide = df.agg(*[c.alias(n) for n, c in columns.items()])
    return unpivot_row(
        wide,
        [
            {"check_name": F.lit(n), "check_value": F.col(n).cast("string")}
            for n in columns
        ],
    )


_SQL_AGGREGATES = {
    "demand": {
        "row_count": "COUNT(*)",
        "total_demand": "SUM(demand)",
        "pickup_year_month_count": "COUNT(DISTINCT pickup_year_month)",
        "min_pickup_hour": "MIN(pickup_hour)",
        "max_pickup_hour": "MAX(pickup_hour)",
        "min_gold_processed_timestamp": "MIN(gold_processed_timestamp)",
        "max_gold_processed_timestamp": "MAX(gold_processed_timestamp)",
    },
    "fare_tip": {
        "row_count": "COUNT(*)",
        "total_fare_amount": "CAST(SUM(fare_amount) AS NUMERIC(38, 2))",
        "total_tip_amount": "CAST(SUM(tip_amount) AS NUMERIC(38, 2))",
        "credit_card_payment_rows": "SUM(CASE WHEN payment_type = 1 THEN 1 ELSE 0 END)",
        "pickup_year_month_count": "COUNT(DISTINCT pickup_year_month)",
        "min_gold_processed_timestamp": "MIN(gold_processed_timestamp)",
        "max_gold_processed_timestamp": "MAX(gold_processed_timestamp)",
    },
    "mart": {
        "row_count": "COUNT(*)",
        "total_{measure}": "SUM({measure})",
        "min_source_gold_processed_timestamp": "MIN(source_gold_processed_timestamp)",
        "max_source_gold_processed_timestamp": "MAX(source_gold_processed_timestamp)",
        "min_dashboard_processed_timestamp": "MIN(dashboard_processed_timestamp)",
        "max_dashboard_processed_timestamp": "MAX(dashboard_processed_timestamp)",
    },
}


def metrics_query(table: str, kind: str, measure: str = "total_demand") -> str:
    """The same metrics as one SQL aggregate, for a database to compute."""
    columns = ", ".join(
        f"{sql} AS {name}" for name, sql in _SQL_AGGREGATES[kind].items()
    ).replace("{measure}", measure)
    return f"SELECT {columns} FROM {table}"


def jdbc_metrics(
    spark: SparkSession,
    url: str,
    table: str,
    kind: str,
    *,
    measure: str = "total_demand",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Publication metrics of a database table; only one row leaves the database."""
    wide = read_jdbc(
        spark, url, query=metrics_query(table, kind, measure), properties=properties
    )
    return unpivot_row(
        wide,
        [
            {"check_name": F.lit(c.lower()), "check_value": F.col(c).cast("string")}
            for c in wide.columns
        ],
    )


def stage_jdbc(
    source: DataFrame,
    url: str,
    table: str,
    kind: str,
    *,
    measure: str = "total_demand",
    writers: int = 4,
    reuse: bool = False,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Load a database staging table and prove that it equals its stored source.

    ``reuse`` skips the load after an interrupted run and only compares again.
    """
    if not reuse:
        write_jdbc(source, url, table, writers=writers, properties=properties)
    loaded = jdbc_metrics(
        source.sparkSession, url, table, kind, measure=measure, properties=properties
    )
    compared = reconcile(metrics(source, kind, measure), loaded)
    _raise_on_mismatch(compared, f"staging of {table}")


# --- Run log ----------------------------------------------------------------


class Warehouse:
    """Versioned tables and their logs under one shared root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/_{name}")
        except AnalysisException as error:
            if is_missing(error):
                return self.spark.createDataFrame([], schema)
            raise

    def _append(self, name: str, df: DataFrame) -> None:
        # One output file: its rename by the commit protocol is the switch.
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/_{name}")

    def run_log(self) -> DataFrame:
        """Every recorded state change of every run."""
        return self._log("publish_run_history", RUN_LOG_SCHEMA)

    def results(self) -> DataFrame:
        return self._log("validation_results", RESULT_SCHEMA)

    def runs(self) -> DataFrame:
        """Current state of every run: the last recorded state wins.

        A run is opened as ``started`` and closed at most once.
        """
        latest = F.struct("recorded_at", F.col("status") != "started")
        return self.run_log().groupBy("publish_run_id", "target_table").agg(
            F.max("source_dataset").alias("source_dataset"),
            F.max("version_path").alias("version_path"),
            F.max("source_row_count").alias("source_row_count"),
            F.max("target_row_count").alias("target_row_count"),
            F.max_by("status", latest).alias("status"),
            F.max_by("details", latest).alias("details"),
            F.min("recorded_at").alias("started_at"),
            F.max(F.when(F.col("status") != "started", F.col("recorded_at"))).alias(
                "completed_at"
            ),
        )

    def pending_run(self, table: str) -> int:
        """Id of the latest run of a table that is not closed yet."""
        rows = (
            self.runs()
            .filter((F.col("target_table") == table) & (F.col("status") == "started"))
            .orderBy(F.desc("publish_run_id"))
            .limit(1)
            .collect()
        )
        if not rows:
            raise LookupError(f"no pending publish run for {table}")
        return rows[0].publish_run_id

    def current_path(self, table: str) -> str:
        """Directory of the version readers see: the latest one promoted."""
        rows = (
            self.run_log()
            .filter((F.col("target_table") == table) & (F.col("status") == "started"))
            .orderBy(F.desc("publish_run_id"))
            .limit(1)
            .collect()
        )
        if not rows:
            raise LookupError(f"{table} was never published")
        return rows[0].version_path

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.current_path(table))

    # --- Cycle ---------------------------------------------------------------

    def stage(
        self,
        table: str,
        source: DataFrame,
        kind: str,
        *,
        measure: str = "total_demand",
        reuse: str | None = None,
    ) -> str:
        """Write a new version and prove that it equals its source; returns its path.

        ``source`` must be a stored dataset: a plan with ``current_timestamp``
        would give other values when it is evaluated for the comparison.
        ``reuse`` names a version left by an interrupted run, which is then only
        compared again.
        """
        path = reuse or f"{self.root}/{table}/v-{uuid.uuid4().hex}"
        if reuse is None:
            source.write.parquet(path)
        written = self.spark.read.parquet(path)
        compared = reconcile(metrics(source, kind, measure), metrics(written, kind, measure))
        _raise_on_mismatch(compared, f"staging of {table}")
        return path

    def promote(
        self, versions: Mapping[str, str], sources: Mapping[str, str]
    ) -> dict[str, int]:
        """Make staged versions visible, all in one step; returns run ids by table.

        Runs of the same tables that are still open are closed as superseded in
        the same append.  A root has a single publisher: the log is read, then
        appended to.  Should two have met all the same, the open runs found after
        the append show it, and the later one raises.
        """
        # Microseconds and 10 random bits: later runs have larger ids, two never the same.
        first_id = (time.time_ns() // 1000 << 10) + secrets.randbits(10)
        run_ids = {table: first_id + i for i, table in enumerate(versions)}
        opened = None
        for table, path in versions.items():
            row = self.spark.read.parquet(path).agg(F.count("*").alias("n")).select(
                F.lit(run_ids[table]).cast("bigint").alias("publish_run_id"),
                F.lit(table).alias("target_table"),
                F.lit(sources[table]).alias("source_dataset"),
                F.lit(path).alias("version_path"),
                F.col("n").alias("source_row_count"),
                F.col("n").alias("target_row_count"),
                F.lit("started").alias("status"),
                F.lit(PENDING_NOTE).alias("details"),
                F.current_timestamp().alias("recorded_at"),
            )
            opened = row if opened is None else opened.unionByName(row)
        stale = self.runs().filter(
            (F.col("status") == "started") & F.col("target_table").isin(list(versions))
        )
        self._append("publish_run_history", opened.unionByName(self._closing(
            stale, "failed", SUPERSEDED_NOTE
        )))
        others = (
            self.runs()
            .filter(F.col("target_table").isin(list(versions)) & (F.col("status") == "started"))
            .filter(~F.col("publish_run_id").isin(list(run_ids.values())))
        )
        if not others.isEmpty():
            raise RuntimeError(f"another publisher is at work on {sorted(versions)}")
        return run_ids

    def _closing(self, runs: DataFrame, status: str, details: str) -> DataFrame:
        return runs.select(
            "publish_run_id", "target_table", "source_dataset", "version_path",
            "source_row_count", "target_row_count",
            F.lit(status).alias("status"),
            F.lit(details).alias("details"),
            F.current_timestamp().alias("recorded_at"),
        )

    def validate(
        self, table: str, source: DataFrame, kind: str, *, measure: str = "total_demand"
    ) -> DataFrame:
        """Compare the visible version with the source and record one row per check.

        Closes the pending run as passed or failed; raises when a check failed.
        """
        run_id = self.pending_run(table)
        compared = reconcile(
            metrics(source, kind, measure), metrics(self.read(table), kind, measure)
        )
        recorded = compared.select(
            F.lit(run_id).cast("bigint").alias("publish_run_id"),
            "check_name", "expected_value", "actual_value", "status",
            F.current_timestamp().alias("checked_at"),
        )
        self._append("validation_results", recorded)
        results = self.results().filter(F.col("publish_run_id") == run_id)
        try:
            _raise_on_mismatch(results, f"validation of {table}")
        except QualityError:
            self.close_run(table, run_id, "failed")
            raise
        self.close_run(table, run_id, "passed")
        return results

    def close_run(self, table: str, run_id: int, status: str) -> None:
        open_run = self.runs().filter(
            (F.col("publish_run_id") == run_id) & (F.col("target_table") == table)
        )
        self._append(
            "publish_run_history", self._closing(open_run, status, CLOSED_NOTES[status])
        )


def _raise_on_mismatch(compared: DataFrame, what: str) -> None:
    described = F.format_string(
        "%s: expected %s, found %s", "check_name", "expected_value", "actual_value"
    )
    raise_on_failures(compared.select("status", described.alias("text")), what)
