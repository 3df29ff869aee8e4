"""Batch scans: parquet, CSV dimension, JDBC, JSON reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
    ]
)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_tagged_union(
    spark: SparkSession, paths: Mapping[str, str], tag: str = "taxi_type_from_path"
) -> DataFrame:
    """Read several datasets, tag each with its name, union by column name."""
    tagged = [read_table(spark, path).withColumn(tag, F.lit(name)) for name, path in paths.items()]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    return union


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because its path does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset, or None when the path does not exist; damaged data raises."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def path_status(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per dataset: is it there?  No data is read."""
    rows = [
        (name, path, "available" if try_read(spark, path) is not None else "missing")
        for name, path in paths.items()
    ]
    return spark.createDataFrame(rows, "dataset_name string, dataset_path string, status string")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension from a CSV with a header.

    The header is compared with the schema, so a file in another layout (for
    example one without coordinates) fails instead of shifting columns.
    """
    raw = (
        spark.read.schema(ZONE_FILE_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return raw.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Scan a database table, or push a whole query (for example an aggregate) down.

    A table scan can be split by ranges of ``partition_column``; without that
    JDBC reads through a single connection.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table) if table else reader.option("query", query)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        if not (table and bounds and num_partitions):
            raise ValueError("a partitioned scan needs table, bounds and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", num_partitions)
        )
    return reader.load()


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a quality report written by ``write_report``."""
    return spark.read.json(path)


def read_metrics(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Saved model metrics as (model, metric, value); missing files add no rows."""
    result = spark.createDataFrame([], "model string, metric string, value double")
    for model, path in paths.items():
        try:
            doc = spark.read.option("multiLine", True).json(path)
        except AnalysisException as error:
            if is_missing(error):
                continue
            raise
        numeric = [f.name for f in doc.schema.fields if isinstance(f.dataType, T.NumericType)]
        if not numeric:
            continue
        entries = [
            F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value"))
            for n in numeric
        ]
        result = result.unionByName(
            doc.select(F.lit(model).alias("model"), F.inline(F.array(*entries)))
        )
    return result


def sample(sources: Mapping[str, DataFrame], rows: int, tag: str = "taxi_type") -> DataFrame:
    """First ``rows`` rows of every source, tagged and kept in memory for repeated looks."""
    parts = [df.limit(rows).withColumn(tag, F.lit(name)) for name, df in sources.items()]
    union = parts[0]
    for other in parts[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    return union.cache()


def collect_small(df: DataFrame, max_rows: int = 1000) -> list[Row]:
    """Rows of a small result; raises when there are more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it first")
    return rows
