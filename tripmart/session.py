"""Session construction and shared-storage locations."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import LOCAL_TIME_ZONE


_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "tripmart", **conf: str) -> SparkSession:
    """A session with the settings the pipeline relies on.

    Master, memory and executor counts are left to the submit command.  Event
    times are local wall-clock strings, so the session zone is the local one;
    AQE coalesces shuffle partitions and splits skewed joins at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.session.timeZone": LOCAL_TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        # The JVM never JIT-compiles a method above 8000 bytecodes; a wide stage
        # fused into a larger one runs interpreted, several times slower.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Call-site capture costs several driver round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a session
    on one machine keeps such tables beside its warehouse until it ends; any other
    master is refused, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder for master {master}")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        warehouse = urlparse(spark.conf.get("spark.sql.warehouse.dir"))
        if warehouse.scheme not in ("", "file"):
            raise ValueError("spark.checkpoint.dir must name a folder where the warehouse is remote")
        _local_scratch[app] = os.path.join(warehouse.path, f"scratch-{app}")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared folder and read it back.

    Survives executor loss, and the re-read carries real file-size statistics
    so that the optimizer can pick the join strategy from measured sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wall_clock(df: DataFrame) -> DataFrame:
    """Replace zoned timestamps by zone-less ones showing the same local time."""
    zoned = {
        f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(zoned) if zoned else df
