"""Zone distances and polygon centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DISTANCE_METHOD
from ..functions import haversine_miles
from .joins import join_zones

NO_AREA = 1e-12


def route_estimates(
    requests: DataFrame, zones: DataFrame, *, proven_rows: int | None = None
) -> DataFrame:
    """Centroid distance for each requested pair of zones.

    ``requests`` has pu_location_id and do_location_id; other columns are kept.
    An unusable pair gets a ``route_error`` and no distance.
    """
    # The match marker tells an unknown zone from one without attributes.
    known = zones.withColumn("borough", F.struct("borough"))
    ends = join_zones(requests, known, proven_rows=proven_rows)
    points = ["pickup_zone_lat", "pickup_zone_lon", "dropoff_zone_lat", "dropoff_zone_lon"]
    missing_point = F.lit(False)
    for name in points:
        missing_point = missing_point | F.col(name).isNull()
    error = (
        F.when(F.col("pickup_zone_borough").isNull(), F.lit("unknown pickup zone"))
        .when(F.col("dropoff_zone_borough").isNull(), F.lit("unknown dropoff zone"))
        .when(missing_point, F.lit("missing centroid coordinates"))
    )
    miles = haversine_miles(*[F.col(name) for name in points])
    same = F.col("pu_location_id") == F.col("do_location_id")
    return ends.select(
        *requests.columns,
        F.col("pickup_zone_name"),
        F.col("dropoff_zone_name"),
        F.round(miles, 3).alias("trip_distance"),
        F.lit(DISTANCE_METHOD).alias("distance_method"),
        same.alias("same_zone"),
        F.coalesce(~same & (miles > 0), F.lit(False)).alias("can_predict"),
        error.alias("route_error"),
    )


def polygon_centroids(vertices: DataFrame) -> DataFrame:
    """Area-weighted centroid per polygon from (polygon_id, ring_id, seq, x, y).

    Rings are numbered vertex lists (``seq`` counts 0, 1, 2, ...), closed or not;
    holes wind the other way and subtract.  Edges come from joining each vertex
    with its successor, so even one enormous ring spreads over all tasks.  Rings
    without area add nothing; a polygon without area gets a null centroid and
    ``has_area`` false.
    """
    ring = ["polygon_id", "ring_id"]
    here = vertices.select(*ring, "seq", "x", "y")
    there = here.select(
        *ring, (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    steps = here.join(there, [*ring, "seq"], "left")
    start = here.filter("seq = 0").select(
        *ring, F.col("x").alias("x0"), F.col("y").alias("y0")
    )
    # The last vertex of a ring has no successor and closes to the first one;
    # on a ring given closed that edge has no length and contributes zero.
    inner = steps.filter(F.col("x2").isNotNull())
    last = (
        steps.filter(F.col("x2").isNull())
        .drop("x2", "y2")
        .join(start, ring)
        .withColumnsRenamed({"x0": "x2", "y0": "y2"})
    )
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    edges = inner.unionByName(last).select(
        *ring,
        cross.alias("cross"),
        ((F.col("x") + F.col("x2")) * cross).alias("mx"),
        ((F.col("y") + F.col("y2")) * cross).alias("my"),
    )
    rings = (
        edges.groupBy(*ring)
        .agg(
            F.sum("cross").alias("cross"),
            F.sum("mx").alias("mx"),
            F.sum("my").alias("my"),
            F.count("*").alias("points"),
        )
        .filter((F.col("points") >= 3) & (F.abs("cross") >= NO_AREA))
    )
    # Twice the area times six is the usual centroid denominator, and twice-area
    # weights cancel in the final ratio.
    solid = rings.groupBy("polygon_id").agg(
        F.sum("cross").alias("cross"), F.sum("mx").alias("mx"), F.sum("my").alias("my")
    )
    # |twice area| below 2e-12 is |area| below 1e-12.
    solid = solid.filter(F.abs("cross") >= 2 * NO_AREA)
    return (
        here.select("polygon_id")
        .distinct()
        .join(solid, "polygon_id", "left")
        .select(
            "polygon_id",
            (F.col("mx") / (F.col("cross") * 3)).alias("centroid_x"),
            (F.col("my") / (F.col("cross") * 3)).alias("centroid_y"),
            F.col("cross").isNotNull().alias("has_area"),
        )
    )
