"""Profiles that add up: one small sketch row per day, merged when they are read.

A day's envelopes are profiled once, when the day is complete.  A profile of any span of
days then reads one row per topic and day instead of the payloads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K

# Size parameters.  A quantile's rank is off by at most RANK_ERROR, and a number of distinct
# keys by three times KEY_ERROR of it, each in more than 99 % of all cases.
KLL_K, RANK_ERROR = 400, 0.012
HLL_LOG_K, KEY_ERROR = 12, 0.0163


def daily_sketches(
    bronze: DataFrame,
    *,
    by: Sequence[str] = ("topic",),
    day: str = "ingestion_date",
    body: str = "json_data",
) -> DataFrame:
    """Rows, sizes, and sketches of payload lengths and log records per group and day.

    Lengths go to a quantile sketch, the transport keys to a distinct-count sketch; both
    are built in each task first, so that a hot day is one row per task in the exchange.
    """
    size = F.length(body).cast("long")
    record = F.xxhash64(*[F.col(c) for c in K.TRANSPORT_KEY])
    return bronze.groupBy(*by, day).agg(
        F.count("*").alias("event_rows"),
        F.count_if(F.col(body).isNull()).alias("missing_payloads"),
        F.coalesce(F.sum(size), F.lit(0)).alias("payload_chars"),
        F.min(size).alias("min_payload_chars"),
        F.max(size).alias("max_payload_chars"),
        F.kll_sketch_agg_bigint(size, F.lit(KLL_K)).alias("lengths"),
        F.hll_sketch_agg(record, F.lit(HLL_LOG_K)).alias("records"),
    )


def merged_profile(
    sketches: DataFrame,
    *,
    by: Sequence[str] = ("topic",),
    quantiles: Sequence[float] = (0.5, 0.95),
) -> DataFrame:
    """The profile of all days in ``sketches``; sums and extremes are exact."""
    merged = sketches.groupBy(*by).agg(
        F.sum("event_rows").alias("event_rows"),
        F.sum("missing_payloads").alias("missing_payloads"),
        F.sum("payload_chars").alias("payload_chars"),
        F.min("min_payload_chars").alias("min_payload_chars"),
        F.max("max_payload_chars").alias("max_payload_chars"),
        F.kll_merge_agg_bigint("lengths").alias("_lengths"),
        F.hll_union_agg("records").alias("_records"),
    )
    # A sketch without lengths has no quantiles.
    known = F.col("event_rows") > F.col("missing_payloads")
    return merged.select(
        *by,
        "event_rows",
        "missing_payloads",
        "payload_chars",
        "min_payload_chars",
        "max_payload_chars",
        F.hll_sketch_estimate("_records").alias("distinct_records"),
        *[
            F.when(known, F.kll_sketch_get_quantile_bigint("_lengths", F.lit(float(q))))
            .alias(f"p{round(100 * q)}_payload_chars")
            for q in quantiles
        ],
    )
