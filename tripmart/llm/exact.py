"""Exact duplicates by progressive refinement: length, then prefix, then the full text.

Written with DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, spare

PREFIX_CHARS = 128


def refine(docs: DataFrame, text: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows no other row can equal, rows that share length and prefix with another).

    The first two passes read lengths and prefixes and shuffle narrow rows, one per
    key and task, as the counts are partly made before the exchange.  The table of
    shared prefixes is written to the shared folder, so its size is known: Spark
    broadcasts it if small, and else shuffles both sides, splitting what a hot key
    makes too large.  Both results stand on the same exchange of whole rows.
    """
    size, prefix = names
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.withColumns(
        {
            size: F.octet_length(body),
            prefix: F.xxhash64(ascii_lower(F.substring(body, 1, PREFIX_CHARS))),
        }
    )
    more = F.count("*") > 1
    sizes = keyed.groupBy(size).agg(more.alias("more")).filter("more").drop("more")
    shared = (
        keyed.select(size, prefix)
        .groupBy(size, prefix)
        .agg(more.alias("more"))
        .filter("more")
        .drop("more")
        .join(sizes, size, "left_semi")
    )
    shared = materialize(shared, "shared-prefixes")
    return keyed.join(shared, [size, prefix], "left_anti"), keyed.join(
        shared, [size, prefix], "left_semi"
    )


def digest(text: str):
    """Hexadecimal SHA-256 of the text in lower case (A-Z only); null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("binary"), 256)


def group_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with keep_id (largest key of the equal texts), group_size and kept.

    Texts are equal when they are identical after lower-casing A-Z.  Only rows that
    share length and prefix with another are hashed in full.  Null texts are empty
    texts; a null key never stays if its group has another; rows that repeat a key
    as well as the text are the same row delivered twice and share its fate.
    Columns named like the results are replaced.
    """
    docs = docs.drop("keep_id", "group_size", "kept")
    size, prefix, full = spare(docs, "size", "prefix", "full")
    single, shared = refine(docs, text, [size, prefix])
    id_ = F.col(f"`{key}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = single.select(
        *columns, id_.alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    hashed = shared.withColumn(full, digest(text))
    groups = hashed.groupBy(full).agg(
        F.max(id_).alias("keep_id"), F.count("*").alias("group_size")
    )
    # Keyed by the raw digest, both sides have an exchange of their own: AQE can split a hot text.
    (raw,) = spare(hashed, "raw")
    groups = groups.withColumn(raw, F.unhex(full)).drop(full)
    shared = hashed.join(groups, F.unhex(full) == F.col(raw)).select(
        *columns, "keep_id", "group_size", id_.eqNullSafe(F.col("keep_id")).alias("kept")
    )
    return single.unionByName(shared)


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, that with the largest key.

    The ranking is limited to one row per text and task before its exchange, so a
    text that a third of all rows share costs one row per task.  Of rows that
    repeat the key too, any one stays: they differ in other columns at most.
    """
    size, prefix, full = spare(docs, "size", "prefix", "full")
    single, shared = refine(docs, text, [size, prefix])
    place = spare(docs, "place")[0]
    order = Window.partitionBy(full).orderBy(F.col(f"`{key}`").desc_nulls_last())
    first = (
        shared.withColumn(full, digest(text))
        .withColumn(place, F.row_number().over(order))
        .filter(F.col(place) == 1)
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*columns).unionByName(first.select(*columns))
