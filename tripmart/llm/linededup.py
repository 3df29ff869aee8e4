"""Removal of repeated passages by overlapping windows of three lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, let, spare

WINDOW = 3


def window_hashes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per window: key, text hash, position, and 128 bits of its lines."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def windows(lines):
        def at(i):
            three = [F.element_at(lines, i + k) for k in range(1, WINDOW + 1)]
            return F.struct(
                F.xxhash64(*three).alias("h1"),
                F.xxhash64(F.lit(1), *three[::-1]).alias("h2"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), at)

    enough = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"))) >= WINDOW - 1
    return (
        docs.filter(enough)
        .select(
            F.col(f"`{key}`").alias("id"),
            F.xxhash64(body).alias("text_hash"),
            F.posexplode(let(F.split(body, "\n", -1), windows)).alias("position", "w"),
        )
        .select("id", "text_hash", "position", "w.h1", "w.h2")
    )


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later occurrences of three-line windows, with n_lines and n_removed.

    A window is three consecutive ``\\n``-split lines, compared as they are.  Of all
    its occurrences in the table, the first by (key, position) stays; every line
    that lies in a later occurrence is removed, overlapping occurrences together.
    Texts of fewer lines keep all, null texts stay null with no lines, a null key
    comes first, and rows that repeat a key as well as the text count as one.
    Columns named like the results are replaced.

    Windows are compared by 128 hash bits.  Counting them is partly done before the
    exchange, so a window found everywhere costs one row per task; finding the
    later occurrences joins windows to the repeated ones only, where AQE splits a
    hot window.  Texts are shuffled once, to meet their own removed positions.
    """
    (occurrences,) = spare(docs, "occurrences")
    windows = window_hashes(docs, key, text)
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "position")).alias("first"))
        .filter("n > 1")
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(
        ~F.struct("id", "position").eqNullSafe(F.col("first"))
    )
    marks = (
        later.groupBy("id", "text_hash")
        .agg(F.collect_set("position").alias(occurrences))
        .withColumnsRenamed({"id": "id_", "text_hash": "text_hash_"})
    )
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = docs.join(
        marks,
        F.col(f"`{key}`").eqNullSafe(F.col("id_")) & (F.xxhash64(body) == F.col("text_hash_")),
        "left",
    ).select(*[docs[f"`{c}`"] for c in docs.columns], occurrences)

    def make():
        def cut(text_: str | None, starts: list[int] | None) -> tuple:
            if text_ is None:
                return None, 0, 0
            lines = text_.split("\n")
            if not starts:
                return text_, len(lines), 0
            covered = np.zeros(len(lines), bool)
            for k in range(WINDOW):
                covered[np.asarray(starts) + k] = True
            kept = [line for line, gone in zip(lines, covered.tolist(), strict=True) if not gone]
            return "\n".join(kept), len(lines), len(lines) - len(kept)

        def columns(texts: pa.Array, starts: pa.Array) -> list[pa.Array]:
            made = [cut(t.as_py(), s.as_py()) for t, s in zip(texts, starts, strict=True)]
            kept, total, removed = zip(*made, strict=True) if made else ((), (), ())
            return [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())]

        return columns

    fields = [
        T.StructField(text, T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_removed", T.LongType()),
    ]
    return append_columns(marked, fields, [text, occurrences], make).drop(occurrences)
