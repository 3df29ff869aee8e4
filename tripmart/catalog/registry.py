"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..session import wall_clock
from .shapes import CTES

Builder = Callable[[SparkSession, str], DataFrame]


class Entry(NamedTuple):
    build: Builder
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` may use the common table expressions of ``shapes``.

    Zoned timestamps in results become local wall-clock ones, like in the SQL.
    """

    def register(build: Builder) -> Builder:
        if name in ENTRIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wall_clock(build(spark, sf_dir))

        ENTRIES[name] = Entry(run, f"{CTES}\n{sql.strip()}" if sql else None)
        return build

    return register


def _load() -> None:
    from . import (  # noqa: F401
        dashboard,
        gold,
        models,
        quality,
        roundtrips,
        silver,
        streaming,
        volume,
    )


def queries() -> dict[str, Builder]:
    _load()
    return {name: entry.build for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql}
