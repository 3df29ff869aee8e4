"""Sharding along a Hilbert curve through quantised metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spare, utf8_size

BITS = 4
# Cells of the curve that rows of one cell are dealt to by hash, so that no cell is sorted alone.
SUBCELLS = 4096
# Bytes of text that a file of a shard holds, about.
FILE_BYTES = 1 << 27


def curve_index(point: tuple[int, ...], bits: int) -> int:
    """Position of a point on the Hilbert curve through a grid of 2**bits cells per side.

    Walks from the coarsest bit down.  At each level the orthant entered is looked
    up in the frame of that sub-cube (its entry corner and direction), and the
    frame of the sub-cube after it is derived, as in Hamilton's compact Hilbert
    indices.
    """
    n = len(point)
    mask = (1 << n) - 1

    def rotate(value: int, by: int) -> int:
        by %= n
        return ((value << by) | (value >> (n - by))) & mask if by else value

    entry, direction, index = 0, 0, 0
    for level in range(bits - 1, -1, -1):
        orthant = sum(((x >> level) & 1) << axis for axis, x in enumerate(point))
        gray = rotate(orthant ^ entry, n - (direction + 1))
        rank, rest = gray, gray >> 1
        while rest:
            rank ^= rest
            rest >>= 1
        index = index << n | rank
        start = 0 if rank == 0 else 2 * ((rank - 1) // 2)
        corner = start ^ (start >> 1)
        trailing = rank if rank & 1 else max(0, rank - 1)
        axis = 0
        while trailing & 1:
            trailing >>= 1
            axis += 1
        axis = 0 if rank == 0 else axis % n
        entry ^= rotate(corner, direction + 1)
        direction = (direction + axis + 1) % n
    return index


def size_level(size: Column) -> Column:
    """Binary logarithm of a size, whole steps, in 16 levels."""
    return F.least(F.lit((1 << BITS) - 1), F.length(F.bin(size)) - 1).cast("int")


def name_level(name: Column) -> Column:
    """16 levels of a name by hash: equal names share a level, null is its own hash."""
    hashed = F.crc32(F.coalesce(name, F.lit("")).cast("binary"))
    return (hashed % (1 << BITS)).cast("int")


def assign_shards(
    docs: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    names: tuple[str, str] = ("source", "lang"),
) -> DataFrame:
    """Shard and slot of every document; shard row counts differ by one at most.

    Two names and the text size give a point in a grid of 16 x 16 x 16 cells; rows
    are ranked by the cell's place on the curve and the ranks cut into equal runs,
    so a shard covers few values of each dimension and readers can skip shards on
    any of them.  Within a cell, rows are ordered by the hash of their key, then key.

    The rank is the number of rows in earlier cells, plus those in earlier hash
    subcells of the same cell, plus the place in the subcell.  A cell with a third
    of all rows is thus ranked in 4096 parts, and only key, size and hashes are
    shuffled.  Null texts have 8 bytes, null names are a value of their own, rows
    that are equal in every column are interchangeable; extra columns are ignored.
    """
    id_ = F.col(f"`{key}`")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = utf8_size(body) + 8
    first, second = (F.col(f"`{n}`").cast("string") for n in names)
    # Rows without a key are told apart by their texts.
    spread = F.when(id_.isNull(), F.xxhash64(body)).otherwise(F.xxhash64(id_))
    rows = docs.select(
        id_.alias("key"),
        size.alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        name_level(first).alias("x"),
        name_level(second).alias("y"),
        size_level(size).alias("z"),
        F.pmod(spread, F.lit(SUBCELLS)).cast("int").alias("subcell"),
    )
    side = range(1 << BITS)
    curve = docs.sparkSession.createDataFrame(
        [(x, y, z, curve_index((x, y, z), BITS)) for x in side for y in side for z in side],
        "x int, y int, z int, cell int",
    )
    # 4096 rows by construction.
    rows = rows.join(F.broadcast(curve), ["x", "y", "z"]).drop("x", "y", "z")

    counts = rows.groupBy("cell", "subcell").agg(F.count("*").alias("n"))
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("cell").orderBy("subcell").rowsBetween(*earlier)
    # One row per cell of the curve.
    along = Window.orderBy("cell").rowsBetween(*earlier)
    cells = counts.groupBy("cell").agg(F.sum("n").alias("cell_rows"))
    cells = cells.select(
        "cell",
        F.coalesce(F.sum("cell_rows").over(along), F.lit(0)).alias("cell_start"),
        F.sum("cell_rows").over(Window.partitionBy()).alias("total"),
    )
    starts = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(cells), "cell")
        .select("cell", "subcell", (F.col("cell_start") + F.col("before")).alias("start"), "total")
    )
    place = Window.partitionBy("cell", "subcell").orderBy("key", "text_crc32", "size")
    ranked = (
        rows.withColumn("place", F.row_number().over(place))
        .join(starts, ["cell", "subcell"])
        .withColumn("rank", F.col("start") + F.col("place") - 1)
        .withColumn("shard", F.expr(f"rank * {shards} div total").cast("int"))
        # The first rank of shard s is the smallest r with r * shards >= s * total.
        .withColumn("first", F.expr(f"(shard * total + {shards} - 1) div {shards}"))
    )
    return ranked.select(
        F.col("key").alias(key), "size", "text_crc32", "cell", "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
    )


def write_shards(
    docs: DataFrame,
    assigned: DataFrame,
    path: str,
    key: str = "doc_id",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write ``docs`` as one folder per shard, rows in slot order.

    A shard is as many files as its share of the texts' bytes takes: rows are dealt by
    ranges of (shard, slot), so that no task writes much more than ``file_bytes``, and the
    files' names are in slot order.  Keys must be unique; one row may have none.
    """
    shard, slot, own = spare(docs, "shard", "slot", "key")
    placed = assigned.select(
        F.col(f"`{key}`").alias(own), F.col("shard").alias(shard), F.col("slot").alias(slot)
    )
    total, shards = assigned.agg(F.sum("size"), F.countDistinct("shard")).first()
    ranges = max(1, shards, -(-(total or 0) // file_bytes))
    rows = docs.join(placed, F.col(f"`{key}`").eqNullSafe(F.col(own))).drop(own)
    dealt = rows.repartitionByRange(ranges, shard, slot).sortWithinPartitions(shard, slot)
    dealt.write.partitionBy(shard).parquet(path)
