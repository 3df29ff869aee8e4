"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import spare

POWER = 0.5
# A rate beyond this is the sum of several smaller ones, as exp(-rate) would reach zero.
RATE_STEP = 200.0
HASH_BITS = 48


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) fixed by the seed and the parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")
    return bits / F.lit(float(1 << HASH_BITS))


def rates(
    docs: DataFrame,
    source: str = "source",
    weights: Mapping[str, float] | None = None,
    power: float = POWER,
    total: int | None = None,
) -> DataFrame:
    """Per source: rows, target share, mean repetitions and the steps of its inverse.

    A source's weight is the one given, or else its row count to ``power`` (0.5
    draws sources together, 1 leaves them as they are); weights are scaled to
    shares.  ``total`` is the row count aimed at, that of the input by default.
    A null source is a source of its own.
    """
    (name,) = spare(docs, "mix_source")
    counts = docs.groupBy(F.col(f"`{source}`").alias(name)).agg(F.count("*").alias("rows_in"))
    weight = F.pow(F.col("rows_in").cast("double"), F.lit(float(power)))
    if weights is not None:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(F.try_element_at(given, F.col(name)).cast("double"), weight)
    counts = counts.withColumn("weight", weight)
    weights_all = counts.agg(F.sum("weight")).scalar()
    aim = counts.agg(F.sum("rows_in")).scalar() if total is None else F.lit(int(total))
    rate = F.col("share") * aim / F.col("rows_in")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_STEP)).cast("int")
    # P(count <= k) of one part, up to where the rest is below the hash's resolution.
    lam = F.col("rate") / F.col("parts")
    last = F.ceil(lam + 12 * F.sqrt(lam) + 40).cast("int")
    steps = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-lam).alias("p"), F.array(F.exp(-lam)).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * lam / k).alias("p"),
            F.array_append(acc["cdf"], F.element_at(acc["cdf"], -1) + acc["p"] * lam / k).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return (
        counts.withColumn("share", F.col("weight") / weights_all)
        .withColumn("rate", rate)
        .withColumn("parts", parts)
        .withColumn("steps", steps)
        .select(name, "rows_in", "share", "rate", "parts", "steps")
    )


def replicate(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    weights: Mapping[str, float] | None = None,
    power: float = POWER,
    total: int | None = None,
    seed: int = 7,
    copy: str | None = "copy",
    order: str | None = "mix_key",
) -> DataFrame:
    """Each document as often as a Poisson draw with its source's rate says, shuffled.

    The draw inverts the distribution at a number hashed from the seed and the key,
    so a rerun or a recomputed task gives the same rows.  ``copy`` (0, 1, ...) and
    ``order`` (the hashed position) name result columns, replacing columns of these
    names; None leaves them out.  Rows are dealt to partitions by that hash and
    sorted by it, which shuffles all rows in one exchange.

    The table of sources is written to the shared folder first, so Spark knows its
    size: a small one is broadcast and no text moves before the final shuffle; for
    a large one the join is shuffled, and AQE splits a hot source.  An empty table gives an empty
    table, a null key is a key like others, and rows that repeat a key get the same
    count.
    """
    docs = docs.drop(*[c for c in (copy, order) if c])
    number, place = spare(docs, "copy_number", "place")
    per_source = rates(docs, source, weights, power, total)
    name = per_source.columns[0]
    per_source = per_source.select(name, "parts", "steps")
    parts, steps = spare(docs, "mix_parts", "mix_steps")
    per_source = materialize(
        per_source.withColumnsRenamed({"parts": parts, "steps": steps}), "mix-rates"
    )
    id_ = F.col(f"`{key}`")

    def drawn(part: Column) -> Column:
        u = uniform(seed, id_, part)
        return F.size(F.filter(F.col(steps), lambda c: c <= u))

    single = drawn(F.lit(0))
    count = F.when(F.col(parts) == 1, single).otherwise(
        F.aggregate(
            F.transform(F.sequence(F.lit(0), F.col(parts) - 1), drawn),
            F.lit(0),
            lambda a, b: a + b,
        )
    )
    mixed = (
        docs.join(per_source, F.col(f"`{source}`").eqNullSafe(F.col(name)))
        .withColumn(number, count)
        .filter(F.col(number) > 0)
        .withColumn(number, F.explode(F.sequence(F.lit(0), F.col(number) - 1)))
        .withColumn(
            place,
            F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"),
                              F.coalesce(id_.cast("string"), F.lit("")), F.col(number))),
        )
    )
    shuffled = mixed.repartition(F.col(place)).sortWithinPartitions(place)
    extra = [F.col(n).alias(to) for n, to in ((number, copy), (place, order)) if to]
    return shuffled.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)
