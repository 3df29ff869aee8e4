"""Resampling towards a target: importance weights per document and a distributed draw.

Texts become counts of hashed word runs.  How much more frequent each bucket is in the
target than in the corpus is one number in an array; a document's weight is the mean of its
features' numbers, and a Gumbel draw hashed from its key turns weights into a sample without
replacement: the k largest scores.  The k-th largest is found by quickselect over the
cluster, so that only the winners are sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, let

# Fixed value: what stands between words, all of ASCII but digits and a-z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Random keys that each round of the selection counts against.
PIVOTS = 32


def words(text: Column) -> Column:
    """The words of a whole text, A-Z lower-cased; none for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD, -1)
    return F.filter(parts, lambda w: w != "")


def features(words: Column, runs: int) -> Column:
    """All runs of one to ``runs`` consecutive words, joined by a blank."""
    if runs == 1:
        return words

    def of_length(n: int, w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - n + 1)
        joined = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(words, lambda w: F.concat(*[of_length(n, w) for n in range(1, runs + 1)]))


def buckets(found: Column, size: int) -> Column:
    return F.transform(found, lambda f: (F.crc32(f.cast("binary")) % size).cast("int"))


def bucket_counts(texts: DataFrame, text: str, runs: int, size: int) -> list[int]:
    """Features per bucket; counted in each task first, and ``size`` rows come back."""
    found = texts.select(F.explode(buckets(features(words(F.col(f"`{text}`")), runs), size)).alias("bucket"))
    counts = [0] * size
    for bucket, n in found.groupBy("bucket").agg(F.count("*")).collect():
        counts[bucket] = n
    return counts


def gains(target: list[int], corpus: list[int]) -> list[int]:
    """Per bucket 1000 times the log ratio of smoothed shares, rounded down."""
    size = len(corpus)
    aim, have = float(sum(target) + size), float(sum(corpus) + size)
    return [
        math.floor(1000 * math.log((t + 1) * have / ((s + 1) * aim)))
        for t, s in zip(target, corpus, strict=True)
    ]


def scored(
    docs: DataFrame, key: str, text: str, per_bucket: list[int], runs: int, seed: int
) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    # One constant array: the optimizer folds the text that spells it.
    table = F.split(F.lit(",".join(map(str, per_bucket))), ",").cast("array<long>")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), words(F.col(f"`{text}`")).alias("words"))
    rows = rows.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        buckets(features(F.col("words"), runs), len(per_bucket)).alias("found"),
    )
    total = F.aggregate("found", F.lit(0).cast("long"), lambda so_far, b: so_far + F.get(table, b))
    n_features = F.size("found").cast("long")
    rows = rows.select("id", "n_words", n_features.alias("n_features"), total.alias("total"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    # ``div`` rounds towards zero, so what is left over goes first.
    weight = F.expr("(total - pmod(total, greatest(n_features, 1L))) div greatest(n_features, 1L)")
    return rows.withColumn("weight", weight).select(
        "id", "n_words", "n_features", "weight", (F.col("weight") + gumbel).alias("score")
    )


# Largest score first, then smallest key, rows without a key last; the other columns only
# tell rows apart that repeat a key.
ORDER = ("place", "nameless", "name", "n_features", "weight")


def _sort_key() -> Column:
    """One comparable value: smaller means drawn earlier."""
    return F.struct(
        (-F.col("score")).alias("place"),
        F.col("id").isNull().alias("nameless"),
        F.coalesce("id", F.lit(0).cast("long")).alias("name"),
        "n_features",
        "weight",
    )


def _spelled(key) -> Column:
    """A key brought back from the cluster as a constant."""
    types = ("long", "boolean", "long", "long", "long")
    return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(key, types, ORDER, strict=True)])


def kth_key(keys: DataFrame, k: int, seed: int, pivots: int = PIVOTS):
    """(key, rows before it) of the k-th row (1 is the first) of ``keys`` (key, copies).

    Each round draws random keys from those still possible, counts exactly how many rows lie
    before, at and after each, and keeps what lies between the two around the k-th row: about
    one key in ``pivots``.  Nothing but the pivots and their counts leaves the cluster.
    """
    low = high = None
    before, turn = 0, 0
    while True:
        possible = keys
        if low is not None:
            possible = possible.filter(F.col("key") > _spelled(low))
        if high is not None:
            possible = possible.filter(F.col("key") < _spelled(high))
        turn += 1
        drawn = possible.orderBy(F.xxhash64(F.lit(seed + turn), "key"), "key").limit(pivots)
        at = sorted(tuple(r.key) for r in drawn.select("key").collect())
        marks = F.array(*[_spelled(p) for p in at])
        behind = F.size(F.filter(marks, lambda m: m < F.col("key")))
        same = F.exists(marks, lambda m: m == F.col("key"))
        parts = possible.groupBy(behind.alias("behind"), same.alias("same")).agg(F.sum("copies"))
        counts = {(r[0], r[1]): r[2] for r in parts.collect()}
        for i, pivot in enumerate(at):
            reached = before + counts.get((i, False), 0)
            if k <= reached:
                high = pivot
                break
            if k <= reached + counts[i, True]:
                return pivot, reached
            low, before = pivot, reached + counts[i, True]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``first``, the rank of the first of the rows each stands for.

    A range sort deals them in order over partitions of like size, which are written; ranks
    run on inside each partition, from what all earlier ones hold.
    """
    sorted_ = winners.orderBy("key").select("*", F.spark_partition_id().alias("part"))
    sorted_ = materialize(sorted_, "winners")
    held = sorted_.groupBy("part").agg(F.sum("copies").alias("held"))
    # One row per partition of the sort.
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("part", F.coalesce(F.sum("held").over(along), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sorted_.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(F.broadcast(held), "part")
        .withColumn("first", F.col("earlier") + F.col("inside") + 1)
        .drop("part", "inside", "earlier")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    *,
    runs: int = 1,
    size: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every row's key, n_features, weight, score, and rank among the rows drawn (else null).

    ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down: those
    of the highest scores, ties to the smaller key.  Weights come from all texts of ``docs``
    and ``target``, whole, whether drawn or not.

    Null and empty texts have no features and weight 0.  Rows without a key hash as an empty
    key and lose ties.  Rows that repeat a key count each: with other texts they have scores
    of their own, and rows alike in all result columns are counted and ranked one after the
    other.  An empty target gives every bucket the smoothed gain of none; an empty table
    gives no rows.  Extra columns are ignored.
    """
    per_bucket = gains(
        bucket_counts(target, target_text, runs, size), bucket_counts(docs, text, runs, size)
    )
    rows = scored(docs, key, text, per_bucket, runs, seed)
    enough = (F.col("n_words") >= min_words).alias("enough")
    alike = rows.groupBy(enough, _sort_key().alias("key")).agg(F.count("*").alias("copies"))
    alike = materialize(alike, "scores")
    able = alike.filter("enough").select("key", "copies")
    drawn = (able.agg(F.sum("copies")).first()[0] or 0) * percent // 100

    def result(some: DataFrame, rank: Column) -> DataFrame:
        """One row for each of the rows that a key stands for."""
        copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
        id_ = F.when(~F.col("key.nameless"), F.col("key.name"))
        return some.select("*", copy.alias("copy")).select(
            id_.alias(key),
            F.col("key.n_features").alias("n_features"),
            F.col("key.weight").alias("weight"),
            (-F.col("key.place")).alias("score"),
            rank.alias("rank"),
        )

    none = F.lit(None).cast("long")
    if not drawn:
        return result(alike, none)
    last, _ = kth_key(able, drawn, seed)
    wins = F.col("enough") & (F.col("key") <= _spelled(last))
    rank = F.col("first") + F.col("copy") - 1
    # The last winner may stand for more rows than are still to be drawn.
    won = result(ranked(alike.filter(wins)), F.when(rank <= drawn, rank))
    return won.union(result(alike.filter(~wins), none))
