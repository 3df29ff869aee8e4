"""Near duplicates by SuperMinHash signatures, banding, exact checks and union-find.

A SuperMinHash signature gives every element of a set a random permutation of the
slots; the element's rank j in it offers the value j + r (0 <= r < 1) to the j-th
slot of that permutation.  Ranks are worked off level by level for all elements
of a batch at once.  A value of level j is below every value of a later level, so a
document is finished as soon as each of its slots holds one: long documents after
one or two levels.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import append_columns

WORDS = 5
PERCENT = 75
BANDS, ROWS = 48, 6
SLOTS = BANDS * ROWS
# Holders of a shingle, or partners of a leader, that meet in one task; hot leaders at most.
SALTED, HOT = 1 << 10, 10_000
# Pairs of two components' sets and hubs that are verified before the rest.
FIRST = 8
# Elements whose permutations are in memory together, and words kept per Python worker.
CHUNK = 1 << 14
CACHE_WORDS = 1 << 16

_EMPTY = np.uint64((1 << 64) - 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-mixed 64 bits (the finaliser of splitmix64)."""
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Unrelated odd factors, so that words that change places do not cancel out.
_ODD = mix(np.arange(64, dtype=np.uint64), 99) | np.uint64(1)


class Words(dict):
    """64-bit hashes of words, with a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        hashed = self[word] = xxhash.xxh3_64_intdigest(word)
        return hashed


def shingles(text: bytes, words: Words) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at \\x20 and
    \\x09-\\x0D, which are the definitions wanted.  A text of fewer words than a
    shingle is one shingle as a whole; one without words has none.
    """
    parts = text.lower().split()
    n = len(parts)
    hashed = np.fromiter(map(words.__getitem__, parts), np.uint64, n)
    if n < WORDS:
        return mix((hashed * _ODD[:n]).sum(keepdims=True), 1 + n) if n else hashed
    combined = hashed[: n - WORDS + 1] * _ODD[0]
    for i in range(1, WORDS):
        combined += hashed[i : n - WORDS + 1 + i] * _ODD[i]
    return np.unique(mix(combined))


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of slots per set, all of them non-empty."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), slots), np.uint64)
    # Sets of like size together: they take like numbers of levels.
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        fits = np.searchsorted(np.cumsum(sizes[order[start:]]), CHUNK, "right")
        chunk = order[start : start + max(1, int(fits))]
        out[chunk] = _signatures([sets[i] for i in chunk], slots)
        start += len(chunk)
    return out


def _signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    found = np.full(len(sets) * slots, _EMPTY)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    low = np.uint64(32)
    permuted: np.ndarray | None = None
    for level in range(slots):
        random = mix(elements, 2 * level + 2)
        other = level + ((random >> low) * np.uint64(slots - level) >> low).astype(np.int64)
        if level == 0:
            slot = other
        else:
            rows = np.arange(len(elements))
            slot = permuted[rows, other]
            permuted[rows, other] = permuted[:, level]
            permuted[:, level] = slot
        value = np.uint64(level << 48) | (mix(random, 1) >> np.uint64(16))
        np.minimum.at(found, owner * slots + slot, value)
        open_ = (found.reshape(len(sets), slots) == _EMPTY).any(axis=1)
        if not open_.any():
            break
        left = open_[owner]
        if level == 0:
            first = other[left]
            permuted = np.tile(np.arange(slots, dtype=np.int16), (len(first), 1))
            permuted[np.arange(len(first)), first] = 0
            permuted[:, 0] = first
        elif not left.all():
            permuted = permuted[left]
        elements, owner = elements[left], owner[left]
    return found.reshape(len(sets), slots)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One hash per band of each signature, different bands never equal by chance of rows."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    return mix((parts * _ODD[:ROWS]).sum(axis=2, dtype=np.uint64) + mix(np.arange(BANDS, dtype=np.uint64)))


def _sets_of(texts: pa.Array, words: Words) -> list[np.ndarray]:
    return [
        shingles(t.as_buffer().to_pybytes(), words) if t.is_valid else np.zeros(0, np.uint64)
        for t in texts.cast(pa.binary())
    ]


def sketch(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_shingles, a 128-bit digest of the set, and the band hashes."""

    def make() -> Callable[..., list[pa.Array]]:
        words = Words()

        def columns(texts: pa.Array) -> list[pa.Array]:
            sets = _sets_of(texts, words)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands = np.zeros((len(full), BANDS), np.int64)
            if full:
                bands = band_hashes(signatures([sets[i] for i in full])).view(np.int64)
            ends = np.zeros(len(sets) + 1, np.int32)
            ends[np.array(full, np.int64) + 1] = BANDS
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(
                    [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    pa.binary(),
                ),
                pa.ListArray.from_arrays(np.cumsum(ends, dtype=np.int32), bands.ravel()),
            ]

        return columns

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
    return append_columns(docs, fields, [text], make).drop(text)


def shingle_sets(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the full shingle set of each text in place of the text."""

    def make() -> Callable[..., list[pa.Array]]:
        words = Words()

        def columns(texts: pa.Array) -> list[pa.Array]:
            sets = [s.view(np.int64) for s in _sets_of(texts, words)]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            return [pa.ListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, np.int64)]))]

        return columns

    return append_columns(
        docs, [T.StructField("shingles", T.ArrayType(T.LongType()))], [text], make
    ).drop(text)


def verify(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (leader, id) whose full shingle sets are similar enough; pairs are distinct.

    Only texts that a pair names are turned into sets.  The joins are shuffled at
    every size: how many pairs there are follows the data, and no bound is known.  A
    leader of many pairs gets a copy of its set for every SALTED of them.
    """
    named = pairs.select(F.col("id")).union(pairs.select("leader")).distinct()
    sets = materialize(shingle_sets(texts.join(named.hint("merge"), "id", "left_semi"), "text"), "shingle-sets")
    counts = pairs.groupBy("leader").agg(F.count("*").alias("n"))
    least = F.greatest(F.lit(SALTED), F.lit(pairs.count() // HOT))
    # At most HOT leaders have more than a HOT-th of all pairs.
    hot = F.broadcast(counts.filter(F.col("n") > least).withColumn("salts", F.ceil(F.col("n") / SALTED)))
    hot = hot.select("leader", F.col("salts").cast("long"))
    salts = F.coalesce("salts", F.lit(1).cast("long"))
    salted = pairs.join(hot, "leader", "left").select(
        "leader", "id", F.pmod(F.xxhash64("id"), salts).alias("salt")
    )
    leaders = sets.select(F.col("id").alias("leader"), F.col("shingles").alias("others"))
    leaders = leaders.join(hot, "leader", "left").select(
        "leader", "others", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    )
    both = F.size(F.array_intersect("shingles", "others"))
    union = F.size("shingles") + F.size("others") - both
    return (
        salted.join(sets.hint("merge"), "id")
        .join(leaders.hint("merge"), ["leader", "salt"])
        .filter(100 * both >= percent * union)
        .select("leader", "id")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with an edge (leader, id); the smallest id names it.

    Union-find over a cluster: alternating large-star and small-star steps hang
    nodes under the smallest neighbour until all components are stars.  Each step
    counts per node before its exchange and is written to the shared folder.
    """

    def all_stars(e: DataFrame) -> bool:
        """Whether every node hangs under one other, which hangs under none."""
        below = e.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        above = e.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above"))
        counts = below.union(above).groupBy("x").agg(
            F.sum("below").alias("below"), F.max("above").alias("above")
        )
        return counts.filter("below > 1 OR below + above > 1").isEmpty()

    def large_star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        return (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(least.select("u", F.col("m").alias("v"))).distinct()

    e = edges.select(F.greatest("leader", "id").alias("u"), F.least("leader", "id").alias("v"))
    e = materialize(e.filter("u <> v").distinct(), "edges")
    while not all_stars(e):
        e = materialize(small_star(large_star(e)), "edges")
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _in_mixed(met: DataFrame, linked: DataFrame) -> DataFrame:
    """Members (id, component, stray) of the buckets that hold several components.

    A bucket of two is left out, as its members were compared.  A stray is a member
    outside the largest component of one of its buckets.
    """
    named = met.filter("members > 2").select("bucket", "id").join(linked, "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    parts = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy("bucket")
        .agg(
            F.count("*").alias("parts"),
            F.max(F.struct("n", F.col("component").alias("largest"))).alias("most"),
        )
        .filter("parts > 1")
        .select("bucket", "most.largest")
    )
    stray = F.max(F.col("component") != F.col("largest")).alias("stray")
    return named.join(mixed, "bucket").groupBy("id", "component").agg(stray)


def _prefixes(open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The shingles by which the sets of ``open_`` (id, component) may meet similar ones.

    The shingles of a set are ranked by how many open sets hold them, those of a single
    component first.  A pair's first common shingle must leave both sets enough others
    behind it, which is a prefix of each set and prunes sets that only share what many
    share.  Columns: unit (a number per set), id, n (its size), larger (shingles to share
    with a set no smaller), shingle, left (shingles from there on), salts (for its holders).
    """
    sets = shingle_sets(texts.join(open_.hint("merge"), "id"), "text")
    sets = materialize(
        sets.withColumn("n", F.size("shingles")).withColumn("unit", F.monotonically_increasing_id()),
        "open-sets",
    )
    words = sets.select("unit", "component", F.explode("shingles").alias("shingle"))
    shared = (
        words.groupBy("shingle")
        .agg(F.count("*").alias("holders"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo <> hi")
        .select("shingle", "holders")
    )
    ranked = (
        words.select("unit", "shingle")
        .join(shared, "shingle")
        .groupBy("unit")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "shingle"))).alias("ranked"))
    )
    # Shingles that a set must share with another of any size, and with one no smaller.
    least = F.expr(f"({percent} * n + 99) div 100")
    larger = F.expr(f"({2 * percent} * n + {99 + percent}) div {100 + percent}")
    before = F.col("n") - F.size("ranked")
    size = F.greatest(F.lit(0), F.col("n") - least + 1 - before).cast("int")
    return materialize(
        sets.drop("shingles")
        .join(ranked, "unit")
        .select(
            "unit", "id", "n", larger.alias("larger"), before.alias("before"),
            F.posexplode(F.slice("ranked", F.lit(1), size)).alias("k", "at"),
        )
        .select(
            "unit", "id", "n", "larger", "at.shingle",
            (F.col("n") - F.col("before") - F.col("k")).alias("left"),
            F.ceil(F.col("at.holders") / SALTED).cast("long").alias("salts"),
        ),
        "prefixes",
    )


def _meet(a: DataFrame, b: DataFrame, condition: str, percent: int) -> DataFrame:
    """Pairs of a row of ``a`` and one of ``b`` at one shingle that may be similar enough.

    Both have the columns of ``_prefixes``, component and stray.  Columns: leader, id,
    low and high (their components, in order).  At least one side is a stray, and the
    sides' components differ.
    """
    a = a.withColumn("salt", F.pmod(F.xxhash64("unit"), F.col("salts")))
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    enough = f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}"
    return (
        a.alias("a")
        .join(b.alias("b").hint("merge"), ["shingle", "salt"])
        .filter(
            "a.component <> b.component and (a.stray or b.stray)"
            f" and ({condition}) and least(a.left, b.left) >= {enough}"
        )
        .select(
            F.least("a.id", "b.id").alias("leader"),
            F.greatest("a.id", "b.id").alias("id"),
            F.least("a.component", "b.component").alias("low"),
            F.greatest("a.component", "b.component").alias("high"),
        )
    )


def _hub_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """The most promising pairs (leader, id) of two components, FIRST of them at most.

    The members of a shingle meet one set only for each range of sizes: the hub, which
    has most shingles left behind and so the least that is its own.  There are fewer
    pairs than rows in ``prefix``, where ``_candidates`` has the square of a group.
    """
    sizes = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))
    columns = F.struct(*[F.col(c) for c in prefix.columns if c != "shingle"])
    hubs = prefix.groupBy("shingle", sizes.alias("sizes")).agg(
        F.max_by(columns, F.struct("left", "unit")).alias("hub")
    )
    met = _meet(prefix, hubs.select("shingle", "hub.*"), "true", percent)
    pairs = met.groupBy("leader", "id", "low", "high").agg(F.count("*").alias("common"))
    order = Window.partitionBy("low", "high").orderBy(F.desc("common"), "leader", "id")
    return pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= FIRST)


def _candidates(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (leader, id) of sets that may be similar enough, none left out."""
    smaller = "a.n < b.n or (a.n = b.n and a.unit < b.unit)"
    a = prefix.filter("left >= larger")
    # Strays are few: only they meet all holders of a shingle.
    met = _meet(a.filter("stray"), prefix, smaller, percent).union(
        _meet(a.filter("not stray"), prefix.filter("stray"), smaller, percent)
    )
    return met.select("leader", "id").distinct()


def _finish(
    linked: DataFrame, met: DataFrame, tested: DataFrame, texts: DataFrame, percent: int
) -> DataFrame:
    """``linked`` with every link that members of one bucket of ``met`` still lack.

    Sets meet the hubs of their shingles first, as many pairs as that is rows.  It joins
    nearly all that belongs together, so that few sets of different components are left
    to be compared with each other, all candidates of them.
    """

    def untested(pairs: DataFrame, label: str) -> DataFrame:
        pairs = pairs.select("leader", "id").join(tested, ["leader", "id"], "left_anti")
        return materialize(pairs, label)

    open_ = materialize(_in_mixed(met, linked), "open-sets")
    if open_.isEmpty():
        return linked
    prefixes = _prefixes(open_, texts, percent)
    pairs = untested(_hub_pairs(prefixes.join(open_.hint("merge"), "id"), percent), "hub-pairs")
    if not pairs.isEmpty():
        linked = _joined(linked, materialize(verify(pairs, texts, percent), "links"))
        tested = tested.union(pairs)
        open_ = materialize(_in_mixed(met, linked), "open-sets")
    pairs = untested(_candidates(prefixes.join(open_.hint("merge"), "id"), percent), "candidates")
    if pairs.isEmpty():
        return linked
    return _joined(linked, materialize(verify(pairs, texts, percent), "links"))


def _joined(linked: DataFrame, links: DataFrame) -> DataFrame:
    """``linked`` with more links: known components are stars already, only what joins them is new."""
    if links.isEmpty():
        return linked
    stars = linked.select(F.col("component").alias("leader"), "id")
    return components(stars.union(links))


def _link(reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(id, component) of the representatives that are linked with another.

    Each member of a bucket is compared with the bucket's smallest id only, so a
    bucket makes fewer pairs than it has members.  Where its members then are in
    one component, nothing is left to find in it.  What the buckets then still hold
    in several components goes to an exact search.
    """
    buckets = reps.select("id", F.explode("bands").alias("bucket"))
    groups = buckets.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("leader"))
    met = materialize(buckets.join(groups.filter("members > 1"), "bucket"), "buckets")
    pairs = materialize(met.filter("id <> leader").select("leader", "id").distinct(), "pairs")
    linked = components(materialize(verify(pairs, texts, percent), "links"))
    return _finish(linked, met, pairs, texts, percent)


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per document: key, n_shingles, component_id, kept.

    Documents are linked when their sets of distinct five-word shingles have a
    Jaccard similarity of at least ``percent`` / 100, checked on the full sets; a
    component is named by its smallest key, whose document is kept.  Documents
    with equal sets are one class and take part once, so copies cost a partial
    aggregate.  Two sets at the threshold share a band with probability 0.9999.

    Texts without words, and null texts, have no shingles and are linked with
    nothing; so are rows without a key, which are kept and have no component.  Keys
    are expected to be unique: rows that repeat a key and a text get one result
    each, and classes that start with the same key count as linked.  Extra columns
    are ignored.
    """
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sketches = materialize(sketch(texts, "text"), "sketches")
    first = Window.partitionBy("digest").orderBy("id")
    reps = materialize(
        sketches.filter("digest is not null and id is not null")
        .withColumn("place", F.row_number().over(first))
        .filter("place = 1")
        .drop("place"),
        "classes",
    )
    linked = _link(reps, texts, percent)
    classes = reps.select("id", "digest").join(linked, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    named = sketches.select("id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest key.

    Rows that repeat the key of a kept document stay with it.
    """
    gone = near_groups(docs, key, text, percent).filter("not kept").select(F.col(f"`{key}`"))
    gone = materialize(gone.distinct(), "near-copies")
    return docs.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
