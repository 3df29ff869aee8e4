"""Token-id shards with a minimal perfect hash index from document keys to offsets.

A shard is one row of a table written by Spark:

    part, seq      place of the shard in key order
    n_docs         documents in it
    first, last    its smallest and largest key, null where none has a key
    n_ids          ids in it
    payload        ids of all its documents, little-endian unsigned 16 bit, in key order
    keys           keys of its documents in order, little-endian signed 64 bit
    nulls          how many documents before those have no key
    ends           per document, null keys first, the id after its last one (64 bit)
    bits           bit arrays of the index, level after level (64-bit words)
    levels         words per level
    slots          per hash value: fingerprint (32 bit), first document, documents (64 bit each)

A key's documents may lie in several shards one after the other; each of them has its share
under the key.  The index places each key by the first level in which its bit is hit by no other
key of the shard; the number of set bits before that one is its hash value, so n
distinct keys have the values 0 to n-1.  A lookup reads the shards whose bounds
hold the key, and in one of them a bit per level tried, a slot and the payload at that
slot's offsets.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SLICE_ROWS, by_position, numbered_words

DOCS_PER_PART = 2048
MAX_PARTS = 1 << 14
SHARD_IDS = 1 << 21
# Bits per key and level; twice the keys leaves about 40 % of them to the next level.
LOAD = 2
# Words kept per Python worker and generation, the longest one kept, and bytes encoded at once.
CACHE_WORDS = 1 << 18
CACHE_BYTES = 64
GROUP_BYTES = 1 << 21
# Fixed value: a word of these letters is what the tokenizer's normalisation and splitting
# leave as it is.
PLAIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# Ids are stored as 16-bit integers.
MAX_ID = (1 << 16) - 1

SHARD_SCHEMA = (
    "part int, seq int, n_docs long, n_ids long, first long, last long, payload binary, "
    "keys binary, nulls long, "
    "ends binary, bits binary, levels array<int>, slots binary"
)
_SLOT = np.dtype([("fingerprint", "<u4"), ("first", "<i8"), ("count", "<i8")])


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits per key and seed (the finaliser of splitmix64)."""
    x = keys.astype("<i8").view("<u8") + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, bits: np.ndarray, levels: list[int]):
        self.bits, self.levels = bits, levels
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rest, parts, levels = keys, [], []
        while len(rest):
            words = -(-LOAD * len(rest) // 64)
            at = (mix(rest, len(levels)) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=words * 64) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(words)
            rest = rest[~alone[at]]
        return cls(np.concatenate(parts) if parts else np.zeros(0, "<u8"), levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Hash values; -1 for keys whose bit is set in no level."""
        found = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, words in enumerate(self.levels):
            at = mix(keys[open_], level) % np.uint64(words * 64)
            word = base + (at >> np.uint64(6)).astype(np.int64)
            shift = at & np.uint64(63)
            hit = (self.bits[word] >> shift) & np.uint64(1) == 1
            lower = self.bits[word] & ((np.uint64(1) << shift) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(lower)
            found[open_[hit]] = rank[hit]
            open_, base = open_[~hit], base + words
        return found


class WordEncoder:
    """Packed ids of texts from the tokenizers library, with a bounded cache of words.

    The tokenizer drops white space and lower-cases, never joins across white space,
    and splits where a letter or digit meets a sign.  So a text's ids are those of its
    words; a group of texts is numbered by its distinct words, and only words new to the
    cache are encoded.
    """

    def __init__(self, path: str):
        # Spark has a task per core; the library needs no threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.to_symbols = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if (largest := max(self.tokenizer.get_vocab().values())) > MAX_ID:
            raise ValueError(f"ids up to {largest} do not fit the shards' 16 bits")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text; the words that are new to the cache are encoded together."""
        number, counts, distinct = numbered_words(texts)
        words = distinct.to_pylist()
        coded = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(coded) if ids is None]
        if missing:
            self._learn([words[i] for i in missing])
            for i in missing:
                coded[i] = self.young[words[i]]
            if len(self.young) > CACHE_WORDS:
                kept = {w: x for w, x in self.young.items() if len(w) <= CACHE_BYTES}
                self.young, self.old = {}, kept
        flat, ends = by_position(coded, number, "<u2")
        packed = flat.tobytes()
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [packed[2 * a : 2 * b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _learn(self, words: list[bytes]) -> None:
        merge, new = self.tokenizer.model.tokenize, []
        for word in words:
            seen = self.old.get(word)
            if seen is not None:
                self.young[word] = seen
                continue
            text = word.decode()
            if not PLAIN_WORD.fullmatch(text):
                new.append(word)
                continue
            tokens = merge(text if text.isascii() else self.to_symbols(text)[0][0])
            self.young[word] = struct.pack(f"<{len(tokens)}H", *[t.id for t in tokens])
        coded = self.tokenizer.encode_batch_fast(
            [w.decode() for w in new], add_special_tokens=False
        )
        for word, encoding in zip(new, coded, strict=True):
            ids = encoding.ids
            self.young[word] = struct.pack(f"<{len(ids)}H", *ids)


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack_shard(part: int, seq: int, keys: list, ids: list[bytes]) -> dict:
    """One row of the shard table from documents in key order, null keys first."""
    nulls = sum(k is None for k in keys)
    named = np.array(keys[nulls:], "<i8")
    distinct, first, count = np.unique(named, return_index=True, return_counts=True)
    index = PerfectHash.build(distinct)
    slots = np.zeros(len(distinct), _SLOT)
    at = index(distinct)
    slots["fingerprint"][at] = fingerprints(distinct)
    slots["first"][at], slots["count"][at] = first + nulls, count
    ends = np.cumsum([len(x) // 2 for x in ids]).astype("<i8")
    return {
        "part": part, "seq": seq, "n_docs": len(keys), "n_ids": int(ends[-1]),
        "first": int(distinct[0]) if len(distinct) else None,
        "last": int(distinct[-1]) if len(distinct) else None,
        "payload": b"".join(ids), "keys": named.tobytes(), "nulls": nulls,
        "ends": ends.tobytes(), "bits": index.bits.tobytes(), "levels": index.levels,
        "slots": slots.tobytes(),
    }


class Shard:
    """Keyed access to one shard row."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], "<u2")
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.nulls = row["nulls"]
        self.index = PerfectHash(np.frombuffer(row["bits"], "<u8"), list(row["levels"]))
        self.slots = np.frombuffer(row["slots"], _SLOT)

    def document(self, number: int) -> tuple[int, np.ndarray]:
        start = int(self.ends[number - 1]) if number else 0
        return start, self.ids[start : int(self.ends[number])]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, first document, documents) per key; a foreign key's fingerprint differs."""
        if not len(self.slots):
            return np.zeros(len(keys), bool), *(np.zeros(len(keys), np.int64),) * 2
        at = self.index(keys)
        slot = self.slots[np.maximum(at, 0)]
        found = (at >= 0) & (slot["fingerprint"] == fingerprints(keys))
        return found, slot["first"], slot["count"]


def dealt_to(keys: pa.Array, ids: list[bytes], edges: np.ndarray, null_parts: int) -> np.ndarray:
    """Part of each row: by the bounds that its key has reached, null keys below all others.

    Bounds that are equal leave parts to that key alone; its rows are spread over these and
    the next part, where they come first.
    """
    values = keys.fill_null(0).to_numpy()
    reached = np.searchsorted(edges, values, "right")
    spread = reached - np.searchsorted(edges, values, "left")
    if keys.null_count:
        missing = keys.is_null().to_numpy(zero_copy_only=False)
        reached[missing], spread[missing] = -1, null_parts
    for i in np.flatnonzero(spread > 1).tolist():
        reached[i] -= zlib.crc32(ids[i]) % int(spread[i])
    return reached


def write_index(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode whole texts and write them as shards in ascending key order.

    Bounds that split the keys into parts of about 2048 documents come from the key
    column alone, so texts are read and encoded once and moved once, packed, to
    their part.  A key that several bounds fall on, and rows without a key, are dealt over
    parts of their own by a hash of their ids.  A part is sorted by key and cut into shards
    of about two million ids while it streams by; a longer document is a shard of its own.
    Null texts have the end id only, null keys come first, rows that repeat a key follow
    one another, in an order of no meaning.  Ids beyond 16 bits are refused.
    """
    if end_id > MAX_ID:
        raise ValueError(f"id {end_id} does not fit the shards' 16 bits")
    id_ = F.col(f"`{key}`").cast("long")
    rows, nulls = docs.agg(F.count(id_), F.count_if(id_.isNull())).first()
    parts = min(MAX_PARTS, -(-rows // DOCS_PER_PART))
    null_parts = min(MAX_PARTS, -(-nulls // DOCS_PER_PART))
    bounds: list[int] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        bounds = sorted(docs.agg(F.percentile_approx(id_, shares, max(10_000, 4 * parts))).first()[0])
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, edges = word_encoder(tokenizer).encode, np.array(bounds, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                keys, texts = batch.slice(start, SLICE_ROWS).columns
                ids, group, held = [], [], 0
                for value in texts.cast(pa.binary()):
                    group.append(value.as_py() or b"")
                    held += len(group[-1])
                    if held >= GROUP_BYTES:
                        ids += run(group)
                        group, held = [], 0
                ids = [x + end for x in (*ids, *run(group))]
                part = dealt_to(keys, ids, edges, null_parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), keys, pa.array(ids, pa.binary())],
                    names=["part", "key", "ids"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
            ("n_ids", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
            ("payload", pa.binary()), ("keys", pa.binary()),
            ("nulls", pa.int64()), ("ends", pa.binary()), ("bits", pa.binary()),
            ("levels", pa.list_(pa.int32())), ("slots", pa.binary()),
        ])
        part, seq, keys, ids, held = None, 0, [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([pack_shard(part, seq, keys, ids)], schema)

        for batch in batches:
            for at, k, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and (at != part or held + len(x) // 2 > SHARD_IDS):
                    yield shard()
                    seq = seq + 1 if at == part else 0
                    keys, ids, held = [], [], 0
                part = at
                keys.append(k)
                ids.append(x)
                held += len(x) // 2
        if keys:
            yield shard()

    body = F.col(f"`{text}`").cast("string")
    encoded = docs.select(id_.alias("key"), body.alias("text")).mapInArrow(
        encode, "part int, key long, ids binary"
    )
    dealt = encoded.repartition("part").sortWithinPartitions(
        "part", F.col("key").asc_nulls_first(), F.octet_length("ids"), "ids"
    )
    # A row group per shard, so that readers skip shards by their bounds.
    writer = dealt.mapInArrow(cut, SHARD_SCHEMA).write
    writer.option("parquet.block.row.count.limit", 1).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards through their index.

    Columns: part and seq of the shard, key, start of its ids in the shard, ids
    (unsigned 32 bit).  ``with_starts`` makes the start global.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                distinct = np.unique(shard.keys)
                found, first, count = shard.find(distinct)
                assert found.all(), "a key is missing from its own index"
                numbers = [*range(shard.nulls)]
                keys: list = [None] * shard.nulls
                for k, a, n in zip(distinct.tolist(), first.tolist(), count.tolist(), strict=True):
                    numbers.extend(range(a, a + n))
                    keys.extend([k] * n)
                docs = [shard.document(i) for i in numbers]
                size = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * size, pa.int32()),
                        pa.array([row["seq"]] * size, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array([s for s, _ in docs], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for _, x in docs], pa.binary()),
                    ],
                    names=["part", "seq", "key", "local", "ids"],
                )

    return shards.mapInArrow(rows, "part int, seq int, key long, start long, ids binary")


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of ``read_index`` with ``start`` counted over all shards before.

    Shuffles the rows where the table of shards is too large to broadcast, so
    leave payloads out before.
    """
    sizes = rows.sparkSession.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = sizes.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = Window.unboundedPreceding, -1
    # One row per part, of which there are at most MAX_PARTS.
    along = Window.orderBy("part").rowsBetween(*earlier)
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(*earlier)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(along), F.lit(0)).alias("before"))
    bases = (
        sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
        .join(F.broadcast(parts), "part")
        .select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))
    )
    moved = rows.join(bases, ["part", "seq"])
    return moved.withColumn("start", F.col("start") + F.col("base")).drop("base")


def hit_shards(shards: DataFrame, keys: list[int]) -> DataFrame:
    """The shards whose bounds hold one of the keys.

    Bounds come first, without payloads; the shards they name are then read alone.
    """
    distinct = sorted(set(keys))
    wanted = F.array(*[F.lit(k).cast("long") for k in distinct])
    inside = F.exists(wanted, lambda k: (F.col("first") <= k) & (k <= F.col("last")))
    # A key is in few shards, so that no more rows than keys and their shards come back.
    hits = shards.select("part", "seq", "first", "last").filter(inside).select("part", "seq")
    hits = [tuple(r) for r in hits.collect()]
    if not hits:
        return shards.filter("false")
    place = F.lit(False)
    for part in sorted({p for p, _ in hits}):
        place |= (F.col("part") == part) & F.col("seq").isin([s for p, s in hits if p == part])
    return shards.filter(place)


def find_documents(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Ids of a short list of keys; shards answer by fingerprint and verify the key."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    wanted = np.array(sorted(set(keys)), np.int64)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                found, first, count = shard.find(wanted)
                out: list[tuple[int, bytes]] = []
                for k, a, n in zip(wanted[found], first[found], count[found], strict=True):
                    if shard.keys[a - shard.nulls] == k:
                        out += [(int(k), shard.document(i)[1].tobytes()) for i in range(a, a + n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())],
                    names=["key", "ids"],
                )

    return hit_shards(shards, keys).mapInArrow(look, "key long, ids binary")
