"""BPE through a table of distinct words.

The tokenizer splits at white space, and between a word and signs, so a text's ids are
those of its words.  Spark splits the texts, some megabytes of them to a block; a block
becomes numbers that point into its own list of distinct words.  The words of all lists
are dealt by hash over parts of a distinct-word table; a part encodes each of its words
once and answers the blocks that asked, and a block joins ids with words by position.

A word takes part once a block, however often it occurs, and travels with the other words
that a block asks a part for, packed in one row.  So rows are no more than pairs of a word
and a block, and a word that every block asks for costs its part some bytes a block.

Blocks are cut twice, once for the questions and once for the positions: that costs less
than to store the positions.  A block is told by its place in the scan and a digest of its
texts; one that came out differently the second time would find no answer, and is an error.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import append_columns, by_position, numbered_words, spare

# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 22
# Bytes of text for each part of the table: some megabytes of distinct words.
PART_BYTES = 1 << 24
# Distinct words given to the tokenizer at once.
WORDS = 1 << 12

@lru_cache(maxsize=1)
def tokenizer(path: str):
    """The tokenizer of a file that every worker has installed."""
    # Spark has a task per core; the library needs no threads of its own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs (first, after the last) of texts of these sizes that make a block each."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
        yield start, stop
        start = stop


def _packed(values: np.ndarray, zstd: pa.Codec) -> bytes:
    """Non-negative integers by planes: all lowest bytes first, then the next; compressed."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    raw = np.ascontiguousarray(planes.T).tobytes()
    return len(raw).to_bytes(8, "little") + bytes([width]) + zstd.compress(raw, asbytes=True)


def _unpacked(packed: bytes, zstd: pa.Codec) -> np.ndarray:
    size, width = int.from_bytes(packed[:8], "little"), packed[8]
    raw = zstd.decompress(packed[9:], size, asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 4), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u4").ravel().astype(np.int64)


def _text(packed: bytes, zstd: pa.Codec) -> list[bytes]:
    """Words from a packed list; they have no blanks in them."""
    size = int.from_bytes(packed[:8], "little")
    return zstd.decompress(packed[8:], size, asbytes=True).split(b" ")


def _packed_text(words: list[bytes], zstd: pa.Codec) -> bytes:
    raw = b" ".join(words)
    return len(raw).to_bytes(8, "little") + zstd.compress(raw, asbytes=True)


class Source:
    """Texts to be cut into blocks, with the columns that go with them."""

    def __init__(self, docs: DataFrame, text: str):
        (counted,) = spare(docs, "n_words")
        self.carried = [c for c in docs.columns if c != text]
        docs = docs.select(
            *[F.col(f"`{c}`") for c in self.carried], F.col(f"`{text}`").cast("string").alias("__text")
        )
        # Rows that come out of an exchange may come in another order the second time.
        if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
            docs = materialize(docs, "texts")
        self.docs = docs
        self.rows = T.StructType([*docs.schema.fields[:-1], T.StructField(counted, T.LongType())])
        total = docs.agg(F.sum(F.octet_length("__text").cast("long"))).first()[0] or 0
        self.parts = -(-total // PART_BYTES) or 1

    def cut(self, make: Callable[..., Iterator[dict]], schema: T.StructType) -> DataFrame:
        """What ``make`` makes of every block, with the block's key.

        ``make`` is given the batch's other columns, the words' numbers by frequency, words
        per text and the words, and yields rows.
        """
        whole = T.StructType.fromDDL("block long, digest long").fields + schema.fields
        whole = T.StructType(whole)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 33
            for batch in batches:
                column = batch.column(batch.num_columns - 1).cast(pa.binary()).fill_null(b"")
                for start, stop in _blocks(pc.binary_length(column).to_numpy()):
                    texts = column.slice(start, stop - start).to_pylist()
                    found, counts, distinct = numbered_words(texts)
                    digest = xxhash.xxh3_64(counts.tobytes())
                    for text in texts:
                        digest.update(text)
                    key = digest.intdigest() - (1 << 63)
                    order = np.argsort(-np.bincount(found, minlength=len(distinct)), kind="stable")
                    rank = np.empty(len(order), np.int64)
                    rank[order] = np.arange(len(order))
                    others = [c.slice(start, stop - start) for c in batch.columns[:-1]]
                    for row in make(others, rank[found], counts, distinct.take(pa.array(order))):
                        size = len(next(iter(row.values())))
                        arrays = [pa.array([v] * size, pa.int64()) for v in (block, key)]
                        yield pa.RecordBatch.from_arrays([*arrays, *row.values()], names=whole.names)
                    block += 1

        return self.docs.mapInArrow(run, whole)


def positions(source: Source) -> DataFrame:
    """(block, digest, rows, numbers, distinct): blocks as numbers of their words.

    ``rows`` holds each row's other columns and its number of words.  Frequent words have
    small numbers.
    """
    names = source.rows.names

    def make(others, numbers, counts, words) -> Iterator[dict]:
        zstd = pa.Codec("zstd", compression_level=3)
        row = pa.StructArray.from_arrays([*others, pa.array(counts)], names=names)
        yield {
            "rows": pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row),
            "numbers": pa.array([_packed(numbers, zstd)], pa.binary()),
            "distinct": pa.array([len(words)], pa.int64()),
        }

    fields = T.StructType.fromDDL("numbers binary, distinct long").fields
    return source.cut(make, T.StructType([T.StructField("rows", T.ArrayType(source.rows)), *fields]))


def asked(source: Source) -> DataFrame:
    """(block, digest, part, numbers, words): what each block asks each part of the table for.

    Words go by their numbers, which are stored as the steps between them.
    """
    parts = source.parts

    def make(others, numbers, counts, words) -> Iterator[dict]:
        zstd = pa.Codec("zstd", compression_level=3)
        words = words.to_pylist()
        if not words:
            return
        part = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        part = (part % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        groups = np.split(order, first[1:])
        yield {
            "part": pa.array(used, pa.int64()),
            "numbers": pa.array([_packed(np.diff(g, prepend=0), zstd) for g in groups], pa.binary()),
            "words": pa.array([_packed_text([words[i] for i in g], zstd) for g in groups], pa.binary()),
        }

    return source.cut(make, T.StructType.fromDDL("part long, numbers binary, words binary"))


def _coded(lists: list[list[bytes]], path: str) -> tuple[list[np.ndarray], pa.Array, list[np.ndarray]]:
    """(per list the place of each word, distinct words, their ids), each word encoded once."""
    sizes = np.cumsum([0, *map(len, lists)])
    numbered = pa.array([w for words in lists for w in words], pa.binary()).dictionary_encode()
    place = numbered.indices.to_numpy()
    distinct = numbered.dictionary
    encode = tokenizer(path).encode_batch_fast
    ids: list[np.ndarray] = []
    for start in range(0, len(distinct), WORDS):
        words = [w.decode() for w in distinct.slice(start, WORDS).to_pylist()]
        ids += [np.array(c.ids, "<u4") for c in encode(words, add_special_tokens=False)]
    return [place[a:b] for a, b in zip(sizes[:-1], sizes[1:], strict=True)], distinct, ids


def word_table(questions: DataFrame, path: str) -> DataFrame:
    """(word, ids): the distinct words of all blocks with their ids."""

    def code(part: pa.Table) -> pa.Table:
        zstd = pa.Codec("zstd")
        _, distinct, ids = _coded([_text(w, zstd) for w in part["words"].to_pylist()], path)
        return pa.table({"word": distinct, "ids": pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))})

    return questions.groupBy("part").applyInArrow(code, "word binary, ids array<int>")


def answers(questions: DataFrame, path: str) -> DataFrame:
    """(block, digest, numbers, lengths, ids): ids of the words that a block asked a part for.

    A part's words, some megabytes, are in a task's memory together.
    """

    def code(part: pa.Table) -> pa.Table:
        zstd = pa.Codec("zstd", compression_level=3)
        places, _, ids = _coded([_text(w, zstd) for w in part["words"].to_pylist()], path)
        packed = [x.tobytes() for x in ids]
        lengths, given = [], []
        for place in places:
            flat, ends = by_position(packed, place)
            lengths.append(_packed(np.diff(ends, prepend=0), zstd))
            given.append(_packed(flat, zstd))
        return pa.table({
            "block": part["block"], "digest": part["digest"], "numbers": part["numbers"],
            "lengths": pa.array(lengths, pa.binary()), "ids": pa.array(given, pa.binary()),
        })

    return questions.groupBy("part").applyInArrow(
        code, "block long, digest long, numbers binary, lengths binary, ids binary"
    )


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    to: str = "token_ids",
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with the ids of each whole text as an array ``to``.

    With ``decoded``, a column of that name has the text that the ids stand for, as
    ``decode`` gives it.

    Ids are those of the tokenizers library for the file at ``path`` without added special
    tokens, truncation or padding; the strings of special tokens in a text count as those, as
    in the library.  The file's tokenizer must lower-case, drop white space and split between
    letters or digits and signs, as that of ``word_bpe_49k.json`` does.

    Null and empty texts have no ids; repeated rows are encoded each; columns besides the
    text stay, but for those named like the results; an empty table gives no rows.  A block's texts
    (some megabytes, or one longer text) are in a task's memory together.
    """
    results = {c.lower() for c in (to, decoded) if c}
    kept = [c for c in docs.columns if c == text or c.lower() not in results]
    source = Source(docs.select(*[F.col(f"`{c}`") for c in kept]), text)
    given = answers(asked(source), path)
    rows = source.rows
    schema = T.StructType([*rows.fields[:-1], T.StructField(to, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        zstd = pa.Codec("zstd")
        if not left.num_rows:
            raise ValueError("a block came out differently when it was cut again")
        row = left["rows"].combine_chunks().flatten()
        position = _unpacked(left["numbers"][0].as_py(), zstd)
        # What each part answered, put together in the order of the block's numbers.
        numbers, lengths, flat = (
            [_unpacked(x, zstd) for x in right[c].to_pylist()] for c in ("numbers", "lengths", "ids")
        )
        none = [np.zeros(0, np.int64)]
        number = np.concatenate(none + [np.cumsum(x) for x in numbers])
        length = np.concatenate(none + lengths)
        if len(number) != left["distinct"][0].as_py():
            raise ValueError("a block came out differently when it was cut again")
        start = np.cumsum(length) - length
        ids = np.concatenate(none + flat).astype("<u4")
        coded: list[bytes] = [b""] * len(number)
        for n, a, size in zip(number.tolist(), start.tolist(), length.tolist(), strict=True):
            coded[n] = ids[a : a + size].tobytes()
        found, ends = by_position(coded, position)
        counts = row.field(len(rows) - 1).to_numpy()
        # A text ends where its last word does.
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        lists = pa.ListArray.from_arrays(offsets.astype(np.int32), found.astype(np.int32))
        made = [lists, texts_of(lists, path)] if decoded else [lists]
        return pa.table([*[row.field(i) for i in range(len(rows) - 1)], *made], names=schema.names)

    key = ["block", "digest"]
    return positions(source).groupBy(*key).cogroup(given.groupBy(*key)).applyInArrow(place, schema)


@lru_cache(maxsize=1)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table in the order of ids, as long as the vocabulary."""
    found = tokenizer(path)
    if found.decoder is not None:
        raise ValueError(f"{path} names a decoder of its own")
    vocabulary = found.get_vocab(with_added_tokens=True)
    table: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        table[i] = piece
    return pa.array(table, pa.string())


def texts_of(ids: pa.Array, path: str) -> pa.Array:
    """The text of each list of ids; one lookup for all of them."""
    table = pieces(path)
    known = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    inside = (known >= 0) & (known < len(table))
    found = table.take(pa.array(np.where(inside, known, 0).astype(np.int32)))
    found = pc.if_else(pa.array(inside), found, pa.scalar(None, pa.string()))
    length = pc.list_value_length(ids).fill_null(0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(length)])
    valid = found.is_valid().to_numpy(zero_copy_only=False)
    if not valid.all():
        ends = np.concatenate([[0], np.cumsum(valid)])[ends]
        found = found.drop_null()
    texts = pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), found), " ")
    return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))


def decode(
    tokens: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded"
) -> DataFrame:
    """``tokens`` with the text that an array of ids stands for.

    The table of pieces is as long as the vocabulary, so every task has it and joins an
    id with its piece by place, a whole batch of ids at once; a join that moved rows would
    shuffle every token.  Pieces are joined by a blank, as the library does for a tokenizer
    without a decoder of its own; special tokens stay.  Ids that the vocabulary lacks have no
    piece and leave no trace; null gives null and no ids give the empty text.
    """
    field = T.StructField(to, T.StringType())
    return append_columns(tokens, [field], [ids], lambda: lambda packed: [texts_of(packed, path)])
