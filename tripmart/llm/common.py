"""Helpers that several of the training-data operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space that separates words, \x20 and \x09-\x0D.
WORD_SPACE = " \t\n\x0b\f\r"
WORD_SPACE_PATTERN = r"[\x20\x09-\x0D]+"
# Rows whose results are in a Python worker's memory together.
SLICE_ROWS = 1000
# Runs of signs behind or before an ASCII letter or digit, not with an apostrophe, which
# starts contractions.
_SIGNS = rb"[!-&(-/:-@\[-`{-~]+"
_TAIL = re.compile(rb"(?<=[a-z0-9])(" + _SIGNS + rb")(?=[\x09-\x0D\x20]|\Z)")
_HEAD = re.compile(rb"(?<![^\x09-\x0D\x20])(" + _SIGNS + rb")(?=[a-z0-9])")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A lambda evaluates what it refers to anew for every element, unless that is
    bound to a variable of an enclosing lambda, as here.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def spare(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the fast path holds for plain ASCII texts."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def append_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    inputs: Sequence[str],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """``df`` with columns computed per Arrow batch; columns of the same names give way.

    ``make`` runs once per task and returns a function from the input columns of
    a batch to one array per new field.
    """
    fresh = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in fresh]
    carried = df.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs)],
    )
    schema = T.StructType([*carried.schema.fields[: len(kept)], *fields])
    width, names = len(kept), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                columns = batch.slice(start, SLICE_ROWS).columns
                made = compute(*columns[width:])
                yield pa.RecordBatch.from_arrays([*columns[:width], *made], names=names)

    return carried.mapInArrow(run, schema)


def words_of(text: bytes) -> bytes:
    """A text with blanks where a lower-casing tokenizer splits anyway, in small letters if safe.

    Fewer distinct words then stand for the same ids: such a tokenizer drops white space
    and splits between letters or digits and signs.  Texts in which a special token may
    stand are left as they are; those with combining marks keep their case, as some marks
    join with small letters only.
    """
    if b"<|" in text:
        return text
    if b"\xcc" not in text and b"\xcd" not in text:
        text = text.lower()
    return _HEAD.sub(rb"\1 ", _TAIL.sub(rb" \1", text))


def numbered_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of the word at each position, positions per text, the distinct words).

    Words are ``words_of`` the texts.  An empty word stands where white space starts or
    ends a text.
    """
    ready = pa.array(map(words_of, texts), pa.binary()).cast(pa.string())
    listed = pc.ascii_split_whitespace(ready)
    numbered = listed.flatten().dictionary_encode()
    counts = pc.list_value_length(listed).to_numpy().astype(np.int64)
    return numbered.indices.to_numpy(), counts, numbered.dictionary.cast(pa.binary())


def by_position(
    coded: Sequence[bytes], position: np.ndarray, dtype: str = "<u4"
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the packed ids at each position after one another, and where each ends."""
    flat = np.frombuffer(b"".join(coded), dtype)
    length = np.fromiter(map(len, coded), np.int64, len(coded)) // flat.itemsize
    start = np.cumsum(length) - length
    n = length[position]
    ends = np.cumsum(n)
    source = np.repeat(start[position] - (ends - n), n)
    source += np.arange(len(source))
    return flat[source], ends


def cut_binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values between offsets, counted in items of ``values``."""
    offsets = offsets * values.itemsize
    if offsets[-1] > np.iinfo(np.int32).max:
        data = values.tobytes()
        return pa.array([data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data]
    )
