"""Language identification with string kernels.

A text is the set of its character n-grams (n = 1 to 4) after lower-casing, with
anything but letters turned into single spaces: a blended-spectrum presence
kernel, k(x, y) = |x & y| / sqrt(|x| |y|).  Landmark texts give its Nystroem
features K(x, L) K(L, L)^(-1/2); one ridge regression per language against the
rest is fitted on them.  Both steps are linear in the presence vector up to its
length, so a batch is scored by one product of its presence matrix with a weight
matrix of the size of the n-gram space.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import append_columns

LONGEST = 4
# n-grams are hashed to this many bits: the width of all presence vectors.
BITS = 16
# Bounds of the training sample and of the landmarks in it, per language and in all.
TRAIN_ROWS, SAMPLE_ROWS = 256, 4096
LANDMARKS, ALL_LANDMARKS = 48, 768
RIDGE = 1e-3
BATCH = 64
UNDETERMINED = "und"

_CODE_POINTS = 0x110000


def _letters() -> np.ndarray:
    """Code point to itself for letters, to a space for the rest."""
    table = np.full(_CODE_POINTS, 32, np.uint32)
    points = np.array([c for c in range(_CODE_POINTS) if chr(c).isalpha()], np.uint32)
    table[points] = points
    return table


_table: np.ndarray | None = None


def grams(text: str | None) -> np.ndarray:
    """Hashes of all n-grams, with repetitions; empty if the text has no letter."""
    global _table
    if _table is None:
        _table = _letters()
    if not text:
        return np.zeros(0, np.int64)
    points = _table[np.frombuffer(text.lower().encode("utf-32-le"), "<u4")]
    space = points == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    points = points[keep].astype(np.uint64)
    if not (points != 32).any():
        return np.zeros(0, np.int64)
    found, key = [], np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        key = key[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
        mixed = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(found)


def presence(lists: list[np.ndarray]) -> np.ndarray:
    """One row of zeros and ones per list of n-gram hashes."""
    rows = np.zeros((len(lists), 1 << BITS), np.float32)
    for row, hashes in zip(rows, lists, strict=True):
        row[hashes] = 1
    return rows


class Model(NamedTuple):
    """Weights per n-gram and language (a last column of ones counts the n-grams), offsets."""

    languages: list[str]
    weights: np.ndarray
    offsets: np.ndarray

    def scores(self, lists: list[np.ndarray]) -> np.ndarray:
        product = presence(lists) @ self.weights
        return product[:, :-1] / np.sqrt(np.maximum(product[:, -1:], 1)) + self.offsets


def fit(samples: list[tuple[str, np.ndarray]]) -> Model:
    """A model of labelled sets; the first few of each language are landmarks."""
    languages = sorted({lang for lang, _ in samples})
    share = max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))
    taken = dict.fromkeys(languages, 0)
    chosen = []
    for lang, ids in samples:
        if taken[lang] < share:
            taken[lang] += 1
            chosen.append(ids)
    landmarks = presence(chosen)
    landmarks /= np.sqrt(landmarks.sum(axis=1, keepdims=True))
    kernel = []
    for start in range(0, len(samples), BATCH):
        rows = presence([ids for _, ids in samples[start : start + BATCH]])
        kernel.append(rows @ landmarks.T / np.sqrt(rows.sum(axis=1, keepdims=True)))
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    used = values > 1e-6 * values.max()
    root = vectors[:, used] / np.sqrt(values[used])
    features = np.concatenate(kernel).astype(np.float64) @ root
    goal = np.array([[1.0 if lang == c else -1.0 for c in languages] for lang, _ in samples])
    centre, level = features.mean(axis=0), goal.mean(axis=0)
    x = features - centre
    gram = x.T @ x + RIDGE * len(samples) * np.eye(x.shape[1])
    solution = np.linalg.solve(gram, x.T @ (goal - level))
    weights = landmarks.T @ (root @ solution).astype(np.float32)
    ones = np.ones((weights.shape[0], 1), np.float32)
    return Model(
        languages, np.hstack([weights, ones]), (level - centre @ solution).astype(np.float32)
    )


def training_sets(docs: DataFrame, key: str, text: str, label: str) -> list[tuple[str, np.ndarray]]:
    """At most ``TRAIN_ROWS`` labelled sets of each language and ``SAMPLE_ROWS`` in all.

    The rows of the sample are shared out evenly: with many languages each has fewer, with
    as many as rows one each (and beyond, the most frequent ones).  Rows are drawn by a hash
    of key and text.  The languages' counts thin each language to about four times the rows wanted before
    they are ranked, so what is shuffled doesn't grow with the table; the n-gram
    sets are made on the executors.
    """
    lang = F.col(f"`{label}`").cast("string")
    rows = docs.select(
        lang.alias("lang"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("draw"),
    ).filter("lang is not null and text rlike '\\\\p{L}'")
    # No more languages than rows in the sample.
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_ROWS)
    frequent = materialize(frequent, "languages")
    each = max(1, min(TRAIN_ROWS, SAMPLE_ROWS // max(1, frequent.count())))
    draw = Window.partitionBy("lang").orderBy("draw")
    steps = 1 << 40
    share = F.pmod("draw", F.lit(steps)).cast("double") * F.col("count") < 4.0 * each * steps
    sample = (
        rows.join(F.broadcast(frequent), "lang")
        .filter(share)
        .withColumn("place", F.row_number().over(draw))
        .filter(F.col("place") <= each)
    )

    def make():
        def columns(texts: pa.Array) -> list[pa.Array]:
            made = [np.unique(grams(t.as_py())).astype("<u4").tobytes() for t in texts]
            return [pa.array(made, pa.binary())]

        return columns

    field = [T.StructField("grams", T.BinaryType())]
    found = append_columns(sample, field, ["text"], make).select("lang", "place", "grams")
    picked = sorted(found.collect(), key=lambda r: (r.lang, r.place))
    return [
        (r.lang, ids)
        for r in picked
        if len(ids := np.frombuffer(r.grams, "<u4").astype(np.int64))
    ]


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) from the text alone.

    Texts without a letter, null texts and a missing model give ``und`` and 0.
    Repeated rows are scored each; columns of these names are replaced.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    # A quarter of a megabyte for each language.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = sent.value

        def columns(texts: pa.Array) -> list[pa.Array]:
            names = [UNDETERMINED] * len(texts)
            scores = np.zeros(len(texts))

            def flush(at: list[int], lists: list[np.ndarray]) -> None:
                values = fitted.scores(lists)
                best = values.argmax(axis=1)
                scores[at] = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
                for i, b in zip(at, best, strict=True):
                    names[i] = fitted.languages[b]

            at, lists = [], []
            for i, value in enumerate(texts if fitted else ()):
                ids = grams(value.as_py())
                if len(ids):
                    at.append(i)
                    lists.append(ids)
                if len(at) == BATCH:
                    flush(at, lists)
                    at, lists = [], []
            if at:
                flush(at, lists)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return columns

    return append_columns(docs, fields, [text], make)


def identify(
    docs: DataFrame, learn_from: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang"
) -> DataFrame:
    """``docs`` with predictions of a model fitted on the labelled rows of ``learn_from``.

    The training sample is bounded by parameters of this module, whatever the
    input's size.  Without labelled rows every prediction is ``und``.
    """
    samples = training_sets(learn_from, key, text, label)
    return predict(docs, fit(samples) if samples else None, text)
