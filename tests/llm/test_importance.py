"""Importance resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripmart.llm import importance, queries

from .test_exact_lines_mix import TABLE

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(docs, target, runs=1, size=10_000, percent=10, min_words=20, seed=2024):
    """Rows (id, n_features, weight, score, rank) of (id, text) pairs."""

    def features(text):
        words = WORD.findall((text or "").translate(TABLE))
        joined = [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % size for f in joined]

    coded = [(key, *features(text)) for key, text in docs]
    s = Counter(b for _, _, found in coded for b in found)
    t = Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + size) / ((s[b] + 1) * (t_all + size))))
    rows = []
    for key, n_words, found in coded:
        weight = sum(map(gain, found)) // max(1, len(found))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append(((-score, key is None, key or 0, len(found), weight), n_words >= min_words, key))
    able = sorted(r for r in rows if r[1])
    drawn = len(able) * percent // 100
    out = [(key, k[3], k[4], -k[0], i + 1 if i < drawn else None) for i, (k, _, key) in enumerate(able)]
    out += [(key, k[3], k[4], -k[0], None) for k, enough, key in rows if not enough]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_plain_computation(spark, sf_dir, documents):
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = plain([(r.doc_id, r.text) for r in documents.collect()], target)
    assert got(queries.op12_importance_draw(spark, sf_dir)) == want


@pytest.mark.parametrize(("runs", "percent", "min_words"), [(1, 10, 20), (1, 100, 0), (2, 50, 1), (3, 33, 2)])
def test_messy_rows(spark, messy, runs, percent, min_words):
    target = ["the lazy dog", None, "", "x fox"]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    want = plain(docs, target, runs, 10_000, percent, min_words)
    made = importance.resample(messy, aim, runs=runs, percent=percent, min_words=min_words)
    assert got(made) == want


def test_empty_tables(messy, empty):
    assert got(importance.resample(empty, messy)) == []
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    assert got(importance.resample(messy, empty, percent=50)) == plain(docs, [], percent=50)


@pytest.mark.parametrize("pivots", [1, 2, 32])
def test_selection_finds_every_place(spark, pivots):
    rng = random.Random(2)
    rows = [(rng.randint(0, 9), rng.choice([None, 1, 2, 3, 4]), rng.randint(1, 3)) for _ in range(60)]
    df = spark.createDataFrame(rows, "score long, id long, copies long")
    df = df.withColumn("n_features", F.lit(1).cast("long")).withColumn("weight", F.lit(0).cast("long"))
    keys = df.groupBy(importance._sort_key().alias("key")).agg(F.sum("copies").alias("copies")).cache()
    flat = sorted(tuple(r.key) for r in keys.collect() for _ in range(r.copies))
    for k in {1, 2, 17, len(flat) // 2, len(flat) - 1, len(flat)}:
        key, before = importance.kth_key(keys, k, 7, pivots)
        assert key == flat[k - 1] and before == flat.index(key)
