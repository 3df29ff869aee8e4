"""Exact duplicates, repeated lines and mixing against brute force and SQL."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripmart.llm import exact, linededup, mixing, queries

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_equals_its_sql(spark, sf_dir, duck, same, name):
    same(queries.QUERIES[name](spark, sf_dir), duck, queries.TWINS[name])


def normal(text):
    return (text or "").translate(TABLE)


def test_copies_of_messy_rows(messy, empty):
    groups = defaultdict(list)
    for r in messy.collect():
        groups[normal(r.text)].append(r.doc_id)
    rows = exact.group_copies(messy).withColumn("sha", exact.digest("text")).collect()
    assert len(rows) == messy.count()
    for r in rows:
        ids = groups[normal(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), r.doc_id == keep)
        assert r.sha == hashlib.sha256(normal(r.text).encode()).hexdigest()
    kept = exact.drop_copies(messy)
    assert kept.columns == messy.columns
    assert Counter((normal(r.text), r.doc_id) for r in kept.collect()) == Counter(
        {(t, max((i for i in ids if i is not None), default=None)): 1 for t, ids in groups.items()}
    )
    assert exact.group_copies(empty).count() == 0 and exact.drop_copies(empty).count() == 0


def test_equal_prefix_and_length_are_not_enough(spark):
    head = "h" * 500
    df = spark.createDataFrame([(1, head + "a"), (2, head + "b"), (3, head + "A")], "doc_id long, text string")
    kept = {r.doc_id: (r.keep_id, r.group_size) for r in exact.group_copies(df).collect()}
    assert kept == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def test_copies_need_no_python(spark, sf_dir, plan_of):
    plan = plan_of(queries.op9_exact_dedup(spark, sf_dir))
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def brute_lines(rows):
    """Removed line positions by distinct (key, text), in key order, null first."""
    seen, out = {}, {}
    keyed = sorted({(r.doc_id, r.text) for r in rows if r.text is not None},
                   key=lambda x: (x[0] is not None, x[0] or 0))
    for key, text in keyed:
        lines = text.split("\n")
        for i in range(len(lines) - 2):
            seen.setdefault(tuple(lines[i : i + 3]), (key, i))
    for key, text in keyed:
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            if seen[tuple(lines[i : i + 3])] != (key, i):
                gone |= {i, i + 1, i + 2}
        out[key, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_lines_of_messy_rows(messy, empty):
    want = brute_lines(messy.collect())
    result = linededup.drop_repeated_lines(messy.withColumn("original", F.col("text")))
    rows = result.collect()
    assert len(rows) == messy.count() and "SHARD" in result.columns
    for r in rows:
        expected = (None, 0, 0) if r.original is None else want[r.doc_id, r.original]
        assert (r.text, r.n_lines, r.n_removed) == expected
    assert linededup.drop_repeated_lines(empty).count() == 0


def test_overlapping_windows_merge(spark):
    text = "\n".join("abcdefg")
    df = spark.createDataFrame([(1, text), (2, "x\nb\nc\nd\ne\ny")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.drop_repeated_lines(df).collect()}
    assert got == {1: (text, 0), 2: ("x\ny", 4)}


def poisson_inverse(u, rate):
    p = cdf = math.exp(-rate)
    k = 0
    while cdf <= u and p > 0:
        k += 1
        p *= rate / k
        cdf += p
    return k


def test_counts_invert_the_poisson_distribution(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    rows = mixing.replicate(df, total=10_000).groupBy("doc_id").count().collect()
    got = {r.doc_id: r["count"] for r in rows}
    for i in range(4000):
        u = int(hashlib.md5(f"7|{i}|0".encode()).hexdigest()[:12], 16) / 2**48
        assert got.get(i, 0) == poisson_inverse(u, 2.5)


def test_shares_follow_given_weights_and_high_rates_work(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 30, "rare").otherwise("many").alias("source")
    )
    mixed = mixing.replicate(df, weights={"rare": 3.0, "many": 1.0}, total=40_000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["rare"] - 30_000) < 900 and abs(counts["many"] - 10_000) < 500


def test_mix_of_messy_rows(messy, empty):
    out = mixing.replicate(messy, total=3000)
    assert out.columns == [*messy.columns, "copy", "mix_key"]
    rows = out.collect()
    assert {r.source for r in rows} == {"s1", "s2", None}
    copies = defaultdict(set)
    for r in rows:
        if r.doc_id is not None and r.doc_id != 6:
            copies[r.doc_id].add(r.copy)
    assert all(c == set(range(len(c))) for c in copies.values())
    assert mixing.replicate(messy, copy=None, order=None).columns == messy.columns
    again = mixing.replicate(messy, total=3000).collect()
    assert Counter(map(str, again)) == Counter(map(str, rows))
    assert mixing.replicate(empty).count() == 0
