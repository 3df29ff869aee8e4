"""The pipeline stage by stage against brute force on a small table."""

import hashlib
import struct
from collections import Counter

import corpus_pipeline
import public_tokenizers as P
from pyspark.sql import functions as F

from tripmart.llm import bpe, queries

from .test_exact_lines_mix import normal, poisson_inverse
from .test_rules import counts
from .test_superminhash import brute


def store(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_stage_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "bpe_encode"]


def test_stages_equal_brute_force(spark, sf_dir, documents, tmp_path):
    docs, outputs = documents, []
    for name, stage in corpus_pipeline.STAGES:
        outputs.append((docs, docs := store(stage(spark, docs, sf_dir), str(tmp_path / name))))
    for _, after in outputs[:-1]:
        assert after.columns == documents.columns

    before, after = outputs[0]
    kept = {r.doc_id for r in after.collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    for r in before.collect():
        n, _, symbols, _, repeat = counts(r.text)
        failed = n < 20 or 100 * repeat > 30 * n
        assert not (failed and r.doc_id in kept)
        if not failed and (r.doc_id in good or symbols == 0):
            assert r.doc_id in kept

    before, after = outputs[1]
    last = {}
    for r in before.collect():
        last[normal(r.text)] = max(r.doc_id, last.get(normal(r.text), r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())

    before, after = outputs[2]
    groups = brute(before.collect())
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in groups.items() if i == c}

    before, after = outputs[3]
    rows = before.collect()
    sizes = Counter(r.source for r in rows)
    total = sum(n**0.5 for n in sizes.values())
    want = {}
    for r in rows:
        rate = sizes[r.source] ** 0.5 / total * len(rows) / sizes[r.source]
        u = int(hashlib.md5(f"7|{r.doc_id}|0".encode()).hexdigest()[:12], 16) / 2**48
        if times := poisson_inverse(u, rate):
            want[r.doc_id] = times
    assert Counter(r.doc_id for r in after.collect()) == want

    before, after = outputs[4]
    codec = bpe.codec(P.path(queries.BYTE_BPE), P.PATTERN)
    expected = Counter()
    for r in before.collect():
        ids = codec.encode(r.text)
        expected[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert struct.calcsize("I") == 4
    assert Counter(map(tuple, after.collect())) == expected

    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == expected


def test_stages_on_messy_rows(spark, sf_dir, messy, empty, tmp_path):
    for label, docs in (("messy", messy.withColumn("extra", F.lit(1))), ("empty", empty)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, sf_dir), str(tmp_path / label / name))
            assert docs.columns == columns or name == "bpe_encode"
            docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, messy, sf_dir).count() >= (0 if name == "quality_rules" else 1)
