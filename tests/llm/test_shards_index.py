"""Hilbert shards and the token index."""

import glob
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tripmart.llm import hilbert, mphindex, queries

from .conftest import ALPHABET, noise

WORDS = P.path(queries.WORD_BPE)


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 4), (3, 1), (3, 4), (4, 2)])
def test_curve_visits_every_cell_one_step_at_a_time(n, bits):
    cells = {hilbert.curve_index(p, bits): p for p in product(range(1 << bits), repeat=n)}
    assert sorted(cells) == list(range(1 << bits * n))
    for i in range(1, len(cells)):
        assert sum(abs(a - b) for a, b in zip(cells[i - 1], cells[i], strict=True)) == 1


def check_shards(rows, source, shards):
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in source)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in source)
    assert texts == Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)


def test_shards_query(spark, sf_dir, documents):
    rows = queries.op4_hilbert_shards(spark, sf_dir).collect()
    check_shards(rows, documents.collect(), queries.SHARDS)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_shards_follow_the_curve(documents):
    rows = sorted(hilbert.assign_shards(documents, 7).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.cell for r in rows] == sorted(r.cell for r in rows)


def test_shards_of_messy_rows(messy, empty):
    for shards in (1, 5, 24, 100):
        check_shards(hilbert.assign_shards(messy, shards).collect(), messy.collect(), shards)
    assert hilbert.assign_shards(empty, 24).count() == 0


def test_shard_files(spark, documents, tmp_path):
    assigned = hilbert.assign_shards(documents, 4)
    hilbert.write_shards(documents, assigned, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == documents.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_shard_is_several_files_in_slot_order(spark, tmp_path):
    rows = [(i if i else None, f"text {i} " * (i % 50), "s", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    assigned = hilbert.assign_shards(docs, 3)
    path = str(tmp_path / "s")
    hilbert.write_shards(docs, assigned, path, file_bytes=4000)
    slots = {r.doc_id: (r.shard, r.slot) for r in assigned.collect()}
    seen = 0
    for shard in range(3):
        files = sorted(glob.glob(f"{path}/shard={shard}/*.parquet"))
        assert len(files) > 3
        ids = [r.doc_id for f in files for r in spark.read.parquet(f).collect()]
        placed = [slots[i] for i in ids]
        assert placed == sorted(placed) and {s for s, _ in placed} == {shard}
        seen += len(ids)
    assert seen == 400
    assert spark.read.parquet(path).filter("doc_id IS NULL").count() == 1


def test_shards_of_a_hot_null_key(spark):
    rows = [(None, f"t{i}", "s", "en") for i in range(300)] + [(i, "same", "s", "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    check_shards(hilbert.assign_shards(docs, 7).collect(), docs.collect(), 7)


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        index = mphindex.PerfectHash.build(keys)
        assert sorted(index(keys).tolist()) == list(range(len(keys)))
    assert (index(np.arange(50_000)) < len(keys)).all()


def test_words_encode_like_whole_texts(monkeypatch):
    whole, words = Tokenizer.from_file(WORDS), mphindex.word_encoder(WORDS)
    whole.encode_special_tokens = True
    texts = [noise(i, 400) for i in range(300)]
    texts += ["it's <|endoftext|> O'NEIL'S we'll", "Å Å é e ́", ALPHABET, "a\x1cb\x85c d"]
    texts += [" ".join(chr(c) for c in range(s, s + 500) if not 0xD800 <= c < 0xE000) for s in range(0, 0x20000, 500)]
    texts += ["W\u030a w\u030a H\u0331x, <|startoftext|>", "(ab) #c# ''d 'e", "  lead", "trail  "]
    texts += ["ab, c.d! e'S! É, İ. Σς, \u0345. a1* '; -x- 中, ²)", "I\u0307, K\u0301! ", "z" * 500 + ", ok"]
    monkeypatch.setattr(mphindex, "CACHE_WORDS", 1000)
    for start in range(0, len(texts), 50):
        group = texts[start : start + 50]
        for text, got in zip(group, words.encode([t.encode() for t in group]), strict=True):
            want = whole.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u2").tolist() == want, repr(text[:80])


def test_small_caches_and_wide_vocabularies(monkeypatch):
    encoder = mphindex.WordEncoder(WORDS)
    monkeypatch.setattr(mphindex, "CACHE_WORDS", 5)
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    for i in range(40):
        text = noise(i, 60)
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u2").tolist() == want
        assert len(encoder.young) < 40
    assert encoder.encode([]) == []
    monkeypatch.setattr(mphindex, "MAX_ID", 1000)
    with pytest.raises(ValueError, match="16 bits"):
        mphindex.WordEncoder(WORDS)


def want_rows(rows):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    coded = []
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [queries.END_ID]
        packed = np.array(ids, "<u4").tobytes()
        coded.append((r.doc_id is not None, r.doc_id or 0, len(ids), np.array(ids, "<u2").tobytes(), packed))
    out, start = [], 0
    for named, key, n, _, packed in sorted(coded):
        out.append((key if named else None, start, n, zlib.crc32(packed)))
        start += n
    return sorted(out, key=str)


def check_rows(got, want):
    """Rows of one key may come in any order; what a key holds starts where it should."""
    def by_key(rows):
        groups = defaultdict(list)
        for key, start, n, crc in rows:
            groups[key].append((start, n, crc))
        return {
            key: (min(s for s, _, _ in g), Counter((n, crc) for _, n, crc in g))
            for key, g in groups.items()
        }

    assert by_key(got) == by_key(want)
    ends, at = sorted((s, s + n) for _, s, n, _ in got), 0
    for start, end in ends:
        assert start == at
        at = end


def got_rows(spark, docs, path):
    mphindex.write_index(docs, path, WORDS, queries.END_ID)
    rows = mphindex.with_starts(mphindex.read_index(spark, path), path).collect()
    return sorted(
        ((r.key, r.start, len(r.ids) // 4, zlib.crc32(bytes(r.ids))) for r in rows), key=str
    )


def test_index_query(spark, sf_dir, documents):
    rows = queries.op10_token_index(spark, sf_dir).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=str)
    assert got == want_rows(documents.collect())


def test_index_of_messy_rows(spark, messy, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(mphindex, "DOCS_PER_PART", 4)
    check_rows(got_rows(spark, messy, str(tmp_path / "m")), want_rows(messy.collect()))
    assert got_rows(spark, empty, str(tmp_path / "e")) == []


def test_hot_and_null_keys_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mphindex, "DOCS_PER_PART", 16)
    monkeypatch.setattr(mphindex, "SHARD_IDS", 60)
    rows = [(5, f"hot number {i}") for i in range(300)] + [(None, f"no key {i}") for i in range(300)]
    rows += [(i, f"word{i} and more") for i in range(-150, 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "h")
    check_rows(got_rows(spark, docs, path), want_rows(docs.collect()))
    shards = spark.read.parquet(path)
    assert shards.agg({"n_docs": "max"}).first()[0] <= 31 and shards.agg({"n_ids": "max"}).first()[0] <= 60
    holding = shards.filter("first <= 5 and last >= 5")
    assert holding.select("part").distinct().count() > 5
    assert shards.filter("nulls > 0").select("part").distinct().count() > 5
    found = mphindex.find_documents(spark, path, [5, 7, 10**9]).collect()
    assert Counter(r.key for r in found) == {5: 301, 7: 1}


def test_lookup_reads_the_shards_of_its_keys_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mphindex, "DOCS_PER_PART", 64)
    monkeypatch.setattr(mphindex, "SHARD_IDS", 40)
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('word', id, ' other') AS text")
    path = str(tmp_path / "l")
    mphindex.write_index(docs, path, WORDS, queries.END_ID)
    shards = spark.read.schema(mphindex.SHARD_SCHEMA).parquet(path)
    assert shards.count() > 150
    keys = [3, 4, 500, 700, 900, 1100, 1300, 1500, 1700, 1999]
    hits = mphindex.hit_shards(shards, keys)
    assert 0 < hits.count() <= 10
    found = mphindex.find_documents(spark, path, keys)
    assert sorted(r.key for r in found.collect()) == keys
    scans = found._jdf.queryExecution().executedPlan().collectLeaves()
    read = scans.head().metrics().apply("numOutputRows").value()
    # Row groups that the bounds leave out are not read.
    assert read <= 10
    assert mphindex.find_documents(spark, path, [-5, 10**9]).count() == 0


def test_keyed_access(spark, documents, tmp_path):
    path = str(tmp_path / "k")
    mphindex.write_index(documents, path, WORDS, queries.END_ID)
    found = mphindex.find_documents(spark, path, [3, 150, -1, 10**12]).collect()
    assert sorted(r.key for r in found) == [3, 150]
    text = documents.filter("doc_id = 150").first().text
    ids = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    row = next(r for r in found if r.key == 150)
    assert np.frombuffer(row.ids, "<u2").tolist() == [*ids, queries.END_ID]


def test_shards_are_cut_by_size():
    keys, ids = [None, 5, 5, 9], [b"\1\0", b"\2\0\2\0", b"", b"\3\0"]
    shard = mphindex.Shard(mphindex.pack_shard(0, 0, keys, ids))
    found, first, count = shard.find(np.array([5, 9, 6]))
    assert found.tolist() == [True, True, False]
    assert first[:2].tolist() == [1, 3] and count[:2].tolist() == [2, 1]
    assert shard.document(3)[1].tolist() == [3] and shard.document(2)[0] == 3
