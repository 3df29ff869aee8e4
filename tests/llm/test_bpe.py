import base64
import hashlib
import random
import struct
import time

import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken

from tripmart.llm import bpe, queries

from .conftest import noise

PATH = P.path(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_every_code_point_alone_and_between_letters(reference):
    codec = bpe.codec(PATH, P.PATTERN)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for glue in ("", "a"):
        for start in range(0, len(points), 4096):
            text = glue.join(points[start : start + 4096])
            assert ids_of(codec.encode(text)) == reference.encode_ordinary(text), hex(start)


def test_white_space_of_both_engines(reference):
    spaces = {c for c in map(chr, range(0x110000)) if c.isspace()}
    assert {c for c in spaces if not regex.match(r"\s", c)} == set("\x1c\x1d\x1e\x1f")
    codec = bpe.codec(PATH, P.PATTERN)
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("ab1!' \t\n\r\x1c\x85\xa0\u2003 ") for _ in range(rng.randrange(12)))
        assert ids_of(codec.encode(text)) == reference.encode_ordinary(text), repr(text)


def test_random_texts(reference):
    codec = bpe.codec(PATH, P.PATTERN)
    for seed in range(300):
        text = noise(seed, random.Random(seed).randrange(400))
        ids = codec.encode(text)
        assert ids_of(ids) == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_long_pieces_cost_little_more_than_their_length():
    codec = bpe.codec(PATH, P.PATTERN)
    rng = random.Random(1)
    piece = "".join(rng.choice("abcdefghijkl") for _ in range(100_000))
    started = time.perf_counter()
    ids = codec.encode(piece)
    assert codec.decode(ids) == piece.encode()
    assert time.perf_counter() - started < 30


def test_merges_take_the_leftmost_of_equal_ranks():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3}
    assert bpe.merge_piece(b"aaab", ranks) == [2, 0, 1]
    assert bpe.merge_piece(b"aaaab", ranks) == [2, 3]
    assert bpe.merge_piece(b"aab", ranks) == [3]


def test_cache_is_bounded(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    small = bpe.Codec(bpe.codec(PATH, P.PATTERN).merge.ranks, P.PATTERN)
    for seed in range(5):
        text = noise(seed, 2000)
        assert ids_of(small.encode(text)) == reference.encode_ordinary(text)
    assert max(len(x) for c in (small.by_piece, small.by_chunk) for x in (c.young, c.old)) <= 3


def test_pieces_merged_together_equal_those_merged_alone():
    merge = bpe.codec(PATH, P.PATTERN).merge
    rng = random.Random(4)
    pieces = [bytes(rng.choice(b"abcehinorst \xc3\xa9") for _ in range(rng.randrange(1, 24))) for _ in range(6000)]
    for piece, packed in zip(pieces, merge(pieces), strict=True):
        assert ids_of(packed) == bpe.merge_piece(piece, merge.ranks)
    assert merge([]) == []


def test_merges_of_a_small_vocabulary():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aab": 257, b"bb": 258}
    merge = bpe.Merger(ranks)
    for piece in (b"aaab", b"aaaab", b"aab", b"abbb", b"z", b"aaaaaaaaaaaaaaaabb"):
        assert ids_of(merge([piece])[0]) == bpe.merge_piece(piece, ranks)
    del ranks[b"z"]
    assert ids_of(bpe.Merger(ranks)([b"aab", b"bab"])[1]) == [98, 97, 98]


def test_another_pattern_is_matched_in_full(reference):
    ranks = bpe.codec(PATH, P.PATTERN).merge.ranks
    pattern = r"\p{L}+ ?|[^\p{L}]"
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, pattern)
    for seed in range(20):
        text = noise(seed, 300) + " plain words, here. "
        assert ids_of(codec.encode(text)) == other.encode_ordinary(text)
    assert P.PATTERN == bpe.WORDWISE


def test_slices_of_any_size(monkeypatch, reference):
    codec = bpe.codec(PATH, P.PATTERN)
    texts = [None, "", " ", "a", " a", "a ", "a  b", "x\ny z", "x\n z", "\ta b", *[noise(s, 90) for s in range(40)]]
    for size in (1, 50, 1 << 22):
        monkeypatch.setattr(bpe, "SLICE_BYTES", size)
        packed = codec.encode_all(pa.array(texts))
        assert [ids_of(x) for x in packed.to_pylist()] == [reference.encode_ordinary(t or "") for t in texts]
        assert codec.decode_all(packed).to_pylist() == [(t or "").encode() for t in texts]
    assert codec.encode_all(pa.array(texts)[3:5]).to_pylist() == codec.encode_all(pa.array(texts[3:5])).to_pylist()


def test_decode_of_nulls_and_foreign_ids():
    codec = bpe.codec(PATH, P.PATTERN)
    some = pa.array([codec.encode("ab c"), None, b"", codec.encode("d")], pa.binary())
    assert codec.decode_all(some).to_pylist() == [b"ab c", None, b"", b"d"]
    assert codec.decode_all(some[1:]).to_pylist() == [None, b"", b"d"]
    assert codec.decode_all(some[:0]).to_pylist() == []
    with pytest.raises((ValueError, IndexError)):
        codec.decode(struct.pack("<I", 1 << 30))


def test_operator_on_messy_rows(messy, empty, reference):
    rows = bpe.decode(bpe.encode(messy, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert len(rows) == messy.count()
    for r in rows:
        assert ids_of(r.token_ids) == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.kept in ("yes", None)
    both = bpe.encode(messy, PATH, P.PATTERN, decoded="KEPT").drop("text")
    assert both.columns == [*[c for c in messy.columns if c not in ("text", "kept")], "token_ids", "KEPT"]
    plainly = bpe.decode(bpe.encode(messy, PATH, P.PATTERN), PATH, P.PATTERN, to="KEPT").select(*both.columns)
    assert sorted(map(str, both.collect())) == sorted(map(str, plainly.collect()))
    again = bpe.encode(bpe.encode(messy, PATH, P.PATTERN), PATH, P.PATTERN)
    assert again.columns == [*messy.columns, "token_ids"]
    assert bpe.encode(empty, PATH, P.PATTERN).count() == 0


def test_query(spark, sf_dir, documents, reference):
    got = {r.doc_id: r for r in queries.op1_byte_bpe(spark, sf_dir).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for d in rows:
        ids = reference.encode_ordinary(d.text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
