"""BPE by distinct words against the tokenizers library."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm import queries, wordtable
from tripmart.llm.common import by_position, words_of

from .conftest import noise

WORDS = P.path(queries.WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def test_query_equals_the_library(spark, sf_dir, documents, library):
    want = {}
    for r in documents.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        spelled = " ".join(map(str, ids)).encode()
        want[r.doc_id] = (len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    rows = queries.op13_word_table(spark, sf_dir).collect()
    assert len(rows) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def check(df, library):
    coded = wordtable.decode(wordtable.encode(df, WORDS), WORDS)
    assert coded.columns == [c for c in df.columns if c != "text"] + ["token_ids", "decoded"]
    both = wordtable.encode(df, WORDS, decoded="decoded")
    assert sorted(map(str, both.collect())) == sorted(map(str, coded.collect()))
    others = [c for c in df.columns if c != "text"]
    want = []
    for r in df.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((*[r[c] for c in others], ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, map(tuple, coded.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("size", [1, 2000, 1 << 22])
def test_messy_rows(messy, library, monkeypatch, size):
    monkeypatch.setattr(wordtable, "BLOCK_BYTES", size)
    check(messy, library)


def test_input_out_of_an_exchange(spark, documents, library):
    some = documents.select("doc_id", "text").repartition(3).dropDuplicates(["doc_id"])
    got = {r.doc_id: r.token_ids for r in wordtable.encode(some, WORDS).collect()}
    for r in documents.collect():
        assert got[r.doc_id] == library.encode(r.text or "", add_special_tokens=False).ids


def test_a_block_that_changes_is_an_error(documents):
    random_word = F.udf(lambda: os.urandom(4).hex()).asNondeterministic()
    unstable = documents.select("doc_id", F.concat("text", F.lit(" "), random_word()).alias("text"))
    with pytest.raises(Exception, match="came out differently"):
        wordtable.encode(unstable, WORDS).count()


def test_empty_table(empty):
    assert wordtable.decode(wordtable.encode(empty, WORDS), WORDS).count() == 0


def test_noise_special_tokens_and_all_characters(spark, library):
    texts = [noise(i, 500) for i in range(100)]
    texts += ["a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "´́ e ́ Å", "Σς ΑΣ\nİ \x1c\x85a\xa0b"]
    texts += ["".join(chr(c) for c in range(s, s + 500) if not 0xD800 <= c < 0xE000) for s in range(0, 0x20000, 500)]
    names = "n_words int, text string, Token_Ids int, block int"
    df = spark.createDataFrame([(i, t, 5, 6) for i, t in enumerate(texts)], names)
    coded = wordtable.encode(df, WORDS)
    assert coded.columns == ["n_words", "block", "token_ids"]
    ids = {r.n_words: r.token_ids for r in coded.collect()}
    for i, t in enumerate(texts):
        assert ids[i] == library.encode(t, add_special_tokens=False).ids, repr(t[:60])


def test_each_distinct_word_is_encoded_once(documents, monkeypatch, library):
    monkeypatch.setattr(wordtable, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(wordtable, "PART_BYTES", 20_000)
    questions = wordtable.asked(wordtable.Source(documents.select("doc_id", "text"), "text"))
    assert questions.select("part").distinct().count() > 3
    words = {w for r in documents.collect() for w in words_of((r.text or "").encode()).split()}
    table = [r for r in wordtable.word_table(questions, WORDS).collect() if r.word]
    assert len(table) == len(words) and {bytes(r.word) for r in table} == words
    for r in table[::50]:
        assert list(r.ids) == library.encode(bytes(r.word).decode(), add_special_tokens=False).ids


def test_words_are_split_where_the_tokenizer_splits(library):
    rng = random.Random(3)
    alphabet = "abcXYZ012'\".,!?-#%&*()<|> \n\té\u0301\u030aWßİ\u4e2d٣"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25)))
        ids = library.encode(text, add_special_tokens=False).ids
        parts = words_of(text.encode()).split()
        apart = [i for w in parts for i in library.encode(w.decode(), add_special_tokens=False).ids]
        assert apart == ids, repr(text)


@pytest.mark.parametrize("values", [[], [0], [0, 0], [3, 255], [1, 256, 65535], [70000, 2], [2**32 - 1, 0]])
def test_packed_numbers(values):
    zstd = pa.Codec("zstd")
    given = np.array(values, np.int64)
    assert wordtable._unpacked(wordtable._packed(given, zstd), zstd).tolist() == values


def test_decode_of_foreign_ids(spark, library):
    rows = [([49406, 320, 49407],), ([],), (None,), ([-1, 320, 10**6, 320],), ([10**6],)]
    df = spark.createDataFrame(rows, "token_ids array<int>")
    got = [r.decoded for r in wordtable.decode(df, WORDS).collect()]
    assert got[:3] == [library.decode(rows[0][0], skip_special_tokens=False), "", None]
    assert got[3] == library.decode([320, 320]) and got[4] == ""


def test_ids_by_position():
    coded = [np.array(x, "<u4").tobytes() for x in ([7], [], [8, 9])]
    ids, ends = by_position(coded, np.array([2, 0, 1, 2, 2]))
    assert ids.tolist() == [8, 9, 7, 8, 9, 8, 9] and ends.tolist() == [2, 3, 3, 5, 7]
    assert by_position([], np.zeros(0, np.int64))[0].tolist() == []
