import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import langid, queries


def test_query(spark, documents):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op2_string_kernel(spark, sf_dir).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    hits = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        text = truth[r.doc_id].text
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r.score <= 1
        if r.held_out and r.lang_pred != "und":
            hits.append(r.lang_pred == truth[r.doc_id].lang)
    assert len(hits) > 150 and np.mean(hits) > 0.97


def test_predictions_use_the_text_only(documents):
    model = langid.fit(langid.training_sets(documents, "doc_id", "text", "lang"))
    plain = langid.predict(documents, model).select("doc_id", "lang_pred", "score").collect()
    other = documents.withColumns({"lang": F.lit("zz"), "source": F.lit(None), "doc_id": -F.col("doc_id")})
    changed = langid.predict(other, model).select(-F.col("doc_id"), "lang_pred", "score").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, changed))


def test_weight_product_equals_the_kernel_machine():
    rng = np.random.default_rng(1)
    words = {"a": "alpha beta gamma delta ".split(), "b": "uno dos tres cuatro ".split()}
    samples = [
        (lang, np.unique(langid.grams(" ".join(rng.choice(w, 12)))))
        for lang, w in words.items()
        for _ in range(60)
    ]
    model = langid.fit(samples)
    sets = [set(ids.tolist()) for _, ids in samples]

    def k(x, y):
        return len(x & y) / np.sqrt(len(x) * len(y))

    marks = [*sets[:48], *sets[60:108]]
    inner = np.array([[k(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(inner)
    used = values > 1e-6 * values.max()
    root = vectors[:, used] / np.sqrt(values[used])
    phi = np.array([[k(x, m) for m in marks] for x in sets]) @ root
    goal = np.array([[1.0, -1.0]] * 60 + [[-1.0, 1.0]] * 60)
    x = phi - phi.mean(axis=0)
    solved = np.linalg.solve(x.T @ x + langid.RIDGE * 120 * np.eye(x.shape[1]), x.T @ goal)
    want = x @ solved + goal.mean(axis=0)
    assert np.allclose(model.scores([ids for _, ids in samples]), want, atol=2e-2)


@pytest.mark.parametrize("text", [None, "", " ", "123 !?", "\t\n"])
def test_no_letters(text):
    assert len(langid.grams(text)) == 0


def test_grams_ignore_case_and_signs():
    a, b = langid.grams("The  Cat,\nsat"), langid.grams("the cat SAT")
    assert (a == b).all() and len(a) == 11 + 10 + 9 + 8


def test_messy_rows(messy, empty, spark):
    rows = langid.identify(messy, messy).collect()
    assert len(rows) == messy.count()
    for r in rows:
        if any(c.isalpha() for c in r.text or ""):
            assert r.lang_pred in ("en", "de")
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in langid.identify(messy, empty).collect()} == {"und"}
    assert langid.identify(empty, messy).count() == 0
    one = messy.filter("lang = 'en'")
    assert {r.lang_pred for r in langid.identify(messy, one).collect()} == {"en", "und"}


def test_a_hundred_languages_are_learned(spark):
    """Each language has syllables of its own; the bound of the sample is shared out."""
    rng = np.random.default_rng(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for n in range(100):
        own = ["".join(rng.choice(list(letters), 3)) for _ in range(12)]
        for _ in range(60):
            rows.append((len(rows), " ".join("".join(rng.choice(own, 2)) for _ in range(30)), f"l{n:03d}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    test = F.col("doc_id") % 4 == 0
    sets = langid.training_sets(df.filter(~test), "doc_id", "text", "lang")
    assert len({lang for lang, _ in sets}) == 100 and len(sets) <= langid.SAMPLE_ROWS
    assert max(sum(lang == x for lang, _ in sets) for x in ("l000", "l099")) == langid.SAMPLE_ROWS // 100
    found = langid.predict(df.filter(test), langid.fit(sets)).collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.95
