import random
import re

import numpy as np
import pytest

from tripmart.llm import queries, superminhash

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """doc_id -> (n_shingles, component_id) from all pairs that share a shingle."""
    sets = {r.doc_id: shingle_set(r.text) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    seen = set()
    for ids in by_shingle.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(df, want):
    rows = df.collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_equals_all_pairs(spark, sf_dir, documents):
    check(queries.op7_superminhash(spark, sf_dir), brute(documents.collect()))


def chains(seed):
    """Texts in chains of edits with a common passage, so that leaders miss some links."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(8):
        words = [word() for _ in range(rng.randrange(30, 120))] + passage
        for _ in range(rng.randrange(1, 9)):
            out.append(" ".join(words))
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = word()
    out += [" ".join([word() for _ in range(12)] + passage) for _ in range(25)]
    rng.shuffle(out)
    return out


def test_chains_and_common_passages(spark):
    rows = [(i, t) for i, t in enumerate(t for s in range(4) for t in chains(s))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(superminhash.near_groups(df), brute(df.collect()))


def template(seed, size, more, planted):
    """Texts of one template (0.70 alike, not linked), and pairs of them that share a bit more."""
    rng = random.Random(seed)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]
    shared, out = words(704), []
    for i in range(size):
        own = words(150)
        if i % 2 and i < 2 * planted:
            n = more[i // 2 % len(more)]
            own[:n] = out[-1][704 : 704 + n]
        out.append(shared + own)
    return [" ".join(t) for t in out]


def test_pairs_in_large_template_families(spark):
    # Two documents share 700 + n of 850 shingles each: 0.751 to 0.80 for these n.
    size, planted = 1200, 80
    texts = [t for seed in range(2) for t in template(seed, size, (29, 33, 40, 55), planted)]
    places = list(range(len(texts)))
    random.Random(5).shuffle(places)
    want = {places[i]: places[i] for i in range(len(texts))}
    for start in range(0, len(texts), size):
        for i in range(start, start + 2 * planted, 2):
            want[places[i]] = want[places[i + 1]] = min(places[i], places[i + 1])
    rows = list(zip(places, texts, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(superminhash.near_groups(df), {i: (850, c) for i, c in want.items()})


def edited(seed, size):
    """Copies of one text with 0 to 12 of 300 words changed: some are far from most others."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    base = [word() for _ in range(300)]
    out = []
    for _ in range(size):
        words = list(base)
        for at in rng.sample(range(300), rng.randrange(13)):
            words[at] = word()
        out.append(" ".join(words))
    return out


def test_candidates_of_a_large_group_grow_with_its_rows(spark, monkeypatch):
    made = {}
    store = superminhash.materialize

    def counted(df, label):
        out = store(df, label)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(superminhash, "materialize", counted)
    rows = list(enumerate(edited(3, 300)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(superminhash.near_groups(df), brute(df.collect()))
    assert 0 < made["candidates"] + made.get("hub-pairs", 0) < 2 * len(rows)


def test_messy_rows(messy, empty):
    unique = messy.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check(superminhash.near_groups(unique), brute(unique.collect()))
    rows = superminhash.near_groups(messy).collect()
    assert len(rows) == messy.count()
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    kept = superminhash.drop_near_copies(messy)
    assert kept.columns == messy.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    assert superminhash.near_groups(empty).count() == 0


def test_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 99), (101, 99), (7, 200)]
    random.Random(2).shuffle(pairs)
    df = spark.createDataFrame(pairs, "leader long, id long")
    got = {r.id: r.component for r in superminhash.components(df).collect()}
    want = dict.fromkeys(range(61), 0) | {99: 99, 100: 99, 101: 99, 200: 0}
    assert got == want


@pytest.mark.parametrize("size", [1, 3, 40, 700])
def test_signatures_estimate_similarity(size):
    rng = np.random.default_rng(size)
    a = np.unique(rng.integers(0, 2**63, 4 * size).astype(np.uint64))
    sets = [a, a[: 3 * len(a) // 4], a[-1:]]
    sig = superminhash.signatures([*sets, *sets[::-1]])
    assert (sig[:3] == sig[3:][::-1]).all()
    assert abs((sig[0] == sig[1]).mean() - len(sets[1]) / len(a)) < 0.15


def test_signature_equals_the_sequential_algorithm():
    def plain(elements, slots):
        found = np.full(slots, np.uint64((1 << 64) - 1))
        for e in elements:
            order = list(range(slots))
            for j in range(slots):
                random_ = superminhash.mix(np.array([e]), 2 * j + 2)
                k = j + (int(random_[0] >> np.uint64(32)) * (slots - j) >> 32)
                order[j], order[k] = order[k], order[j]
                value = np.uint64(j << 48) | (superminhash.mix(random_, 1)[0] >> np.uint64(16))
                found[order[j]] = min(found[order[j]], value)
        return found

    rng = np.random.default_rng(9)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 5, 30)]
    got = superminhash.signatures(sets, 24)
    for s, row in zip(sets, got, strict=True):
        assert (plain(s, 24) == row).all()
