import random

import numpy as np

from cardsentry.llm import minhash as M
from cardsentry.llm.components import connected_components
from cardsentry.llm.textwords import shingle_set, word_hashes
from tests.llm.conftest import rows_of


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in "".join(c.lower() if c.isascii() else c for c in text).split(" ") if w]


def truth(texts, near):
    """{id: (set size, smallest id reachable)}, all pairs compared as strings."""
    sets = {}
    for i, t in texts.items():
        w = words_of(t or "")
        k = min(near.words, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in texts}
    find = lambda i: i if root[i] == i else find(root[i])
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= near.percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_words_and_sets_follow_the_rule():
    assert len(word_hashes("a\tB\nc\x0bd\x0ce\rf  g".encode())) == 7
    assert (shingle_set("The End Ä", 3) == shingle_set("the eND\n Ä ", 3)).all()
    assert not (shingle_set("x Ä", 3) == shingle_set("x ä", 3)).any()  # only A-Z are lowered
    assert len(shingle_set("a b", 3)) == 1 and len(shingle_set(" \n", 3)) == 0 and len(shingle_set(None, 3)) == 0
    t = "w " * 100_000
    assert len(shingle_set(t, 3)) == 1


def test_sketch_bins_agree_about_as_often_as_the_sets_overlap():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 2**63, 1200).astype(np.uint64) * np.uint64(2))
    for n, both in ((1000, 900), (40, 36), (12, 11)):
        a, b = np.sort(pool[:n]), np.sort(pool[n - both: 2 * n - both])
        same = np.mean(M.sketch([a])[0] == M.sketch([b])[0])
        assert abs(same - both / (2 * n - both)) < 0.2
    assert (M.sketch([pool[:1]])[0] == pool[0]).all()


def test_components_equal_all_pairs(docs):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(60):
        texts[i] = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 40, 200])))
    for i in range(60, 160):  # copies, some with a few changed words, some in chains
        w = texts[rng.randrange(i)].split(" ")
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts[i] = " ".join(w).upper() if i % 7 == 0 else " ".join(w)
    texts |= {200: None, 201: "", 202: " \n", 203: "", 204: "one", 205: "ONE", 206: "Ä", 207: "ä"}
    for near in (M.Near(3, 85), M.Near()):
        out = rows_of(M.near_components(docs(texts.items()), near))
        assert {i: (r.n_shingles, r.component_id) for i, r in out.items()} == truth(texts, near)


def test_a_large_group_of_near_copies(docs):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    texts = {}
    for i in range(300):
        w = list(base)
        w[rng.randrange(300)] = f"new{i}"
        texts[1000 - i] = " ".join(w)
    out = rows_of(M.near_components(docs(texts.items()), M.Near(3, 85)))
    assert {r.component_id for r in out.values()} == {701}


def test_pairs_of_one_template_far_from_every_centre(docs):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(100):  # two texts of a pair differ from all others in the same words
        w = list(base)
        for j in rng.sample(range(0, 400, 4), 3):
            w[j] = f"own{i}x{j}"
        for k in range(2):
            v = list(w)
            for j in rng.sample(range(2, 400, 4), 5):
                v[j] = f"new{i}x{k}x{j}"
            texts[2 * i + k] = " ".join(v)
    near = M.Near(3, 85)
    want = truth(texts, near)
    assert 80 < len({c for _, c in want.values()})
    out = rows_of(M.near_components(docs(texts.items()), near))
    assert {i: (r.n_shingles, r.component_id) for i, r in out.items()} == want


def test_repeated_and_missing_ids_clashes_and_empty(docs):
    t = " ".join(f"w{i}" for i in range(30))
    table = docs([(5, t), (5, t), (None, t), (3, t + " x"), (7, None)])
    out = M.near_components(table.selectExpr("*", "1 as band", "2 as digest", "3 as id")).collect()
    got = sorted(((r.doc_id, r.component_id) for r in out), key=str)
    assert len(got) == 5 and got.count((5, 3)) == 2 and (3, 3) in got and (7, 7) in got
    assert M.near_components(docs([])).collect() == []


def test_rows_that_share_an_id_are_told_apart(docs):
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    rows = [(0, a), (0, b), (0, c), (0, text()), (0, text()), (3, a + " x"), (4, "y " + b), (5, d), (5, d), (2, c)]
    rows += [(7, ""), (7, ""), (8, None), (None, a), (0, "a b"), (0, "A B")]
    table = docs(rows).selectExpr("*", "1 as key_id", "'t' as row", "2 as first")
    kept = M.first_of_groups(table)
    assert kept.columns == table.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    gone = [(3, a + " x"), (4, "y " + b), (5, d), (2, c)]
    # of equal sets under one id a single text stays
    one = [x for x in got if x in [(0, "a b"), (0, "A B")]]
    assert len(one) == 1
    want = [r for r in rows if r not in gone and r not in [(0, "a b"), (0, "A B")]] + [(5, d)] + one
    assert got == sorted(want, key=str)
    found = {(r.doc_id, r.text_hash): r.component_id for r in M.near_groups(table).where("doc_id is not null").collect()}
    assert sorted(found.values()) == [0] * 10 + [5, 7, 8]


def test_bands_suit_the_similarity():
    for percent in (50, 70, 80, 85, 95):
        r = M.Near(5, percent).band_rows
        assert (1 - (percent / 100) ** r) ** (256 // r) < 3e-4
    assert M.Near(3, 85).band_rows == 8 and M.Near().band_rows == 7


def test_connected_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(500, i) for i in range(501, 600)] + [(500, 500), (502, 501), (900, None)]
    out = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert out == {i: 1 for i in range(1, 201)} | {i: 500 for i in range(500, 600)}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []
