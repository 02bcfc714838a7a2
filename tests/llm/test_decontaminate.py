import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from cardsentry.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def truth(docs, items, window=10):
    out = []
    for i, text in docs:
        w = words_of(text)
        hit, names = set(), set()
        for item, t in items:
            v = words_of(t)
            n = min(window, len(v))
            windows = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1 if v else 0):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    names |= {str(item)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((None if i is None else str(i), len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def got(found):
    return sorted((tuple(r) for r in found.summary().collect()), key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    return D.find_contamination(d, spark.createDataFrame(items, "item_id bigint, text string"), **more)


def test_words_and_shingles_follow_the_rule():
    texts = ["Ab-c\x7fÄ9 a", "", "x y z", "!!", "a"]
    w = D.Words.of([t.encode() for t in texts])
    assert [[w.join(i, i + 1) for i in np.flatnonzero(w.text == k)] for k in range(5)] == [words_of(t) for t in texts]
    assert w.first.tolist() == [0, 4, 4, 6, 6]
    at, token = w.shingles(2)
    assert at.tolist() == [0, 1, 2, 4]  # none across texts
    again = D.Words.of(["zz AB C q".encode()]).shingles(2)[1]
    assert token[0] in again and token[1] not in again
    assert len(D.Words.of([b"", b"?"]).shingles(3)[0]) == 0
    assert len(D.Words.of([b"w " * 300_000]).hash) == 300_000


def test_filter_holds_every_token(spark):
    rng = np.random.default_rng(1)
    tokens = rng.integers(-2**63, 2**63 - 1, 3000)
    kept = D.bloom(spark.createDataFrame([(int(t), 5) for t in tokens], "token bigint, width int"))
    assert kept.widths == [5] and kept.table.any()
    for i in D._places(tokens.view(np.uint64), kept.bits):
        assert (kept.table[(i >> np.uint64(3)).astype(int)] >> (i & np.uint64(7)).astype(np.uint8) & 1).all()
    assert np.unpackbits(kept.table).sum() <= 4 * 3000


@pytest.fixture(scope="module")
def planted():
    """Documents of common words that hold windows of items, whole or cut."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "x1"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = text(14)  # a passage that many items and documents share
    items = [(k, text(rng.choice([1, 3, 4, 5, 6, 9, 10, 11, 25, 60]))) for k in range(40)]
    items = [(k, w + shared + text(3) if k % 3 == 0 else w) for k, w in items]
    items += [(3, text(12)), (None, text(20)), (90, []), (91, ["only", "twice"] * 12), (91, ["only"])]
    docs = []
    for i in range(150):
        w = text(rng.choice([0, 1, 4, 9, 30, 120]))
        for _ in range(rng.randrange(3)):
            _, v = rng.choice(items)
            a = rng.randrange(max(1, len(v) - 8)) if v else 0
            cut = rng.randrange(len(w) + 1)
            w[cut:cut] = v[a:a + rng.choice([8, 9, 10, 11, 40])]
        if i % 3 == 0:
            w += shared + shared[:9]
        docs.append((i, (", " if i % 2 else "\n").join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(7, "a second row"), (None, " ".join(shared)), (None, None), (300, None), (301, ""), (302, "- ?"), (303, "only twice " * 400)]
    return docs, [(k, " ".join(w)) for k, w in items] + [(95, None), (96, "?!")]


def test_equals_every_window_of_every_item(spark, planted):
    docs, items = planted
    want = truth(docs, items)
    assert sum(r[-1] for r in want) > 50 and sum(not r[-1] for r in want) > 20
    assert got(run(spark, docs, items)) == want


def test_other_windows_and_shingles(spark, planted):
    docs, items = planted
    assert got(run(spark, docs[:40], items, window=6, shingle=2)) == truth(docs[:40], items, 6)


def test_spans_name_the_items(spark):
    item = [f"a{i}" for i in range(12)]
    found = run(spark, [(1, "x " + " ".join(item[:10]) + " y"), (2, " ".join(item[:9]))], [(5, " ".join(item)), (6, " ".join(item[:10]))])
    assert sorted(map(tuple, found.spans().collect())) == [("1", "5", 1, 11), ("1", "6", 1, 11)]


def test_empty_tables_and_clashes(spark):
    docs = [(1, "a b"), (2, None)]
    assert got(run(spark, docs, [])) == truth(docs, [])
    assert got(run(spark, [], [(1, "a")])) == []
    d = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string").selectExpr("*", "1 as key", "2 as token", "'q' as item_id", "3 as pos")
    i = spark.createDataFrame([(9, "b c")], "item_id bigint, text string").selectExpr("*", "1 as doc_id", "2 as item", "0 as segment")
    assert got(D.find_contamination(d, i)) == truth([(1, "a b c")], [(9, "b c")])


def test_sql_equals_every_window(planted):
    docs, items = planted
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    rows = [(None if r[0] is None else str(r[0]), *r[1:]) for r in con.execute(D.OP12_SQL).fetchall()]
    assert sorted(rows, key=str) == truth(docs, items)
