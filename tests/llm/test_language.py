import zlib

import numpy as np
import pytest

from cardsentry.llm import language as L
from cardsentry.llm.common import read

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    net = L.Network.fresh(["a", "b", "c"])
    net.inputs, net.states = [x.astype(float) for x in net.inputs], [x.astype(float) for x in net.states]
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    rng = np.random.default_rng(0)
    b, y, w = rng.integers(0, 256, (9, 5)).astype(np.uint8), np.array([0, 1, 2, 1, 0]), np.ones(5)
    used = np.ones((9, 5))
    used[-3:, 2] = 0
    _, grads = L.gradients(net, b, used, y, w)
    for p, g in zip(net.parameters(), grads):
        for _ in range(3):
            at = tuple(int(rng.integers(0, s)) for s in p.shape)
            if p.shape[1] == 256:
                at = (at[0], int(b[4, 2]))
            old, found = p[at], []
            for e in (1e-2, -1e-2):
                p[at] = old + e
                found.append(L.gradients(net, b, used, y, w)[0])
            p[at] = old
            assert (found[0] - found[1]) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=1e-4)


def test_held_out_accuracy_and_whole_texts(spark):
    docs = read(spark, SF, "documents")
    out = {r.doc_id: r for r in L.op3_language(spark, SF).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(out[r.doc_id].held_out for r in held) and len(out) == docs.count()
    right = np.mean([out[r.doc_id].lang_pred == r.lang for r in held])
    assert right > 0.9
    # every position counts: the mean over halves is the mean over the whole
    net = L.train([("a", "xyz " * 60), ("b", "uvw " * 60)], epochs=2)
    t = "xyz " * 16 * 4 + "uvw " * 16 * 4
    whole, first, second = L.document_probabilities(net, [t, t[:256], t[256:]])
    assert whole == pytest.approx((first + second) / 2, abs=1e-4)


def test_und_nulls_repeats_and_clashes(docs):
    net = L.train([("a", "abc " * 50), ("b", "xyz " * 50)], epochs=2)
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "abc abc"), (4, "abc abc"), (None, "é" * 100_000)]
    out = L.with_language(docs(rows).selectExpr("*", "1 as score", "2 as label", "3 as row"), net)
    got = out.collect()
    assert len(got) == 6 and out.columns.count("score") == 1
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert got[3].lang_pred == got[4].lang_pred in "ab" and all(0 <= r.score <= 1 for r in got)
    assert L.with_language(docs([]), net).collect() == []
    nothing = L.fit_languages(docs([(1, None), (2, "x", None)]))
    assert [r.lang_pred for r in L.with_language(docs([(1, "abc")]), nothing).collect()] == ["und"]


def test_letters_are_those_of_any_script_and_nothing_else(docs):
    net = L.train([("a", "abc " * 50), ("b", "xyz " * 50)], epochs=2)
    texts = ["½ ² 12", "Ⅷ ㊀", "_", "漢", "ß", "1a"]
    out = {r.doc_id: r.lang_pred for r in L.with_language(docs(list(enumerate(texts))), net).collect()}
    assert [out[i] == "und" for i in range(6)] == [True, True, True, False, False, False]


def test_many_labels_and_bounded_stretches(docs, spark):
    from pyspark.sql import functions as F

    from cardsentry.llm.sampling import bounded_sample

    rows = [(i, f"text {i} é" * 40, f"l{i % 70}") for i in range(700)]
    net = L.fit_languages(docs(rows))
    assert len(net.languages) == 70
    known = docs(rows).select("doc_id", "lang")
    few = bounded_sample(known, docs(rows), "lang", 5, most_rows=90)
    assert len(few) == 90 and len({lang for lang, _ in few}) == 70
    assert few == bounded_sample(known, docs(rows), "lang", 5, most_rows=90)
    texts = {0: "", 1: "a", 2: "x" * 64, 3: "é" * 33, 4: "y" * 256, 5: "é" * 5000}
    cut = docs(texts.items()).select("doc_id", "text", L.some_stretches(F.col("text"), F.col("doc_id")).alias("s"))
    for r in cut.collect():
        raw = texts[r.doc_id].encode()
        every = [raw[k:k + 64] for k in range(0, len(raw), 64)]
        got = [bytes(x) for x in r.s]
        assert got == every if len(every) <= 4 else (1 <= len(got) <= 4 and set(got) <= set(every))
