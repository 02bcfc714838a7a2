import math
import random
import re
import zlib
from collections import Counter

from cardsentry.llm import quality as Q
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, trusted, buckets, threshold):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    grams = {i: [zlib.crc32(g.encode()) % buckets for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]] for i, w in words.items()}
    raw, good = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in trusted:
            good.update(g)
    n_raw, n_good = sum(raw.values()) + buckets, sum(good.values()) + buckets
    ratio = [round(math.log((good[b] + 1) / n_good / ((raw[b] + 1) / n_raw)) * 1e6) for b in range(buckets)]
    out = {}
    for i, t in texts.items():
        w, t = words[i], t or ""
        windows = Counter(zip(w, w[1:], w[2:]))
        repeat = {j + k for j, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        out[i] = (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat), failed,
            not failed and sum(ratio[b] for b in grams[i]) >= threshold * len(grams[i]),
        )
    return out


def test_rules_and_verdicts_equal_a_plain_count(docs, spark):
    rng = random.Random(9)
    texts = {}
    for i in range(120):
        pool = [f"w{k}" for k in range(rng.choice([4, 40, 400]))] + ["é|", "#a", "\n", "\t", "\x0b"]
        if i % 3 == 0:
            pool = [w + "$$" for w in pool]
        texts[i] = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 150)))
    texts |= {200: None, 201: "", 202: "\n\n a \n a\n a ", 203: "one two three " * 40, 204: "\xa0x y " * 60, 205: "v " * 30_000}
    trusted = [i for i in range(120) if i % 3]
    table = spark.createDataFrame([(i,) for i in trusted + trusted[:5]], "doc_id bigint")
    out = rows_of(Q.quality_verdicts(docs(texts.items()), table, buckets=512, threshold=-50_000))
    got = {i: tuple(r)[1:8] for i, r in out.items()}
    assert got == plain(texts, set(trusted), 512, -50_000)
    assert {g[-1] for g in got.values()} == {True, False}


def test_good_labels_are_kept_and_junk_is_not(spark):
    sf = "/root/testdata/sf0.1"
    from cardsentry.llm.common import read
    label = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    rows = [r for r in Q.op9_quality(spark, sf).collect() if r.doc_id in label and not r.base_failed]
    assert all(r.kept for r in rows if label[r.doc_id]) and not any(r.kept for r in rows if not label[r.doc_id])


def test_no_trusted_rows_repeats_clashes_and_empty(docs, spark):
    none = spark.createDataFrame([(None,)], "doc_id bigint")
    table = docs([(1, "a " * 60), (1, "a " * 60), (None, "b c"), (2, None)]).selectExpr("*", "1 as words", "2 as ratio")
    out = Q.quality_verdicts(table, none).collect()
    assert len(out) == 4 and {r.n_words for r in out} == {60, 2, 0}
    assert Q.quality_verdicts(docs([]), none).collect() == []


def test_texts_are_read_by_compiled_steps(docs, spark):
    """Per character or per comparison, interpreted steps cost more than the CPU budget."""
    edges = [(1, " \t a  b\x0bc\f "), (2, "#*$%&|<>]^-\\ [x]"), (3, "a b c a b c"), (4, "\r\n"), (5, "\xa0\n\xa0\n \n x")]
    table = Q.base_features(docs(edges))
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("translate(", "array_sort(", "arrays_zip("))
    got = {r.doc_id: tuple(r)[1:] for r in table.collect()}
    assert got == {
        1: (["a", "b", "c"], 3, 3, 0, 0, 0), 2: (["#*$%&|<>]^-\\", "[x]"], 2, 15, 8, 0, 0),
        3: (["a", "b", "c"] * 2, 6, 6, 0, 0, 6), 4: ([], 0, 0, 0, 0, 0), 5: (["\xa0", "\xa0", "x"], 3, 3, 0, 1, 0),
    }
