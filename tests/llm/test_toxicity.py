import zlib

from cardsentry.llm import toxicity as T
from cardsentry.llm.common import read

SF = "/root/testdata/sf0.01"


def test_misspelt_words_share_vectors():
    rows = [(i % 2, f"word{i} some plain text here" + (" you horrible person" if i % 2 else "")) for i in range(300)]
    model = T.train(rows)
    scorer = T.Scorer(model.logits(), model.offset())
    plain, known, unseen = scorer.score_all(["some plain text here", "a horrible thing", "a horribble thing"])
    assert plain < 0.5 < unseen and known > 0.5


def test_a_few_words_in_a_long_text_are_found():
    rows = [(i % 2, f"text{i} " * 3 + "plain words here" + (" horrible" if i % 2 else "")) for i in range(300)]
    model = T.train(rows)
    scorer = T.Scorer(model.logits(), model.offset())
    long = " ".join(f"plain{i}" for i in range(20_000))
    clean, toxic = scorer.score_all([long, long + " horrible horribly horrible"])
    assert toxic > clean and toxic > 0.5


def test_all_rows_are_scored_and_folds_agree(spark):
    out = {r.doc_id: r for r in T.op5_toxicity(spark, SF).collect()}
    docs = read(spark, SF, "documents").collect()
    assert set(out) == {r.doc_id for r in docs}
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_rows_are_not_learned_from(spark, docs):
    rows = [(i, "good text " + ("evil" if i % 2 else "fine")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(400)], "doc_id bigint, toxic int")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    wrong = spark.createDataFrame([(i, int(i % 2) ^ int(held(i))) for i in range(400)], "doc_id bigint, toxic int")
    a = {r.doc_id: r.score for r in T.score_toxicity(docs(rows), labels).collect()}
    b = {r.doc_id: r.score for r in T.score_toxicity(docs(rows), wrong).collect()}
    assert a == b
    assert all((a[i] >= 0.5) == bool(i % 2) for i in a if held(i))


def test_nulls_repeats_clashes_and_empty(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    table = docs([(1, None), (1, None), (None, "x"), (2, ""), (3, "a")]).selectExpr("*", "1 as score", "2 as toxic")
    out = T.score_toxicity(table, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert T.score_toxicity(docs([]), labels).collect() == []
    assert len(T.score_toxicity(table, labels.limit(0)).collect()) == 5
