from collections import Counter

import corpus_pipeline as P
from cardsentry.llm import minhash, secrets
from cardsentry.llm.common import read
from cardsentry.sources.storage import materialize
from tests.llm.test_minhash import truth
from tests.llm.test_secrets import plain

SF = "/root/testdata/sf0.01"


def test_each_stage_against_a_plain_version(spark):
    docs = read(spark, SF, "documents")
    seen = {}
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, SF), "test-stage")
        seen[name] = ({r.doc_id: r for r in docs.collect()}, out.collect())
        if name != "bpe":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["language"]
    assert len(after) > 0.98 * len(before)  # the documents are of the languages learned
    before, after = seen["near_dedup"]
    want = truth({i: r.text for i, r in before.items()}, minhash.Near())
    assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if c == i}
    before, after = seen["secrets"]
    assert len(after) == len(before)
    for r in after:
        assert not plain(r.text) and (r.text == before[r.doc_id].text) == (not plain(before[r.doc_id].text))
        assert r.n_chars == len(r.text)
    before, after = seen["mix"]
    share = Counter()
    for r in after:
        assert r == before[r.doc_id]
        share[r.source] += len(r.text) + 1
    assert 0.7 < sum(share.values()) / sum(len(r.text) + 1 for r in before.values()) < 1.3
    before, after = seen["bpe"]
    assert all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in after) and len(after) == sum(1 for _ in seen["mix"][1])


def test_rows_that_language_id_rejects_go(docs, spark):
    rows = [(i, f"the cat and the dog {i} were here", "en") for i in range(40)]
    rows += [(100 + i, f"der Hund und die Katze {i} waren hier", "de") for i in range(40)]
    out = P.identify(spark, docs(rows + [(200, "12 !!"), (201, None), (202, "")]), SF)
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows}


def test_workers_are_sent_long_texts_a_few_megabytes_at_a_time(docs, spark):
    table = docs([(i, "ab " * 40_000) for i in range(100)]).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield b[["text"]].map(len).agg(["sum"]).rename(columns={"text": "n"})

    with minhash.small_batches(spark):
        seen = [r.n for r in table.mapInPandas(sizes, "n bigint").collect()]
    assert sum(seen) == 12_000_000 and max(seen) < 5_000_000


def test_languages_are_told_in_small_batches(docs, spark):
    rows = [(i, f"the cat and the dog {i} were here", "en") for i in range(20)]
    rows += [(100 + i, f"der Hund und die Katze {i} waren hier", "de") for i in range(20)]
    out = P.identify(spark, docs(rows), SF)
    # nothing is left for a later write to run in batches of the session's size
    assert out.count() == 40 and "Python" not in out._jdf.queryExecution().toString()


def test_empty_input(docs, spark):
    table = docs([])
    for _, stage in P.STAGES:
        table = materialize(stage(spark, table, SF), "test-empty")
        assert table.count() == 0


def test_secrets_stage_uses_the_rules():
    assert {r.kind for r in secrets.BASE_RULES} == {"assign", "access", "hex"}
