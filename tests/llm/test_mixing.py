from collections import Counter

import pytest

from cardsentry.llm import mixing


def test_target_weights_are_met_and_runs_agree(docs):
    rows = [(i, "x" * 20, "en", "big" if i % 3 else "small") for i in range(3000)]
    out = mixing.mix_sources(docs(rows), {"big": 1.0, "small": 3.0}).collect()
    share = Counter(r.source for r in out)
    assert abs(len(out) - 3000) < 250
    assert abs(share["small"] / len(out) - 0.75) < 0.03
    again = mixing.mix_sources(docs(rows[::-1]), {"big": 1.0, "small": 3.0}).collect()
    assert [(r.doc_id, r.copy_no) for r in out] == [(r.doc_id, r.copy_no) for r in again]
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    # copies are Poisson: mean and variance of the count agree
    n = Counter(r.doc_id for r in out if r.source == "small")
    counts = [n[i] for i in range(0, 3000, 3)]
    mean = sum(counts) / len(counts)
    assert abs(sum((c - mean) ** 2 for c in counts) / len(counts) / mean - 1) < 0.2


def test_high_rates_are_not_capped(docs):
    rows = [(i, "x" * 9, "en", "many") for i in range(400)] + [(1000, "x" * 9, "en", "one")]
    out = Counter(r.source for r in mixing.mix_sources(docs(rows)).collect())
    assert abs(out["one"] - 200.5) < 60 and abs(out["many"] - 200.5) < 60


def test_nulls_repeats_clashes_and_empty(docs):
    rows = [(1, None, "en", None), (1, None, "en", None), (None, "abc", None, "a"), (2, "", "en", "a")]
    out = mixing.mix_sources(docs(rows).selectExpr("*", "7 as copy_no", "8 as rate", "9 as cdf"), epochs=20.0)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "rate", "cdf", "copy_no", "shuffle_key"}
    n = Counter((r.doc_id, r.copy_no) for r in out.collect())
    assert all(v == 2 for (i, _), v in n.items() if i == 1)  # repeated rows draw alike
    assert mixing.mix_sources(docs([])).collect() == []
    with pytest.raises(ValueError):
        mixing.mix_sources(docs(rows), {"other": 1.0})
