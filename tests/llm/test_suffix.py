import random

import numpy as np
import pytest

from cardsentry.llm import lyndon, suffix
from tests.llm.conftest import rows_of


def digest(row):
    import hashlib
    return row.n_bytes, row.n_bytes - len(row.kept), len(row.spans), hashlib.sha256(row.kept).hexdigest()


@pytest.mark.parametrize("letters", ["ab", "abcdefgh \0"])
def test_suffix_order_is_lexicographic(letters):
    rng = random.Random(3)
    for _ in range(60):
        strings, lanes = [], []
        for lane in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 4)):
                strings.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 30))).encode())
                lanes.append(lane)
        s = lyndon.Strings(strings, np.array(lanes))
        true = sorted((lanes[k], t[i:], k, int(s.begin[k]) + i) for k, t in enumerate(strings) for i in range(len(t)))
        assert lyndon.suffix_order(s).tolist() == [x[3] for x in true]


def passage(rng, n):
    return "".join(rng.choice("abcdefghij é") for _ in range(n))


def test_cut_repeats_equals_window_by_window(docs, monkeypatch):
    monkeypatch.setattr(suffix, "LANE", 4)  # some lanes are dealt by windows
    rng = random.Random(5)
    shared = [passage(rng, n) for n in (99, 100, 130, 400)]
    texts = {i: passage(rng, rng.randint(0, 300)) for i in range(40)}
    for i in range(0, 40, 2):
        texts[i] = passage(rng, rng.randint(0, 60)) + rng.choice(shared) + texts[i] + rng.choice(shared)
    texts[50], texts[51] = texts[0], texts[0][:-5] + "x"          # an exact and a near copy
    texts[52] = "z" * 1000                                         # repeats itself
    texts[53], texts[54] = None, ""
    texts[55] = shared[3] * 3
    for i in range(60, 80):                                        # a common line in changing surroundings
        texts[i] = passage(rng, 40) + shared[1][:60] + passage(rng, 40)
    out = rows_of(suffix.cut_repeats(docs(texts.items())))
    true = suffix.brute_force(texts)
    assert {k: digest(r) for k, r in out.items()} == true


def test_long_texts_are_cut_into_segments(docs, monkeypatch):
    rng = random.Random(6)
    long = passage(rng, 700)
    monkeypatch.setattr(suffix, "SEGMENT", 150)
    whole = suffix.text_runs(np.frombuffer(long.encode(), np.uint8))
    assert int(whole[2].sum()) == len(long.encode()) - suffix.WINDOW + 1
    texts = {1: long, 2: "q" + long, 3: long[300:]}
    monkeypatch.undo()
    out = rows_of(suffix.cut_repeats(docs(texts.items())))
    assert {k: digest(r) for k, r in out.items()} == suffix.brute_force(texts)


def test_repeated_and_missing_ids_are_ordered_after_their_id(docs):
    rng = random.Random(7)
    t = passage(rng, 200)
    out = suffix.cut_repeats(docs([(1, t), (1, t), (None, t), (2, t + "x")])).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0, len(r.kept)) for r in out)
    # rows equal in id and text are one document and keep it; all others come later
    assert kept == [(False, 1, len(t.encode())), (False, 1, len(t.encode())), (False, 2, 1), (True, 0, 0)]


def test_empty_table_and_clashing_columns(docs, spark):
    assert suffix.cut_repeats(docs([])).collect() == []
    clash = docs([(1, "a")]).selectExpr("*", "1 as key", "2 as hash", "3 as marks")
    assert len(suffix.cut_repeats(clash).collect()) == 1
