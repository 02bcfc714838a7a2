import random

import numpy as np
from tokenizers import Tokenizer

from cardsentry.llm import bpe
from cardsentry.llm.common import read
from tests.llm.conftest import rows_of

PATH = bpe.vocabulary_path()


def odd_texts():
    rng = random.Random(0)
    parts = list("ab'st  \n\t\r ​\x85\x1c\x1d\x0b19²½Ⅷé漢字ßſK!?.") + [
        "<|endoftext|>", "<|endoftext|", "'s", "'re", "'ll've", "  ", " \n", "Hello", " world", "́", "\U0001f600", "　", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += [f"a{chr(i)}{chr(i)}1 {chr(i)}" for i in range(0x30000) if not 0xD800 <= i < 0xE000 and (i < 0x3100 or i % 31 == 0)]
    return texts + ["", "a" * 5000 + "bc" * 300, "!" * 400, " " * 300 + "x", "é" * 2000, "word " * 20_000]


def test_encoding_equals_the_library():
    texts, codec = odd_texts(), bpe.Codec(PATH)
    encoded = codec.encode_all(texts)
    wanted = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for t, got, want in zip(texts, encoded, wanted):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, t
        assert codec.decode(got) == t


def test_cuts_stand_only_where_no_token_joins():
    codec = bpe.Codec(PATH)
    joined = codec.joined.reshape(256, 256)
    for token in list(codec.ids)[::50]:
        assert all(joined[a, b] for a, b in zip(token, token[1:]))
    assert not joined[ord("a"), ord(" ")]
    ids, counts = codec.encode_pieces([b"abc", b" abc", b"x" * 200])
    assert len(ids) == counts.sum() and (counts > 0).all()


def test_small_caches_change_nothing(monkeypatch):
    texts = odd_texts()[:600]
    want = bpe.Codec(PATH).encode_all(texts)
    monkeypatch.setattr(bpe, "CACHE", 10)
    assert bpe.Codec(PATH).encode_all(texts) == want


def test_query_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    out = rows_of(bpe.op7_bpe(spark, "/root/testdata/sf0.001"))
    for r in read(spark, "/root/testdata/sf0.001", "documents").collect():
        got = out[r.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == bpe.reference_digest(r.text, tokenizer)


def test_nulls_repeats_clashes_and_empty(docs):
    table = docs([(1, None), (2, ""), (3, "hi"), (3, "hi"), (None, "hi")]).selectExpr("*", "1 as ids", "2 as row")
    got = bpe.with_text(bpe.with_ids(table), out="back").collect()
    assert [len(r.ids) // 4 for r in got] == [0, 0, 1, 1, 1] and [r.back for r in got] == ["", "", "hi", "hi", "hi"]
    assert set(got[0].asDict()) >= {"row", "ids", "back", "text"}
    once = bpe.with_round_trip(table).collect()
    assert [(r.ids, r.decoded) for r in once] == [(r.ids, r.back) for r in got] and "row" in once[0].asDict()
    assert bpe.with_ids(docs([])).collect() == [] and bpe.with_round_trip(docs([])).collect() == []
