import random
import re

from cardsentry.llm import secrets as S
from tests.llm.conftest import rows_of


def plain(text):
    """Spans of all rules, by a plain scan with Python's expressions."""
    out = []
    for rank, rule in enumerate(S.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), rank, rule.kind, m.end()))
    return sorted(out)


def spans(row):
    return [(s.start, s["rank"], s.kind, s.stop) for s in row.spans]


def test_queries_are_met_by_every_match():
    known = {r.kind: S.trigram_query(r.pattern) for r in S.RULES}
    assert known["hex"] == S.ANY
    assert known["access"] == frozenset([frozenset(["aki", "kia"])])
    assert frozenset(["tok", "oke", "ken"]) in known["assign"] and len(known["assign"]) == 6
    found = {
        "assign": "Api_KEY = 12345678", "access": "AKIA" + "A1" * 8, "github": "ghp_" + "a" * 36, "slack": "xoxb-" + "1" * 20,
        "pem": "-----BEGIN RSA PRIVATE KEY-----", "jwt": "eyJabc.eyJdef.ghi",
    }
    for kind, text in found.items():
        assert re.search(next(r.pattern for r in S.RULES if r.kind == kind), text)
        held = {text.lower()[i:i + 3] for i in range(len(text) - 2)}
        assert any(q <= held for q in known[kind])


def test_spans_equal_a_plain_scan(docs):
    rng = random.Random(8)
    bits = ["password", "PassWD", "token", "secret", "api_key", "apikey", "API-key", '"', "'", " ", "  ", ":", "=", "==", "abcdefgh",
            "ABC12345+/", "short", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "deadbeef" * 4, "é", "漢", "\n", "\t", "ghp_", "x" * 40,
            "xoxb-", "1-2-3-4-5-6-7-8-9-0", "-----BEGIN PRIVATE KEY-----", "eyJ", ".", "ſecret=12345678", "toKen:abcdefgh"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for i in range(300)}
    texts |= {400: None, 401: "", 402: "secret: password: abcdefgh", 403: "word " * 50_000 + "token=abcdefghijk"}
    out = rows_of(S.with_spans(docs(texts.items())))
    assert {i: spans(r) for i, r in out.items()} == {i: plain(t) for i, t in texts.items()}
    # what the index rules out would not have matched
    kept = {r.id: set(r.kinds) for r in S.candidates(docs(texts.items()).select("doc_id", "text"), S.RULES).collect()}
    for i, t in texts.items():
        assert {k for _, _, k, _ in plain(t)} - {"hex"} <= kept.get(i, set())


def test_redaction_replaces_every_span(docs):
    rows = [(1, "a token=abcdefgh1 b"), (2, "secret=" + "ab" * 16), (3, None), (4, "é 漢 AKIAABCDEFGH1234."), (5, "clean")]
    out = rows_of(S.redacted(docs(rows)))
    assert [out[i].text for i in range(1, 6)] == ["a [assign] b", "[assign]", None, "é 漢 [access].", "clean"]
    assert out[4].n_chars == len(out[4].text) and out[5].n_chars == 5 and out[3].n_chars is None


def test_missing_and_repeated_ids_clashes_and_empty(docs):
    t = "token=abcdefgh"
    table = docs([(1, t), (1, t), (None, t), (1, "none")]).selectExpr("*", "1 as spans", "2 as kinds", "3 as id", "4 as key")
    out = S.with_spans(table).collect()
    assert sorted(len(r.spans) for r in out) == [0, 1, 1, 1] and out[0].asDict().keys() >= {"kinds", "id", "key"}
    assert S.with_spans(docs([])).collect() == []
    only = S.with_spans(docs([(1, "ab" * 16)]), (S.Rule("hex", "[0-9a-f]{32,}", 32),)).collect()
    assert spans(only[0]) == [(0, 0, "hex", 32)]


def test_very_many_matches_of_one_text(docs):
    import time

    bits = ["token=abcdefgh1 ", "é", "AKIAABCDEFGH1234 ", "pass ", "0123456789abcdef" * 2 + "\n", "secret: short "]
    rng = random.Random(2)
    texts = {n: "".join(rng.choice(bits) for _ in range(n)) for n in (250, 256, 257, 511, 1025, 60_000)}
    start = time.time()
    out = rows_of(S.with_spans(docs(texts.items())))
    assert time.time() - start < 60
    assert {i: spans(r) for i, r in out.items()} == {i: plain(t) for i, t in texts.items()}
    assert len(spans(out[60_000])) > 25_000
