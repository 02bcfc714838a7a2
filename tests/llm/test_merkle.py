import hashlib
import random
import zlib

import pytest

from cardsentry.llm import merkle as M
from tests.llm.conftest import DOCS


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    out = []
    for v in (row[0], row[3], row[2], row[4], text):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return H(*out)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    """[(left siblings, right siblings)] upwards."""
    out = []
    for level in tree[:-1]:
        a = i // 16 * 16
        out.append((level[a:i], level[i + 1:a + 16]))
        i //= 16
    return out


def truth(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = levels([leaf(r, r[1]) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            way = path(trees[s], i) + path(top, k)
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(r, text)
            for a, b in way:
                now = H(*a, now, *b)
            root = top[-1][0]
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], root, H(*[x for a, b in way for x in a + b]), now, now == root))
    return sorted(out, key=str)


def got(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def sample(n, sources, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = sources[0] if rng.random() < 1 / 3 else rng.choice(sources)
        out.append((i * 7 % 1009 + 10**15, rng.choice(["Ab c", "x", "É Z", "", None, "Q" * 50]), rng.choice(["en", None]), source, rng.choice([None, 3])))
    return out


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_equals_a_plain_tree_at_every_stride(spark, stride):
    rows = sample(700, ["big", None, "", "ü", "Z", "a,b"] + [f"s{i:03}" for i in range(40)])
    out = got(M.audited(table(spark, rows), stride))
    assert out == truth(rows)
    assert any(not r[-1] for r in out) and any(r[-1] for r in out)


def test_run_borders(spark):
    for n in (1, 2, 16, 17, 256, 257):
        rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
        assert got(M.audited(table(spark, rows))) == truth(rows)


def test_repeated_rows_null_ids_clashes_and_empty(spark):
    rows = [(5, "A", "en", "s", 1)] * 20 + [(5, "B", "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 2 + [(None, "T", "x", "s", 0)]
    clash = table(spark, rows).selectExpr("*", "1 as tree", "2 as hash", "'y' as pos", "3 as at", "4 as others", "5 as copy")
    assert got(M.audited(clash)) == truth(rows)
    assert M.audited(table(spark, [])).collect() == []


def test_proofs_lead_to_the_root_and_wrong_ones_do_not(spark):
    rows = sample(60, ["a", "b"])
    manifest = M.document_manifest(table(spark, rows))
    found = manifest.proofs(["doc"]).collect()
    assert len(found) == 60
    for r in found:
        assert M.fold(r.leaf, r["at"], r.others) == r.roots[1]
        assert M.fold(H(r.leaf), r["at"], r.others) != r.roots[1]


def test_changing_one_row_changes_only_its_source_and_the_root(spark):
    rows = sample(80, ["a", "b", "c"])
    one = {r.doc_id: r for r in M.audited(table(spark, rows)).collect()}
    k = next(i for i, r in enumerate(rows) if r[3] == "b")
    other = {r.doc_id: r for r in M.audited(table(spark, rows[:k] + [(*rows[k][:1], "new", *rows[k][2:])] + rows[k + 1:])).collect()}
    source = {r[0]: r[3] for r in rows}
    for i, r in one.items():
        assert (r.subroot == other[i].subroot) == (source[i] != "b") and r.root != other[i].root
        assert (r.leaf == other[i].leaf) == (i != rows[k][0])


def test_test_table_equals_the_plain_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert got(M.audited(docs)) == truth(rows)
