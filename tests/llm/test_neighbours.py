import numpy as np
import pandas as pd

from cardsentry.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def truth(rows):
    n, ok = {}, {}
    for i, v, label in rows:
        a = None if v is None or label is None else np.array([np.nan if x is None else np.float32(x) for x in v], float)
        ok[i] = a is not None and len(a) and np.isfinite(a).all() and a.any()
        n[i] = a / np.linalg.norm(a) if ok[i] else None
    label = {i: x for i, _, x in rows}
    links = {i: [j for j in n if i != j and ok[i] and ok[j] and label[i] == label[j] and len(n[i]) == len(n[j]) and n[i] @ n[j] >= 0.98] for i in n}
    comp = {}
    for i in sorted(n):
        todo = [i] if i not in comp else []
        while todo:
            x = todo.pop()
            if x not in comp:
                comp[x] = i
                todo += links[x]
    return {i: (len(links[i]), comp[i]) for i in n}


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows], SCHEMA)


def test_links_and_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAF", 16)
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "PIECE", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=24), int(i % 3)) for i in range(300)]
    for i in range(300, 420):  # near copies, a chain and a large group
        j = int(rng.integers(0, 30)) if i < 360 else 7
        rows.append((i, rows[j][1] + rng.normal(size=24) * 0.02, rows[j][2]))
    rows += [(500 + k, rows[7][1], rows[7][2]) for k in range(20)]
    rows += [(600, None, 1), (601, np.zeros(24), 1), (602, [None] * 24, 1), (603, [np.nan] + [1.0] * 23, 1), (604, rows[0][1], None),
             (605, [np.inf] * 24, 1), (606, [], 1), (607, rows[0][1][:12], 0), (608, rows[0][1], 0), (609, rows[0][1] * 3, 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(table(spark, rows)).collect()}
    assert got == truth(rows)


def planted_vectors(n, seed, size=24):
    """Vectors of which a third belong to one hot component (a slow drift), a
    sixth to pairs and small groups, and the others to none."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.normal(size=size))
    hot = [unit(centre + rng.normal(size=size) * 0.035) for _ in range(n // 3)]
    few = []
    while len(few) < n // 6:
        base = unit(rng.normal(size=size))
        few += [unit(base + rng.normal(size=size) * 0.015) for _ in range(rng.integers(2, 7))]
    rest = unit(rng.normal(size=(n - len(hot) - len(few), size)))
    every = [*hot, *few, *rest]
    order = rng.permutation(len(every))
    return [(int(k), every[j].tolist(), 0 if j < len(hot) else int(j % 2)) for k, j in enumerate(order)]


def recall(rows, got):
    """(true links, share of them whose ends share a component, mean share per
    vector with links), every pair of a label compared."""
    label = np.array([r[2] for r in rows])
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    comp = np.array([got[r[0]] for r in rows])
    links, found, each = 0, 0, []
    for a in range(0, len(rows), 1000):
        near = (v[a:a + 1000] @ v.T >= N.THRESHOLD) & (label[a:a + 1000, None] == label)
        near[np.arange(len(near)), np.arange(a, a + len(near))] = False
        same = near & (comp[a:a + 1000, None] == comp)
        links, found = links + int(near.sum()), found + int(same.sum())
        n = near.sum(axis=1)
        each += (same.sum(axis=1)[n > 0] / n[n > 0]).tolist()
    return links, found / links, float(np.mean(each))


def test_recall_of_planted_links(spark):
    rows = planted_vectors(3000, 4)
    got = {r.vec_id: r.component_id for r in N.near_vectors(table(spark, rows)).collect()}
    links, share, mean = recall(rows, got)
    assert links > 10_000 and share > 0.9 and mean > 0.9
    assert all(got[i] <= i for i in got)


def test_the_test_table_holds_no_link_and_none_is_found(spark):
    sf = "/root/testdata/sf0.01"
    raw = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = truth([(r.vec_id, r.embedding, r.label) for r in raw])
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.op10_neighbours(spark, sf).collect()}
    assert got == want and not any(n for n, _ in want.values())


def test_an_audit_without_links_measures_nothing(spark):
    rows = [(i, [float(x) for x in np.eye(6)[i]], i, "0:6") for i in range(6)]
    tagged = spark.createDataFrame(rows, "id bigint, v array<double>, comp bigint, space string")
    found, missed = N.audit(tagged, 0)
    assert found is None and missed.collect() == []


def test_repeated_and_missing_ids_clashes_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)]
    out = N.near_vectors(table(spark, rows).selectExpr("*", "1 as id", "2 as v", "3 as space")).collect()
    assert sorted((r.vec_id is None, r.vec_id, r.n_links) for r in out if r.vec_id) == [(False, 1, 1), (False, 1, 1), (False, 2, 0)]
    assert len(out) == 4
    assert N.near_vectors(table(spark, [])).collect() == []


def test_groups_of_sorted_batches():
    batches = [pd.DataFrame({"k": [1, 1, 2]}), pd.DataFrame({"k": []}), pd.DataFrame({"k": [2, 2, 3]}), pd.DataFrame({"k": [4]})]
    assert [g["k"].tolist() for g in N.groups_of(iter(batches), ["k"])] == [[1, 1], [2, 2, 2], [3], [4]]


def nested(rng, groups, members, first, label):
    """Sub-groups whose members are much closer to each other than to those of
    other sub-groups, but link with all of them."""
    base = rng.normal(size=24)
    base /= np.linalg.norm(base)
    rows = []
    for _ in range(groups):
        own = rng.normal(size=24)
        own = base + 0.08 * own / np.linalg.norm(own)
        rows += [(first + len(rows) + i, own * (1 + i) + rng.normal(size=24) * 1e-4, label) for i in range(members)]
    return rows


def test_sub_groups_of_more_than_k_copies_stay_together(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAF", 16)
    rng = np.random.default_rng(5)
    rows = nested(rng, 2, 7, 100, 0) + nested(rng, 50, 8, 1000, 1) + [(5000 + i, rng.normal(size=24), 1) for i in range(200)]
    want = truth(rows)
    assert {want[i][1] for i in range(100, 114)} == {100} and {want[i][1] for i in range(1000, 1400)} == {1000}
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(table(spark, rows)).collect()}
    assert got == want


def test_a_search_that_finds_little_is_completed(spark, monkeypatch):
    for name, x in (("LEAF", 2), ("ROUNDS", 0), ("TRIES", 1), ("BLOCK", 64)):
        monkeypatch.setattr(N, name, x)
    leaves = N.split_leaves
    monkeypatch.setattr(N, "split_leaves", lambda classes, seed: leaves(classes, seed, splits=1))
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=24), 0) for i in range(300)]
    rows += [(300 + i, rows[i][1] + rng.normal(size=24) * 0.1, 0) for i in range(300)]
    rows += [(1000 + i, rows[0][1] * (2 + i), 0) for i in range(200)]  # a hot group does not hide lost pairs
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(table(spark, rows)).collect()}
    assert got == truth(rows)


def test_large_leaves_are_dealt_differently_in_each_split(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.eye(24)[0] + rng.normal(size=24) * 1e-6], i, "0:24") for i in range(900)]
    classes = spark.createDataFrame(rows, "id bigint, v array<double>, comp bigint, space string")
    part = {(r.split, r.id): (r.leaf, r.part) for r in N.split_leaves(classes, seed=0).collect()}
    met = [{(a, b) for a in range(100) for b in range(a) if part[s, a] == part[s, b]} for s in (0, 1)]
    assert met[0] and met[1] and met[0] != met[1]
