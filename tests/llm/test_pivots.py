import hashlib
import math

import numpy as np

from cardsentry.llm import pivots as P

TABLE = "vec_id bigint, embedding array<float>"


def truth(rows, k=16, rounds=3):
    """Every vector against every centroid, in whole numbers of Python."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in e]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = [sum(x) // len(g) for x in zip(*g)]
    rows = [(i, *near(v)) for i, v in kept]
    inertia = lambda j: sum(d for _, d, c in rows if j in (None, c))
    sha = lambda j: hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()
    return sorted([(i, j, d, inertia(j), inertia(None), sha(j)) for i, d, j in rows], key=str)


def got(df):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    spots = rng.normal(size=(9, 64))
    out = []
    for i in range(n):
        v = spots[0] if i % 3 == 0 else spots[rng.integers(9)] + rng.normal(size=64) * rng.choice([0, 0.01, 0.3])
        out.append((1000 - i, [float(x) for x in v]))
    return out


def test_nearest_equals_all_distances_and_skips_many():
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.integers(-9, 9, (300, 64)), rng.integers(-9, 9, (300, 64)) + 80, np.zeros((5, 64), int)])
    c = np.concatenate([v[:6], v[:2], v[300:306], -v[3:4]])  # some centroids twice
    pivots = P.spread_out(v[::20], 8)
    own, best, taken = P.nearest(v, P.to_pivots(v, pivots), c, P.to_pivots(c, pivots))
    every = ((v[:, None] - c[None]) ** 2).sum(2)
    assert (own == every.argmin(1)).all() and (best == every.min(1)).all()
    assert taken < 0.7 * every.size


def test_far_values_are_exact():
    v = np.full((3, 64), 2**27 - 1, np.int64) * np.array([[1], [-1], [0]])
    c = -v
    pivots = v[:2]
    own, best, _ = P.nearest(v, P.to_pivots(v, pivots), c, P.to_pivots(c, pivots))
    assert own.tolist() == [1, 0, 2] and best.tolist() == [0, 0, 0]
    assert P.exact(v[:1], v[1]) == [64 * (2**28 - 2) ** 2]


def test_equals_plain_clustering(spark):
    rows = vectors(1, 400)
    assert got(P.summary(spark.createDataFrame(rows, TABLE))) == truth(rows)


def test_odd_vectors_repeated_ids_and_clashes(spark):
    rows = vectors(2, 30)
    one = rows[0][1]
    odd = [(1, None), (2, []), (3, one[:63]), (4, one + [1.0]), (5, [*one[:63], None]), (6, [*one[:63], math.nan]), (7, [*one[:63], math.inf])]
    more = [rows[1], (rows[1][0], rows[2][1]), (None, one), (None, [0.0] * 64)]
    table = spark.createDataFrame(rows + odd + more, TABLE).selectExpr("*", "1 as id", "2 as ints", "'c' as cluster", "3 as distance")
    assert got(P.summary(table)) == truth(rows + odd + more)


def test_few_vectors_none_and_the_range(spark):
    for rows in (vectors(3, 5), [(1, [0.25] * 64)] * 20, [(None, [1.0] * 64)]):
        assert got(P.summary(spark.createDataFrame(rows, TABLE))) == truth(rows)
    for rows in ([], [(1, None)], [(1, [3e6] * 64)]):
        out = P.summary(spark.createDataFrame(rows, TABLE))
        assert out.collect() == [] and len(out.columns) == 6
