"""Centroid clustering with a LAESA pivot table and exact integer distances.

Vectors become integers, so that no order of summation changes a result. The
distances of every vector to a few fixed pivots are computed once and stored
with it. In each round the distances of the centroids to the pivots are taken,
and by the triangle inequality the largest difference of two such distances is
at most the distance of vector and centroid. Only centroids whose bound is not
above the best distance so far get an exact integer distance; bounds are
loosened by more than double rounding can amount to, and ties survive.

Each task adds up its vectors per centroid before anything is shuffled: a
cluster that holds most rows costs no more than a small one. The driver sees
the centroids and their sums, whose number the parameters bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import col, read
from cardsentry.sources.storage import materialize

# Fixed values of the contract.
SIZE, SCALE = 64, 64
CENTROIDS, ROUNDS = 16, 3
# Pivots, and the vectors of smallest hash that they are chosen from.
PIVOTS, CHOICE = 8, 64
# Beyond this a squared distance need not fit 64 bits.
WIDEST = 2.0**21
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has SIZE components, all finite and within the range
    in which distances fit 64 bits."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(WIDEST), F.lit(False)))
    return F.coalesce((F.size(vector) == SIZE) & fine, F.lit(False))


def exact(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of integer vectors, exact."""
    d = v - c
    return np.einsum("...i,...i->...", d, d)


def to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([exact(v, p) for p in pivots], axis=1).astype(np.float64))


def nearest(v: np.ndarray, d: np.ndarray, centroids: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of each vector's nearest centroid (the smaller of equal ones),
    its squared distance, and how many exact distances that took.

    ``d`` and ``gaps`` are the distances of vectors and centroids to the pivots.
    """
    low = np.zeros((len(v), len(centroids)))
    for p in range(gaps.shape[1]):
        both = np.add.outer(d[:, p], gaps[:, p])
        np.maximum(low, np.abs(np.subtract.outer(d[:, p], gaps[:, p])) - SLACK * both, out=low)
    first = low.argmin(axis=1)
    own, best = first.copy(), exact(v, centroids[first])
    taken = len(v)
    for c in range(len(centroids)):
        todo = np.flatnonzero((low[:, c] <= np.sqrt(best) * (1 + SLACK)) & (first != c))
        taken += len(todo)
        found = exact(v[todo], centroids[c])
        nearer = (found < best[todo]) | ((found == best[todo]) & (c < own[todo]))
        own[todo[nearer]], best[todo[nearer]] = c, found[nearer]
    return own, best, taken


def spread_out(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` vectors, each far from those before it."""
    chosen = [0] if len(vectors) else []
    far = exact(vectors, vectors[0]) if len(vectors) else np.zeros(0)
    while len(chosen) < n and far.any():
        chosen.append(int(far.argmax()))
        far = np.minimum(far, exact(vectors, vectors[chosen[-1]]))
    return vectors[chosen]


def _matrix(column: pd.Series, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), width)


@dataclass(frozen=True)
class Clustering:
    """``points`` (id, v, d): every kept vector with its distances to the pivots;
    the centroids after the last round; ``rows`` (id, cluster, distance)."""

    points: DataFrame
    pivots: np.ndarray
    centroids: np.ndarray
    rows: DataFrame


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, d) of ``vectors`` (id, ints): components and pivot distances as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.array(b["ints"].tolist(), np.int64).reshape(len(b), SIZE)
            d = to_pivots(v, pivots)
            yield pd.DataFrame({"id": b["id"], "v": [r.tobytes() for r in v.astype(np.int32)], "d": [r.tobytes() for r in d]})

    return vectors.mapInPandas(run, "id string, v binary, d binary")


def _assigned(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every point."""
    gaps = to_pivots(centroids, pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _matrix(b["v"], np.int32, SIZE).astype(np.int64)
            own, best, _ = nearest(v, _matrix(b["d"], np.float64, len(pivots)), centroids, gaps)
            yield pd.DataFrame({"id": b["id"], "cluster": own.astype(np.int32), "distance": best})

    return points.mapInPandas(run, "id string, cluster int, distance bigint")


def _moved(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    gaps = to_pivots(centroids, pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for b in batches:
            v = _matrix(b["v"], np.int32, SIZE).astype(np.int64)
            own, _, _ = nearest(v, _matrix(b["d"], np.float64, len(pivots)), centroids, gaps)
            np.add.at(sums, own, v)
            n += np.bincount(own, minlength=len(n))
        some = np.flatnonzero(n)
        if len(some):
            yield pd.DataFrame({"cluster": some.astype(np.int32), "n": n[some], "sums": list(sums[some])})

    parts = points.mapInPandas(run, "cluster int, n bigint, sums array<bigint>")
    parts = parts.select("cluster", "n", F.posexplode("sums").alias("i", "x"))
    total = parts.groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in total.collect():  # centroids times components
        moved[r.cluster, r.i] = int(r.x) // int(r.n)
    return moved


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, n_pivots: int = PIVOTS) -> Clustering | None:
    """Cluster ``vectors`` (vec_id, embedding); None if no vector is usable.

    Vectors that are null, of another length, hold null or non-finite
    components, or a component of 2 ** 21 or more, are left out. Centroids start
    as the ``k`` vectors with the smallest sha256 of ``1:<vec_id>`` (equal ids by
    components; rows without an id after all others). Rows that repeat an id are
    vectors of their own. Fewer vectors than ``k`` give fewer centroids. Other
    columns are ignored.
    """
    vector = col("embedding")
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    kept = vectors.where(usable(vector)).select(col("vec_id").cast("string").alias("id"), ints.alias("ints"))
    smallest = F.sha2(F.concat(F.lit("1:"), "id"), 256).asc_nulls_last()
    start = kept.orderBy(smallest, "ints").limit(max(k, CHOICE)).select("ints").collect()
    if not start:
        return None
    heads = np.array([r.ints for r in start], np.int64)
    pivots, centroids = spread_out(heads, n_pivots), heads[:k]
    points = materialize(pivot_table(kept, pivots), "pivot-table")
    for _ in range(rounds):
        centroids = _moved(points, centroids, pivots)
    rows = materialize(_assigned(points, centroids, pivots), "pivot-clusters")
    return Clustering(points, pivots, centroids, rows)


def summary(vectors: DataFrame, **more: int) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every kept vector; an empty table if there is none."""
    spark = vectors.sparkSession
    found = cluster(vectors, **more)
    kind = dict(vectors.dtypes)["vec_id"]
    if found is None:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()
    total = sum(int(r.x) for r in sums)
    each = spark.createDataFrame([(r.cluster, int(r.x), total, digests[r.cluster]) for r in sums], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # a row for each centroid, k at most
    return found.rows.join(F.broadcast(each), "cluster").select(
        F.col("id").cast(kind).alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance, inertia and final centroid of every vector."""
    return summary(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    fine = "len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x) and abs(x) < 2097152)) = 64"
    parts = [f"""v as (select row_number() over () as r, vec_id,
        list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as c from embeddings where {fine}),
      c0 as (select row_number() over (order by sha256('1:' || vec_id) nulls last, c) - 1 as cluster, c from v
        qualify cluster < {CENTROIDS})"""]
    near = """select r, v.c, min((list_sum(list_transform(list_zip(v.c, k.c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::bigint,
      cluster)) as best from v cross join c{0} k group by all"""
    for i in range(ROUNDS):
        parts.append(f"""a{i} as ({near.format(i)}),
          e{i} as (select best[2] as cluster, unnest(c) as x, unnest(range({SIZE})) as i from a{i}),
          t{i} as (select cluster, i, sum(x)::bigint as s, count(*) as n from e{i} group by all),
          m{i} as (select cluster, list((s - ((s % n) + n) % n) // n order by i) as c from t{i} group by cluster),
          c{i + 1} as (select cluster, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} using (cluster))""")
    parts.append(f"""z as (select vec_id, best[2]::int as cluster, best[1] as distance
      from ({near.format(ROUNDS)}) join v using (r))""")
    return f"""with {', '.join(parts)} select vec_id, z.cluster, distance,
      sum(distance) over (partition by z.cluster)::bigint as cluster_inertia, sum(distance) over ()::bigint as inertia,
      sha256(array_to_string(c{ROUNDS}.c, ',')) as centroid_sha256 from z join c{ROUNDS} on c{ROUNDS}.cluster = z.cluster"""


OP13_SQL = _sql()
