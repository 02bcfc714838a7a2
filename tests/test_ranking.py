import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.operators.prep import stratified_split
from cardsentry.operators.ranking import exact_quantiles, hash_rank_flag


def _data(n, seed, hot=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.choice(["a", "b"])
        v = round(rng.uniform(0, 500), 2)
        if hot is not None and i % 3 == 0:
            v = hot  # one value holds a third of all rows
        rows.append((g, v))
    return rows


@pytest.mark.parametrize("buckets", [7, 64])
@pytest.mark.parametrize("hot", [None, 123.45])
def test_exact_quantiles_match_numpy(spark, buckets, hot):
    rows = _data(3000, 1, hot)
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, names, buckets=buckets).collect()}
    for g in ("a", "b"):
        vals = np.array([v for gg, v in rows if gg == g])
        for name, p in zip(names, probs):
            assert got[g][name] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_exact_quantiles_ungrouped_and_tiny(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,)], "v double")
    r = exact_quantiles(df, [], "v", [0.5, 0.25], ["m", "q"], buckets=4).first()
    assert r.m == 2.0 and r.q == 1.5
    one = spark.createDataFrame([(5.0,)], "v double")
    assert exact_quantiles(one, [], "v", [0.5], ["m"]).first().m == 5.0


def test_stratified_split_matches_brute_force(spark):
    rows = [(f"T{i}", 1 if i % 7 == 0 else 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "trans_num string, is_fraud int")
    got = {r.trans_num: r.is_test for r in stratified_split(df, "is_fraud").collect()}
    for label in (0, 1):
        keys = [k for k, y in rows if y == label]
        keys.sort(key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
        k = int(0.2 * len(keys) + 0.5)
        expected = set(keys[:k])
        assert {t for t in keys if got[t]} == expected
    assert len(got) == len(rows)  # train and test together are all rows


def test_split_is_repeatable_and_seeded(spark):
    df = spark.createDataFrame([(f"T{i}", i % 2) for i in range(400)], "trans_num string, is_fraud int")
    a = sorted(r.trans_num for r in stratified_split(df).where("is_test").collect())
    b = sorted(r.trans_num for r in stratified_split(df).where("is_test").collect())
    c = sorted(r.trans_num for r in stratified_split(df, seed=7).where("is_test").collect())
    assert a == b and a != c and len(a) == 80


def test_auto_buckets_bound_the_in_bucket_window():
    from cardsentry.operators.ranking import BUCKET_TARGET_VALUES, MAX_BUCKETS, auto_buckets

    assert auto_buckets(0) == 256 and auto_buckets(1000) == 256
    for widest in (256 * BUCKET_TARGET_VALUES + 1, 10**10, 3 * 10**9 + 7):
        b = auto_buckets(widest)
        assert b & (b - 1) == 0 and widest / b <= BUCKET_TARGET_VALUES
    assert auto_buckets(10**15) == MAX_BUCKETS


def test_null_group_is_kept(spark):
    from cardsentry.operators import prep

    rows = [(None if k % 5 == 0 else k % 2, float(k), f"t{k}") for k in range(100)]
    df = spark.createDataFrame(rows, "label int, v double, key string")
    split = hash_rank_flag(df, ["label"], F.md5("key"), "key", F.round(F.col("_n") * 0.2), "is_test")
    assert split.count() == 100 and split.where("label is null and is_test").count() == 4
    q = {r.label: r.med for r in exact_quantiles(df, ["label"], "v", [0.5], ["med"]).collect()}
    assert set(q) == {None, 0, 1} and q[None] == 47.5
    w = prep.with_class_weights(df.withColumnRenamed("label", "is_fraud")).collect()
    assert len(w) == 100 and {r.weight for r in w if r.is_fraud is None} == {100 / (3 * 20)}
