"""The trainer on compact rows: MLlib's trees where nothing is drawn, and no dense rows."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from cardsentry.operators import forest
from cardsentry.operators import model as M
from cardsentry.operators import prep as P
from cardsentry.schemas import NUMERIC_FEATURES


def made(spark, n=3000, merchants=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = pd.DataFrame({c: rng.normal(size=n) for c in NUMERIC_FEATURES})
    rows["hour"], rows["is_night"] = rng.integers(0, 24, n), 1.0  # few values; one value
    rows["merchant"] = [f"m{k:06d}" for k in rng.integers(0, merchants, n)]
    rows["category"] = rng.choice(["a", "b", "c"], n)
    rows["gender"] = rng.choice(["F", "M"], n)
    rows["state"] = [None if k == 0 else f"s{k}" for k in rng.integers(0, 5, n)]
    score = rows["amt"] + 0.7 * rows["age"] + (rows["category"] == "b") + 0.5 * rng.normal(size=n)
    rows["is_fraud"] = (score > 1).astype(float)
    rows["trans_num"] = [f"t{k}" for k in range(n)]
    df = spark.createDataFrame(rows).repartition(3, "trans_num")
    return P.with_class_weights(df, "is_fraud").cache()


def text_of(tree) -> str:
    text = re.sub(r"uid=\w+", "", tree.toDebugString)
    return re.sub(r"-?\d+\.\d{5,}(E-?\d+)?", lambda m: f"{float(m[0]):.6f}", text)


@pytest.mark.parametrize("block", [forest.BLOCK, 200])
def test_without_draws_the_tree_is_that_of_mllib(spark, monkeypatch, block):
    rows = made(spark)
    monkeypatch.setattr(forest, "BLOCK", block)
    given = {"num_trees": 1, "bootstrap": False, "feature_subset_strategy": "all", "max_depth": 5}
    ours = M.train(rows, config=M.ForestConfig(dense_numbers=0, **given))
    theirs = M.train(rows, config=M.ForestConfig(**given))
    a, b = ours.stages[-1], theirs.stages[-1]
    assert text_of(a.trees[0]) == text_of(b.trees[0]) and a.trees[0].numNodes > 10
    assert " in {" in a.trees[0].toDebugString and "<=" in a.trees[0].toDebugString
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())
    both = M.score(ours, rows).select("trans_num", F.col("fraud_probability").alias("p")).join(M.score(theirs, rows), "trans_num")
    assert both.where(F.abs(F.col("p") - F.col("fraud_probability")) > 1e-9).count() == 0 and both.count() == 3000


def test_a_forest_draws_bags_and_slots_and_learns(spark, tmp_path):
    rows = made(spark)
    config = M.ForestConfig(num_trees=20, max_depth=6, dense_numbers=0)
    model = M.train(rows, config=config)
    fitted = model.stages[-1]
    assert fitted.getNumTrees == 20 and len({text_of(t) for t in fitted.trees}) == 20
    assert not fitted.hasSummary and fitted.numClasses == 2 and fitted.numFeatures == P.vector_width(model)
    path = M.save(model, str(tmp_path / "m"))
    nodes = spark.read.parquet(f"{path}/stages/*RandomForest*/data")
    roots = [r[0] for r in nodes.where("nodeData.id = 0").select("nodeData.rawCount").collect()]
    assert len(set(roots)) > 10 and abs(np.mean(roots) - 3000) < 60  # rows drawn as many times as there are rows
    assert nodes.agg(F.min("nodeData.rawCount")).first()[0] >= config.min_instances_per_node
    again = M.train(rows, config=config)
    assert [text_of(t) for t in again.stages[-1].trees] == [text_of(t) for t in fitted.trees]
    scored = M.score(M.load(path), rows, keep=["trans_num", "is_fraud"])
    assert scored.where("is_fraud = is_fraud_pred").count() > 2400
    mllib = M.train(rows, config=M.ForestConfig(num_trees=20, max_depth=6))
    assert M.feature_importance(model, 2)[0][0] == M.feature_importance(mllib, 2)[0][0] == "amt"


def test_many_merchants_are_not_made_dense(spark, monkeypatch):
    """18,000 rows by their merchants are above the numbers that MLlib is given."""
    def refused(self, dataset, params=None):
        raise AssertionError("trained on dense rows")

    monkeypatch.setattr(RandomForestClassifier, "fit", refused)
    rows = made(spark, n=18_000, merchants=200_000)
    model = M.train(rows, config=M.ForestConfig(num_trees=3, max_depth=3))
    assert P.vector_width(model) > 16_000
    assert M.score(model, rows).where("fraud_probability between 0 and 1").count() == 18_000


def test_unsound_rows_are_refused(spark):
    rows = made(spark, n=50)
    config = M.ForestConfig(num_trees=1, max_depth=2, dense_numbers=0)
    for name, value in (("is_fraud", None), ("is_fraud", 0.5), ("weight", -1.0), ("weight", float("nan"))):
        with pytest.raises(Exception, match="must"):
            M.train(rows.withColumn(name, F.lit(value).cast("double")), config=config)


def test_drawn_slots_are_those_of_mllib():
    given = {"all": 945, "sqrt": 31, "onethird": 315, "log2": 10, "7": 7, "0.5": 473, "auto": 31}
    assert {k: forest.drawn_slots(k, 945, 100) for k in given} == given
    assert forest.drawn_slots("auto", 945, 1) == 945
