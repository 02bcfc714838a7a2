"""Forest keys have no SQL twin: check them by invariants."""

import pytest
from pyspark.sql import functions as F

from cardsentry.plans.catalog import Inputs, queries
from cardsentry.operators import model as M
from cardsentry.plans import q_ml

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


def test_train_score_invariants(inputs):
    out = q_ml.ml_train_score(inputs)
    rows = out.collect()
    assert rows, "test split is empty"
    for r in rows:
        assert 0.0 <= r.fraud_probability <= 1.0
        assert r.is_fraud_pred in (0, 1)
        assert r.risk_level in ("LOW", "MEDIUM", "HIGH", "CRITICAL")
    n_test = q_ml._split_rows(inputs).where("is_test").count()
    assert len(rows) == n_test


def test_importances_and_roundtrip(inputs):
    imp = q_ml.ml_feature_importance(inputs).collect()
    assert len(imp) == 10
    assert all(a.importance >= b.importance for a, b in zip(imp, imp[1:]))
    rt = q_ml.ml_roundtrip(inputs)
    assert rt.where(~F.col("same")).count() == 0 and rt.count() > 0


def test_model_run_row(inputs):
    r = q_ml.ml_model_run(inputs).first()
    assert r.num_trees == 100 and r.max_depth == 10 and 0 <= r.recall <= 1


def test_feature_names_cover_vector(inputs):
    from cardsentry.operators import prep

    model = q_ml._fitted(inputs)
    width = q_ml.prep_matrix_shape(inputs).first().width
    assert len(prep.feature_names(model)) == width


def test_registry_exposes_ml_keys():
    assert {"ml_train_score", "ml_feature_importance", "ml_roundtrip", "ml_model_run"} <= set(queries())


def test_a_trained_model_scores_after_an_observed_write(spark, inputs):
    """Writes of the stored tables are observed; the session then cannot be
    sent to a task, so a model that scores must not hold it."""
    from pyspark.sql.observation import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    model = q_ml._fitted(inputs)
    assert not model.stages[-1].hasSummary
    assert M.score(model, q_ml._split_rows(inputs)).count() > 0
