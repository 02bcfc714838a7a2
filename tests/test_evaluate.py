import pytest

from cardsentry.operators import evaluate as EV


def _df(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int")


def test_metrics_and_report(spark):
    pairs = [(1, 1)] * 8 + [(1, 0)] * 2 + [(0, 1)] * 4 + [(0, 0)] * 86
    m = EV.metrics(_df(spark, pairs)).first()
    assert m.recall == 0.8 and m.precision == pytest.approx(8 / 12, abs=1e-6)
    assert m.f1_score == pytest.approx(16 / 22, abs=1e-6) and m.accuracy == 0.94 and m.support == 100
    rep = {r.class_name: r for r in EV.classification_report(_df(spark, pairs)).collect()}
    assert rep["Fraud"].support == 10 and rep["Legitimate"].support == 90
    assert rep["Legitimate"].recall == pytest.approx(86 / 90, abs=1e-6)
    assert rep["macro avg"].recall == pytest.approx((0.8 + 86 / 90) / 2, abs=1e-6)
    cm = {(r.actual, r.predicted): r.n for r in EV.confusion_matrix(_df(spark, pairs)).collect()}
    assert cm == {(1, 1): 8, (1, 0): 2, (0, 1): 4, (0, 0): 86}


def test_no_predicted_positive_gives_zero(spark):
    m = EV.metrics(_df(spark, [(1, 0), (0, 0)])).first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1_score == 0.0
    g = EV.gates(EV.metrics(_df(spark, [(1, 0), (0, 0)]))).first()
    assert g.meets_requirements is False and g.failures == "recall,precision,f1_score"


RUNS = "run_id string, stage string, recall double, precision double, f1_score double, meets_requirements boolean"


def _decide(spark, rows):
    return {r.run_id: (r.should_deploy, r.reason) for r in
            EV.champion_challenger(spark.createDataFrame(rows, RUNS)).collect()}


def test_champion_absent(spark):
    d = _decide(spark, [("new", None, 0.5, 0.5, 0.5, False)])
    assert d["new"] == (True, "no production model")


def test_champion_rules(spark):
    champ = ("prod", "Production", 0.90, 0.80, 0.85, True)
    rows = [
        champ,
        ("equal", None, 0.90, 0.80, 0.85, True),
        ("better", None, 0.95, 0.79, 0.86, True),
        ("prec_drop_exact", None, 0.95, 0.75, 0.86, True),
        ("recall_gain_exact", None, 0.91, 0.80, 0.86, True),
        ("fails_gates", None, 0.99, 0.70, 0.90, False),
    ]
    d = _decide(spark, rows)
    assert d["equal"][0] is False
    assert d["better"] == (True, "better performance")
    # same float arithmetic as the original: 0.75 - 0.80 is -0.05000000000000004
    assert d["prec_drop_exact"][0] is (0.75 - 0.80 > -0.05)
    assert d["recall_gain_exact"][0] is (0.91 - 0.90 > 0.01)
    assert d["fails_gates"][0] is False


def test_latest_champion_only(spark):
    # two runs in the stage: the latest is the champion, and no challenger is duplicated
    rows = [("r1", "Production", 0.99, 0.99, 0.99, True), ("r2", "Production", 0.90, 0.80, 0.85, True),
            ("new", None, 0.95, 0.79, 0.86, True)]
    out = EV.champion_challenger(spark.createDataFrame(rows, RUNS)).collect()
    assert len(out) == 1 and out[0].champion_run_id == "r2" and out[0].should_deploy is True


def test_missing_champion_metrics_count_as_zero(spark):
    rows = [("prod", "Production", None, None, None, True), ("a", None, 0.95, 0.9, 0.9, True),
            ("b", None, 0.5, 0.5, 0.5, False)]
    d = _decide(spark, rows)
    assert d["a"] == (True, "better performance") and d["b"] == (False, "not better enough")
    # recall alone is missing: precision and F1 are compared
    d = _decide(spark, [("prod", "Production", None, 0.99, 0.95, True), ("a", None, 0.95, 0.80, 0.86, True)])
    assert d["a"] == (False, "not better enough")


def test_comparison_failure_uses_gates(spark):
    rows = [("prod", "Production", 0.9, 0.9, 0.9, True), ("a", None, None, 0.9, 0.9, True), ("b", None, None, 0.9, 0.9, False)]
    d = _decide(spark, rows)
    assert d["a"] == (True, "comparison failed") and d["b"] == (False, "comparison failed")


def test_gates_see_unrounded_metrics(spark):
    m = spark.createDataFrame([(0.8999996, 0.9, 0.9)], "recall double, precision double, f1_score double")
    g = EV.gates(m).first()
    assert g.recall == 0.9 and g.recall_ok is False and g.failures == "recall"
