"""Run history: append-only records, stage changes, and the champion they give."""

from cardsentry.operators.runs import RunHistory
from cardsentry.sources.storage import new_location

RUN = "run_id string, recall double, precision double, f1_score double, meets_requirements boolean"


def test_champion_follows_the_stage_changes(spark):
    root = new_location(spark, "runs")
    h = RunHistory.open(spark, root)
    runs = spark.createDataFrame([("a", 0.90, 0.8, 0.85, True), ("b", 0.95, 0.8, 0.87, True), ("c", None, 0.8, 0.9, True),
                                  ("d", 0.5, 0.5, 0.5, False)], RUN)
    assert h.record(runs, {"numTrees": 100}) == 4
    assert h.record(runs.selectExpr("run_id", "0.0 as recall", "precision", "f1_score", "meets_requirements")) == 0
    assert {r.run_id: r.should_deploy for r in h.decide().collect()} == dict.fromkeys("abcd", True)  # none in production
    assert h.champion().collect() == []
    assert h.promote("zzz") is False and h.promote("a") is True and h.promote("a") is False
    again = RunHistory.open(spark, root)  # another job
    got = {r.run_id: (r.champion_run_id, r.should_deploy, r.reason) for r in again.decide().collect()}
    assert got == {"b": ("a", True, "better performance"), "c": ("a", True, "comparison failed"),
                   "d": ("a", False, "not better enough")}
    assert again.promote("b") is True
    stages = {r.run_id: r.stage for r in again.current().collect()}
    assert stages == {"a": "Archived", "b": "Production", "c": None, "d": None}
    assert [r.run_id for r in again.champion().collect()] == ["b"] and again.champion().first().params == {"numTrees": "100"}
    log = sorted((r.run_id, r.stage, r.step, r.until) for r in again.stage_log().collect())
    assert log == [("a", "Archived", 2, None), ("a", "Production", 1, 2), ("b", "Production", 2, None)]
    assert again.promote("a") is True  # an archived run comes back
    assert {r.run_id: r.stage for r in again.current().collect()}["b"] == "Archived"
