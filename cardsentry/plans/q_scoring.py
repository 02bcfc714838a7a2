"""Registered score-shaping, filter and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardsentry.functions import scoring as S
from cardsentry.functions.numeric import round_binary
from cardsentry.operators import evaluate as EV
from cardsentry.operators import serving as SV
from cardsentry.operators.runs import RunHistory
from cardsentry.plans import reports as R
from cardsentry.plans.catalog import Inputs, register
from cardsentry.plans.q_quality import VALID_SQL, VIOLATIONS_SQL
from cardsentry.sources.storage import materialize, new_location
from cardsentry.sources.tables import FIXTURE_AGE_AS_OF, FIXTURE_REPORT_DATE

_RISK_SQL = ("CASE WHEN fraud_probability < 0.3 THEN 'LOW' WHEN fraud_probability < 0.6 THEN 'MEDIUM' "
             "WHEN fraud_probability < 0.8 THEN 'HIGH' ELSE 'CRITICAL' END")


@register("score_risk_level", f"SELECT trans_num, fraud_probability, {_RISK_SQL} AS risk_level FROM predictions")
def score_risk_level(i: Inputs):
    return i.predictions.select("trans_num", "fraud_probability",
                                S.risk_level(F.col("fraud_probability")).alias("risk_level"))


@register("score_risk_distribution",
          f"SELECT {_RISK_SQL} AS risk_level, count(*) AS n FROM predictions GROUP BY 1")
def score_risk_distribution(i: Inputs):
    return i.predictions.groupBy(S.risk_level(F.col("fraud_probability")).alias("risk_level")).agg(
        F.count(F.lit(1)).alias("n"))


@register("score_confidence",
          "SELECT trans_num, round(abs(fraud_probability - 0.5) * 2, 4) AS confidence FROM predictions")
def score_confidence(i: Inputs):
    return i.predictions.select("trans_num", S.confidence(F.col("fraud_probability")).alias("confidence"))


@register("score_transactions", f"""
SELECT trans_num, fraud_probability > 0.5 AS is_fraud, round(fraud_probability, 4) AS fraud_probability,
  {_RISK_SQL} AS risk_level, round(abs(fraud_probability - 0.5) * 2, 4) AS confidence,
  predicted_at AS scored_at
FROM predictions
""")
def score_transactions(i: Inputs):
    """Scoring output of a batch: label, rounded probability, risk level on
    the unrounded probability, confidence, time stamp."""
    p = F.col("fraud_probability")
    return i.predictions.select(
        "trans_num",
        S.above_threshold(p).alias("is_fraud"),
        round_binary(p, 4).alias("fraud_probability"),
        S.risk_level(p).alias("risk_level"),
        S.confidence(p).alias("confidence"),
        F.col("predicted_at").alias("scored_at"),
    )


@register("filter_predicted_fraud", "SELECT trans_num, fraud_probability FROM predictions WHERE is_fraud")
def filter_predicted_fraud(i: Inputs):
    return i.predictions.where(F.col("is_fraud")).select("trans_num", "fraud_probability")


@register("filter_alert_threshold",
          "SELECT trans_num, fraud_probability FROM predictions WHERE fraud_probability > 0.5")
def filter_alert_threshold(i: Inputs):
    return i.predictions.where(S.above_threshold(F.col("fraud_probability"))).select(
        "trans_num", "fraud_probability")


@register("filter_previous_day", f"""
SELECT trans_num, created_at FROM training_data
WHERE created_at >= DATE '{FIXTURE_REPORT_DATE.isoformat()}' - INTERVAL 1 DAY
  AND created_at < DATE '{FIXTURE_REPORT_DATE.isoformat()}'
""")
def filter_previous_day(i: Inputs):
    return i.training_data.where(R.previous_day("created_at", FIXTURE_REPORT_DATE)).select(
        "trans_num", "created_at")


# ------------------------------------------------------------ evaluation

_EVAL_SRC = """(SELECT p.is_fraud AS label, CAST(pred.is_fraud AS INTEGER) AS prediction,
    pred.fraud_probability AS p
  FROM predictions pred JOIN payments p ON pred.trans_num = p.trans_num) e"""
_COUNTS = f"""(SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
    CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
    CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
    CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn
  FROM {_EVAL_SRC}) c"""


def _r(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) ELSE 0.0 END"


_METRICS = f"""(SELECT round({_r('tp', 'tp + fn')}, 6) AS recall, round({_r('tp', 'tp + fp')}, 6) AS precision,
    round({_r('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score,
    round({_r('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy, tp + fp + tn + fn AS support
  FROM {_COUNTS}) m"""


def _eval_source(i: Inputs):
    pay = i.payments.select("trans_num", F.col("is_fraud").alias("label"))
    pred = i.predictions.select("trans_num", F.col("is_fraud").cast("int").alias("prediction"),
                                F.col("fraud_probability").alias("p"))
    return pred.join(pay, "trans_num")


@register("eval_confusion", f"""
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM {_COUNTS}
UNION ALL SELECT 0, 1, fp FROM {_COUNTS}
UNION ALL SELECT 1, 0, fn FROM {_COUNTS}
UNION ALL SELECT 1, 1, tp FROM {_COUNTS}
""")
def eval_confusion(i: Inputs):
    return EV.confusion_matrix(_eval_source(i))


@register("eval_metrics", f"SELECT * FROM {_METRICS}")
def eval_metrics(i: Inputs):
    return EV.metrics(_eval_source(i))


@register("eval_gates", f"""
SELECT recall, precision, f1_score, recall >= 0.9 AS recall_ok, precision >= 0.75 AS precision_ok,
  f1_score >= 0.8 AS f1_ok, recall >= 0.9 AND precision >= 0.75 AND f1_score >= 0.8 AS meets_requirements,
  concat_ws(',', CASE WHEN recall < 0.9 THEN 'recall' END, CASE WHEN precision < 0.75 THEN 'precision' END,
    CASE WHEN f1_score < 0.8 THEN 'f1_score' END) AS failures
FROM {_METRICS}
""")
def eval_gates(i: Inputs):
    return EV.gates(EV.metrics(_eval_source(i), decimals=None))


def _report_sql() -> str:
    p1, r1 = _r("tp", "tp + fp"), _r("tp", "tp + fn")
    p0, r0 = _r("tn", "tn + fn"), _r("tn", "tn + fp")
    f1, f0 = _r("2 * tp", "2 * tp + fp + fn"), _r("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fp + tn + fn)"
    return f"""
SELECT 0 AS row_order, 'Legitimate' AS class_name, round({p0}, 6) AS precision, round({r0}, 6) AS recall,
  round({f0}, 6) AS f1_score, tn + fp AS support FROM {_COUNTS}
UNION ALL SELECT 1, 'Fraud', round({p1}, 6), round({r1}, 6), round({f1}, 6), tp + fn FROM {_COUNTS}
UNION ALL SELECT 2, 'accuracy', NULL, NULL, round({_r('tp + tn', n)}, 6), {n} FROM {_COUNTS}
UNION ALL SELECT 3, 'macro avg', round((({p0}) + ({p1})) / 2, 6), round((({r0}) + ({r1})) / 2, 6),
  round((({f0}) + ({f1})) / 2, 6), {n} FROM {_COUNTS}
UNION ALL SELECT 4, 'weighted avg', round({_r(f'({p0}) * (tn + fp) + ({p1}) * (tp + fn)', n)}, 6),
  round({_r(f'({r0}) * (tn + fp) + ({r1}) * (tp + fn)', n)}, 6),
  round({_r(f'({f0}) * (tn + fp) + ({f1}) * (tp + fn)', n)}, 6), {n} FROM {_COUNTS}
"""


@register("eval_classification_report", _report_sql())
def eval_classification_report(i: Inputs):
    return EV.classification_report(_eval_source(i))


# Candidate "models": decision thresholds on the stored probability, judged
# against the true label. The 0.5 threshold is the current production model.
RUN_THRESHOLDS = [0.3, 0.5, 0.7, 0.9]
PRODUCTION_RUN = "thr_0.5"


def _runs(i: Inputs):
    """One metrics row per candidate threshold: the scored rows are fanned out
    over the (fixed, small) threshold list and reduced by conditional sums."""
    src = _eval_source(i)
    t = F.col("t")
    runs = src.select("label", "p", F.explode(F.array(*[F.lit(x) for x in RUN_THRESHOLDS])).alias("t"))
    hit = F.col("p") > t
    counts = runs.groupBy(F.concat(F.lit("thr_"), t.cast("string")).alias("run_id")).agg(
        F.count_if((F.col("label") == 1) & hit).alias("tp"),
        F.count_if((F.col("label") == 0) & hit).alias("fp"),
        F.count_if((F.col("label") == 0) & ~hit).alias("tn"),
        F.count_if((F.col("label") == 1) & ~hit).alias("fn"),
    )
    g = EV.gates(EV.metrics_from_counts(counts, None, keep=["run_id"]), keep=["run_id"])
    return g.select(
        "run_id",
        F.when(F.col("run_id") == PRODUCTION_RUN, F.lit("Production")).alias("stage"),
        "recall", "precision", "f1_score", "meets_requirements",
    )


def _runs_sql() -> str:
    parts = []
    for t in RUN_THRESHOLDS:
        parts.append(f"""SELECT 'thr_{t}' AS run_id,
  count_if(label = 1 AND p > {t}) AS tp, count_if(label = 0 AND p > {t}) AS fp,
  count_if(label = 0 AND NOT p > {t}) AS tn, count_if(label = 1 AND NOT p > {t}) AS fn FROM {_EVAL_SRC}""")
    counts = " UNION ALL ".join(parts)
    return f"""(SELECT run_id, CASE WHEN run_id = '{PRODUCTION_RUN}' THEN 'Production' END AS stage,
    round({_r('tp', 'tp + fn')}, 6) AS recall, round({_r('tp', 'tp + fp')}, 6) AS precision,
    round({_r('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score
  FROM ({counts}) c)"""


@register("eval_champion_challenger", f"""
SELECT r.run_id, ch.run_id AS champion_run_id,
  round(r.recall - ch.recall, 6) AS recall_gain, round(r.precision - ch.precision, 6) AS precision_change,
  round(r.f1_score - ch.f1_score, 6) AS f1_gain,
  (r.recall >= 0.9 AND r.precision >= 0.75 AND r.f1_score >= 0.8) AND r.recall - ch.recall > 0.01
    AND r.precision - ch.precision > -0.05 AND r.f1_score - ch.f1_score > 0 AS should_deploy,
  CASE WHEN (r.recall >= 0.9 AND r.precision >= 0.75 AND r.f1_score >= 0.8) AND r.recall - ch.recall > 0.01
    AND r.precision - ch.precision > -0.05 AND r.f1_score - ch.f1_score > 0 THEN 'better performance'
    ELSE 'not better enough' END AS reason
FROM {_runs_sql()} r JOIN {_runs_sql()} ch ON ch.stage = 'Production'
WHERE r.stage IS NULL
""")
def eval_champion_challenger(i: Inputs):
    return EV.champion_challenger(_runs(i))


# ------------------------------------------------------------ run history

# Four histories over the same runs: nothing in production, a champion, a champion
# that replaced another, and a challenger whose recall was never measured.
_HISTORIES = {"empty": [], "champion": ["thr_0.5"], "replaced": ["thr_0.9", "thr_0.3"], "unmeasured": ["thr_0.5"]}
_UNMEASURED = "thr_0.7"


def _history_sql() -> str:
    parts = []
    for name, promoted in _HISTORIES.items():
        champion = f"'{promoted[-1]}'" if promoted else "NULL"
        gone = ", ".join(f"'{r}'" for r in promoted) or "''"
        recall = f"CASE WHEN r.run_id = '{_UNMEASURED}' THEN NULL ELSE r.recall END" if name == "unmeasured" else "r.recall"
        gain = f"({recall}) - ch.recall"
        met = "(r.recall >= 0.9 AND r.precision >= 0.75 AND r.f1_score >= 0.8)"
        better = f"({met} AND {gain} > 0.01 AND r.precision - ch.precision > -0.05 AND r.f1_score - ch.f1_score > 0)"
        parts.append(f"""SELECT '{name}' AS history, r.run_id, ch.run_id AS champion_run_id,
  round({gain}, 6) AS recall_gain, round(r.precision - ch.precision, 6) AS precision_change,
  round(r.f1_score - ch.f1_score, 6) AS f1_gain,
  CASE WHEN ch.run_id IS NULL THEN true WHEN {gain} IS NULL THEN {met} ELSE {better} END AS should_deploy,
  CASE WHEN ch.run_id IS NULL THEN 'no production model' WHEN {gain} IS NULL THEN 'comparison failed'
    WHEN {better} THEN 'better performance' ELSE 'not better enough' END AS reason
FROM {_runs_sql()} r LEFT JOIN {_runs_sql()} ch ON ch.run_id = {champion}
WHERE r.run_id NOT IN ({gone})""")
    return " UNION ALL ".join(parts)


@register("eval_run_history", _history_sql())
def eval_run_history(i: Inputs):
    """The deploy decision read from recorded runs and their stage changes."""
    runs = materialize(_runs(i).drop("stage"), "candidate_runs")
    out = None
    for name, promoted in _HISTORIES.items():
        history = RunHistory.open(i.spark, new_location(i.spark, f"history_{name}"))
        rows = runs
        if name == "unmeasured":
            rows = runs.withColumn("recall", F.when(F.col("run_id") != _UNMEASURED, F.col("recall")))
        history.record(rows, {"kind": "threshold"})
        history.record(rows.where("run_id = 'thr_0.9'").withColumn("recall", F.lit(0.0)))  # a retry changes nothing
        for run_id in promoted:
            history.promote(run_id)
        part = history.decide().select(F.lit(name).alias("history"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------ raw rows to verdicts

@register("score_requests", f"""
SELECT f.batch_id, f.row_idx, f.trans_num,
  CASE WHEN NOT ({VALID_SQL}) THEN 'refused' WHEN p.p IS NULL THEN 'unscored' ELSE 'scored' END AS status,
  CASE WHEN NOT ({VALID_SQL}) THEN {VIOLATIONS_SQL} WHEN p.p IS NULL THEN 'no probability' END AS reason,
  CASE WHEN {VALID_SQL} THEN p.p > 0.5 END AS is_fraud,
  CASE WHEN {VALID_SQL} THEN round(p.p, 4) END AS fraud_probability,
  CASE WHEN {VALID_SQL} AND p.p IS NOT NULL THEN {_RISK_SQL.replace('fraud_probability', 'p.p')} END AS risk_level,
  CASE WHEN {VALID_SQL} THEN round(abs(p.p - 0.5) * 2, 4) END AS confidence
FROM payments_feed f LEFT JOIN (SELECT trans_num AS key, fraud_probability AS p FROM predictions) p ON p.key = f.trans_num
""")
def score_requests(i: Inputs):
    """Every raw row of the feed in one call: a verdict, or why there is none."""
    out = SV.score_requests(i.payments_feed, SV.stored_probability(i.predictions), as_of=FIXTURE_AGE_AS_OF)
    return out.select("batch_id", "row_idx", "trans_num", *SV.VERDICT)
