"""Model evaluation: confusion counts, metrics, gates, per-class report and
the champion/challenger decision.

Every metric comes from one aggregate pass of conditional sums (partial
aggregation map-side, one row out), so evaluation of a huge scored table is
a single shuffle-free reduction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.schemas import (
    CLASS_NAMES, MAX_PRECISION_LOSS, MIN_F1, MIN_PRECISION, MIN_RECALL, MIN_RECALL_GAIN, REASONS,
)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (undefined metric)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn (labels are 0/1 or booleans)."""
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long form (actual, predicted, n) with all four cells, zeros included."""
    c = confusion_counts(df, label, prediction)
    return c.select(
        F.explode(F.array(
            F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
            F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
            F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
            F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
        )).alias("cell")
    ).select("cell.*")


def metrics_from_counts(c: DataFrame, decimals: int | None = 6, keep: list[str] | None = None) -> DataFrame:
    """recall, precision, f1, accuracy (0 when undefined) from tp/fp/tn/fn;
    ``keep`` names pass-through columns (e.g. a run id). ``decimals=None``
    leaves them unrounded, as the gates need them."""
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    recall = _ratio(tp, tp + fn)
    precision = _ratio(tp, tp + fp)
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    accuracy = _ratio(tp + tn, tp + tn + fp + fn)
    return c.select(
        *(keep or []),
        *[(x if decimals is None else F.round(x, decimals)).alias(n) for x, n in
          ((recall, "recall"), (precision, "precision"), (f1, "f1_score"), (accuracy, "accuracy"))],
        (tp + fp + tn + fn).alias("support"),
    )


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
            decimals: int | None = 6) -> DataFrame:
    return metrics_from_counts(confusion_counts(df, label, prediction), decimals)


def gates(m: DataFrame, min_recall: float = MIN_RECALL, min_precision: float = MIN_PRECISION,
          min_f1: float = MIN_F1, keep: list[str] | None = None, decimals: int = 6) -> DataFrame:
    """Minimum-quality gates as booleans plus the list of failed gates.

    The gates compare the metrics as given, which should be unrounded; the
    metrics in the result are rounded."""
    ok_r = F.col("recall") >= min_recall
    ok_p = F.col("precision") >= min_precision
    ok_f = F.col("f1_score") >= min_f1
    failures = F.array_compact(F.array(
        F.when(~ok_r, F.lit("recall")), F.when(~ok_p, F.lit("precision")), F.when(~ok_f, F.lit("f1_score"))
    ))
    return m.select(
        *(keep or []),
        *[F.round(n, decimals).alias(n) for n in ("recall", "precision", "f1_score")],
        ok_r.alias("recall_ok"), ok_p.alias("precision_ok"), ok_f.alias("f1_ok"),
        (ok_r & ok_p & ok_f).alias("meets_requirements"),
        F.array_join(failures, ",").alias("failures"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          decimals: int = 6) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted means."""
    c = confusion_counts(df, label, prediction)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    # class 1 (positive): tp/fp/fn as is; class 0: roles swapped (tn, fn, fp)
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1_1 = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_0 = _ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _ratio(tp + tn, n)

    def row(name, p, r, f, s, order):
        return F.struct(F.lit(order).alias("row_order"), F.lit(name).alias("class_name"),
                        F.round(p, decimals).alias("precision"), F.round(r, decimals).alias("recall"),
                        F.round(f, decimals).alias("f1_score"), s.cast("long").alias("support"))

    rows = F.array(
        row(CLASS_NAMES[0], p0, r0, f1_0, s0, 0),
        row(CLASS_NAMES[1], p1, r1, f1_1, s1, 1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n, 2),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n, 3),
        row("weighted avg", _ratio(p0 * s0 + p1 * s1, n), _ratio(r0 * s0 + r1 * s1, n),
            _ratio(f1_0 * s0 + f1_1 * s1, n), n, 4),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")


def champion_challenger(runs: DataFrame, champion_stage: str = "Production",
                        order_col: str = "run_id") -> DataFrame:
    """Deploy decision for every non-champion run.

    Rules: with no champion, deploy; otherwise deploy only if the gates are met
    and recall gains more than 0.01, precision loses less than 0.05 and F1
    improves. A missing champion metric counts as 0. When the comparison
    itself fails (the challenger lacks a metric), deploy if the gates are met.

    ``runs``: run_id, stage, recall, precision, f1_score, meets_requirements.
    The champion is the latest run (largest ``order_col``) in the stage. It is
    picked by a global ``max_by`` aggregate, which yields exactly one row
    (null when the stage is empty) however many runs the stage holds, and is
    read as a scalar subquery: computed once, no join, one decision row per
    challenger.
    """
    champ_row = F.struct(
        F.col("run_id").alias("champion_run_id"),
        F.coalesce("recall", F.lit(0.0)).alias("champion_recall"),
        F.coalesce("precision", F.lit(0.0)).alias("champion_precision"),
        F.coalesce("f1_score", F.lit(0.0)).alias("champion_f1"),
    )
    champ = (
        runs.where(F.col("stage") == champion_stage)
        .select(F.max_by(champ_row, F.col(order_col)))
        .scalar()
    )
    challengers = runs.where(F.col("stage").isNull() | (F.col("stage") != champion_stage))
    j = challengers.withColumn("_c", champ).select("*", "_c.*").drop("_c")
    d_r = F.col("recall") - F.col("champion_recall")
    d_p = F.col("precision") - F.col("champion_precision")
    d_f = F.col("f1_score") - F.col("champion_f1")
    met = F.coalesce("meets_requirements", F.lit(False))
    failed = (d_r + d_p + d_f).isNull()
    better = met & (d_r > MIN_RECALL_GAIN) & (d_p > MAX_PRECISION_LOSS) & (d_f > 0)
    no_champ = F.col("champion_run_id").isNull()
    decision = F.when(no_champ, F.lit(True)).when(failed, met).otherwise(better)
    reason = (
        F.when(no_champ, F.lit(REASONS["none"]))
        .when(failed, F.lit(REASONS["failed"]))
        .when(better, F.lit(REASONS["better"]))
        .otherwise(F.lit(REASONS["worse"]))
    )
    return j.select(
        "run_id", "champion_run_id",
        F.round(d_r, 6).alias("recall_gain"), F.round(d_p, 6).alias("precision_change"),
        F.round(d_f, 6).alias("f1_gain"),
        decision.alias("should_deploy"), reason.alias("reason"),
    )
