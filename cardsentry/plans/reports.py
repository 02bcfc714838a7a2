"""Monitoring reports: KPI totals, recent lists, chart data, daily report.

Each function takes the stored tables as DataFrames and returns a lazily
planned DataFrame. Chart functions take ``limit``: ``None`` means the whole
table; an integer reproduces the dashboard, which charts only the N most
recent predictions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import scoring
from cardsentry.operators.ranking import exact_quantiles

RECENT_PREDICTIONS_DEFAULT = 500
RECENT_ALERTS = 100
LATEST_PAYMENTS_DEFAULT = 100


def _amount(col: str = "amt") -> Column:
    return F.col(col).cast("double")


# ---------------------------------------------------------------- lists (F-*)

def latest_payments(payments: DataFrame, limit: int = LATEST_PAYMENTS_DEFAULT) -> DataFrame:
    """Latest payments by id, newest first (top-k; one partial top-k per task)."""
    return (
        payments.select(
            "id", "trans_num", _amount().alias("amt"), "merchant", "category", "city",
            "state", "transaction_time", "is_fraud", "created_at",
        )
        .orderBy(F.col("id").desc())
        .limit(limit)
    )


def scored_labels(predictions: DataFrame, payments: DataFrame | None = None, limit: int | None = None,
                  newest_first: bool = True) -> DataFrame:
    """Label, probability and time of the predictions of stored payments,
    optionally only the ``limit`` newest, in order.

    Payments add no column here: without ``payments`` the foreign key is taken as
    enforced by the writers (``KeyedTable.insert_checked``) and nothing is joined;
    with them, a semi join on keys leaves orphans out.
    """
    pred = predictions.select(
        "trans_num",
        F.col("is_fraud").alias("predicted_fraud"),
        "fraud_probability",
        "predicted_at",
    )
    if payments is not None:
        pred = pred.join(payments.select("trans_num"), "trans_num", "left_semi")
    return pred if limit is None else pred.orderBy(*_by_time(newest_first)).limit(limit)


def _by_time(newest_first: bool = True) -> list[Column]:
    time, key = F.col("predicted_at"), F.col("trans_num")
    return [time.desc(), key.desc()] if newest_first else [time, key]


def scored_payments(predictions: DataFrame, payments: DataFrame, limit: int | None = None,
                    newest_first: bool = True, enforced: bool = False) -> DataFrame:
    """Predictions joined to their payments, optionally only the ``limit`` newest.

    With a limit the top-k is taken before payments are joined. Unless the
    foreign key is ``enforced`` by the writers, it is taken on the predictions
    whose payment is stored, so that orphans never shorten the result. The
    limited rows come back in order.
    """
    pred = scored_labels(predictions, None if enforced or limit is None else payments, limit, newest_first)
    pay = payments.select("trans_num", _amount().alias("amt"), "merchant", "category", "city", "state")
    out = pred.join(pay, "trans_num").select(
        "trans_num", "amt", "merchant", "category", "city", "state",
        "predicted_fraud", "fraud_probability", "predicted_at",
    )
    return out if limit is None else out.orderBy(*_by_time(newest_first))  # a join keeps no order


def recent_predictions(predictions: DataFrame, payments: DataFrame, limit: int = RECENT_PREDICTIONS_DEFAULT,
                       only_fraud: bool = False, enforced: bool = False) -> DataFrame:
    """Most recent scored payments (dashboard table); optional frauds-only toggle."""
    df = scored_payments(predictions, payments, limit, enforced=enforced)
    if only_fraud:
        df = df.where(F.col("predicted_fraud"))
    return df


def recent_alerts(alerts: DataFrame, payments: DataFrame, predictions: DataFrame,
                  limit: int | None = RECENT_ALERTS, enforced: bool = False) -> DataFrame:
    """Alerts with payment details and (possibly missing) probability.

    Inner join to payments, LEFT join to predictions, newest first. ``enforced``
    as in ``scored_payments``.
    """
    fa = alerts.select("id", "trans_num", "email_sent", "email_sent_at", "created_at")
    if limit is not None:
        if not enforced:
            fa = fa.join(payments.select("trans_num"), "trans_num", "left_semi")
        fa = fa.orderBy(F.col("created_at").desc(), F.col("trans_num").desc()).limit(limit)
    pay = payments.select("trans_num", _amount().alias("amt"), "merchant", "city", "state")
    pred = predictions.select("trans_num", "fraud_probability")
    return (
        fa.join(pay, "trans_num")
        .join(pred, "trans_num", "left")
        .select("id", "trans_num", "amt", "merchant", "city", "state", "fraud_probability",
                "email_sent", "email_sent_at", "created_at")
        .orderBy(F.col("created_at").desc(), F.col("trans_num").desc())
    )


# ---------------------------------------------------------------- KPI (E-01/02)

def kpi_totals(payments: DataFrame) -> DataFrame:
    """Count, true frauds, mean and total amount over all payments (one pass)."""
    return payments.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(F.sum(F.when(F.col("is_fraud") == 1, 1).otherwise(0)), F.lit(0))
        .cast("long").alias("total_frauds"),
        F.round(F.avg(_amount()), 4).alias("avg_amount"),
        F.round(F.sum(_amount()), 2).alias("total_amount"),
    )


def kpi_fraud_rate(payments: DataFrame) -> DataFrame:
    """Fraud rate in per cent, 0 when there are no payments."""
    t = kpi_totals(payments)
    return t.select(
        "total_transactions",
        "total_frauds",
        F.round(
            F.when(F.col("total_transactions") > 0,
                   F.col("total_frauds") / F.col("total_transactions") * 100).otherwise(F.lit(0.0)),
            4,
        ).alias("fraud_rate_pct"),
    )


# ---------------------------------------------------------------- charts (E-*)

def fraud_vs_legit(scored: DataFrame) -> DataFrame:
    """Counts per predicted label, both labels always present."""
    return scored.agg(
        F.count_if(~F.col("predicted_fraud")).alias("legit"),
        F.count_if(F.col("predicted_fraud")).alias("fraud"),
    )


def probability_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Counts of fraud probability in ``bins`` equal bins on [0, 1]; p = 1 goes in the last."""
    b = F.least(F.floor(F.col("fraud_probability") * bins), F.lit(bins - 1)).cast("int")
    return (
        scored.where(F.col("fraud_probability").isNotNull())
        .groupBy(b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("bin") / F.lit(float(bins))).alias("bin_start"), "n")
    )


def daily_counts_pivot(scored: DataFrame) -> DataFrame:
    """Per prediction day: number of legitimate and fraudulent predictions."""
    return (
        scored.groupBy(F.to_date("predicted_at").alias("date"))
        .pivot("predicted_fraud", [False, True])
        .agg(F.count(F.lit(1)))
        .withColumnRenamed("false", "legit")
        .withColumnRenamed("true", "fraud")
        .fillna(0, ["legit", "fraud"])
    )


def frauds_by(scored: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Top ``top`` values of ``column`` by number of predicted frauds."""
    return (
        scored.where(F.col("predicted_fraud"))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_frauds"))
        .orderBy(F.col("n_frauds").desc(), F.col(column))
        .limit(top)
    )


def avg_amount_by_label(scored: DataFrame) -> DataFrame:
    return scored.groupBy("predicted_fraud").agg(F.round(F.avg("amt"), 4).alias("avg_amount"))


def amount_quartiles(scored: DataFrame) -> DataFrame:
    """Box-plot numbers of the amount per predicted label (exact, distributed)."""
    q = exact_quantiles(scored, ["predicted_fraud"], "amt", [0.25, 0.5, 0.75], ["q1", "median", "q3"],
                        with_summary=True)
    return q.select(
        "predicted_fraud", "n", F.col("min_value").alias("min_amt"),
        F.round("q1", 4).alias("q1"), F.round("median", 4).alias("median"), F.round("q3", 4).alias("q3"),
        F.col("max_value").alias("max_amt"),
    )


def label_distribution(payments: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Share of each true label; the total is a scalar subquery (no cross join)."""
    total = payments.select(F.count(F.lit(1))).scalar()
    return payments.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(
        label, "n", F.round(F.col("n") / total, 6).alias("share")
    )


def alert_totals(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    """All, sent and pending alerts (pending = all - sent)."""
    fa = alerts
    if limit is not None:
        fa = fa.orderBy(F.col("created_at").desc(), F.col("trans_num").desc()).limit(limit)
    sent = F.coalesce(F.sum(F.col("email_sent").cast("int")), F.lit(0)).cast("long")
    return fa.agg(F.count(F.lit(1)).alias("total_alerts"), sent.alias("emails_sent")).withColumn(
        "pending", F.col("total_alerts") - F.col("emails_sent")
    )


def batch_fraud_count(predictions: DataFrame) -> DataFrame:
    """Detected frauds and batch size of a scored batch."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.coalesce(F.sum(F.col("is_fraud").cast("int")), F.lit(0)).cast("long").alias("n_detected"),
    )


# ---------------------------------------------------------------- extracts (D-03/04, E-12)

def _labelled_training(predictions: DataFrame, training: DataFrame, label: str) -> DataFrame:
    pred = predictions.select("trans_num", F.col("is_fraud").cast("int").alias("is_fraud_pred"))
    j = pred.join(training, "trans_num")
    if label == "predicted":
        return j.drop("is_fraud").withColumnRenamed("is_fraud_pred", "is_fraud")
    if label == "actual":
        return j.drop("is_fraud_pred")
    raise ValueError("label must be 'predicted' or 'actual'")


def train_extract(predictions: DataFrame, training: DataFrame, label: str = "predicted") -> DataFrame:
    """Training rows joined to predictions; ``label='predicted'`` replaces the
    true label by the model's own (as the original retraining job does)."""
    return _labelled_training(predictions, training, label).drop("created_at")


def _summary(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    frauds = F.coalesce(F.sum("is_fraud"), F.lit(0)).cast("long")
    return df.agg(n.alias("n_rows"), frauds.alias("n_frauds")).select(
        "n_rows", "n_frauds", (F.col("n_rows") - F.col("n_frauds")).alias("n_legit"),
        F.round(F.when(F.col("n_rows") > 0, F.col("n_frauds") / F.col("n_rows") * 100)
                .otherwise(F.lit(0.0)), 4).alias("fraud_rate_pct"),
    )


def train_extract_summary(predictions: DataFrame, training: DataFrame, label: str = "predicted") -> DataFrame:
    return _summary(train_extract(predictions, training, label))


def previous_day(col: str, as_of: _dt.date | None = None) -> Column:
    """``as_of - 1 day <= col < as_of`` (half open), as_of defaults to today."""
    ref = F.current_date() if as_of is None else F.lit(as_of)
    return (F.col(col) >= F.date_sub(ref, 1).cast("timestamp_ntz")) & (F.col(col) < ref.cast("timestamp_ntz"))


def daily_report_rows(predictions: DataFrame, training: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    """Yesterday's training rows that the model flagged, label = prediction,
    creation time as text (the CSV report body)."""
    pred = predictions.where(F.col("is_fraud")).select(
        "trans_num", F.col("is_fraud").cast("int").alias("is_fraud_pred")
    )
    td = training.where(previous_day("created_at", as_of))
    return (
        pred.join(td, "trans_num")
        .drop("is_fraud")
        .withColumnRenamed("is_fraud_pred", "is_fraud")
        .withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )


def daily_report_summary(predictions: DataFrame, training: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    return _summary(daily_report_rows(predictions, training, as_of))


# ---------------------------------------------------------------- display (S-11, F-04/05/07)

def fmt_recent(predictions: DataFrame, payments: DataFrame, only_fraud: bool = False,
               head: int = 50, loaded: int = RECENT_PREDICTIONS_DEFAULT, enforced: bool = False) -> DataFrame:
    """Dashboard table rows: money and percent text, status label, the newest
    ``head``. The frauds-only table shows the frauds among the ``loaded``
    newest rows, which is what the dashboard holds when it filters."""
    if only_fraud:
        rows = scored_payments(predictions, payments, limit=loaded, enforced=enforced).where("predicted_fraud")
    else:
        rows = scored_payments(predictions, payments, limit=head, enforced=enforced)
    newest = _by_time()
    return (
        rows.orderBy(*newest)
        .limit(head)
        .select(
            "trans_num",
            scoring.money(F.col("amt")).alias("amt"),
            "merchant", "category", "city", "state",
            scoring.fraud_status(F.col("predicted_fraud")).alias("predicted_fraud"),
            scoring.percent(F.col("fraud_probability")).alias("fraud_probability"),
            "predicted_at",
        )
    )


def fmt_alerts(alert_rows: DataFrame, head: int = 20) -> DataFrame:
    return (
        alert_rows.orderBy(F.col("created_at").desc(), F.col("trans_num").desc())
        .limit(head)
        .select(
            "trans_num",
            scoring.money(F.col("amt")).alias("amt"),
            "merchant", "city", "state",
            scoring.percent_or_na(F.col("fraud_probability")).alias("fraud_probability"),
            scoring.email_status(F.col("email_sent")).alias("email_sent"),
            "created_at",
        )
    )


def alert_digest(predictions: DataFrame, payments: DataFrame, head: int = 10, enforced: bool = False) -> DataFrame:
    """First ``head`` frauds (p > 0.5) of a scored batch as digest lines, with
    the total and the "and N more" remainder as columns.

    The total is a scalar subquery over the predictions alone and the first
    rows a distributed top-k taken before the join to payments, so no task
    or driver holds the batch and only ``head`` rows are joined.
    """
    frauds = predictions.where(scoring.above_threshold(F.col("fraud_probability")))
    total = frauds.select(F.count(F.lit(1))).scalar()
    first = scored_payments(frauds, payments, limit=head, newest_first=False, enforced=enforced)
    return first.select(
        "trans_num",
        F.substring("trans_num", 1, 30).alias("id_text"),
        scoring.money(F.col("amt")).alias("amount_text"),
        F.substring(F.coalesce("merchant", F.lit("N/A")), 1, 40).alias("merchant_text"),
        F.concat_ws(", ", F.coalesce("city", F.lit("N/A")), F.coalesce("state", F.lit("N/A"))).alias("place_text"),
        scoring.percent(F.col("fraud_probability")).alias("probability_text"),
        total.alias("n_frauds"),
        F.greatest(total - head, F.lit(0)).alias("n_more"),
    )


def sample_rows(payments: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """Repeatable sample of ``n`` payments: smallest ``md5(seed:trans_num)``."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("trans_num")))
    return (
        payments.select("id", "trans_num", _amount().alias("amt"), "category", "is_fraud", h.alias("_h"))
        .orderBy("_h", "trans_num")
        .limit(n)
        .drop("_h")
    )
