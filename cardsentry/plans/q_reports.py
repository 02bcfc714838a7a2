"""Registered report queries (dashboard, KPI, extracts, daily report)."""

from __future__ import annotations

from cardsentry.plans import reports as R
from cardsentry.plans.catalog import Inputs, register
from cardsentry.schemas import EMAIL_PENDING, EMAIL_SENT, STATUS_FRAUD, STATUS_LEGIT
from cardsentry.sources.tables import FIXTURE_REPORT_DATE

FRAUD, LEGIT, SENT, PENDING = (f"'{x}'" for x in (STATUS_FRAUD, STATUS_LEGIT, EMAIL_SENT, EMAIL_PENDING))


def _scored(i: Inputs):
    return R.scored_payments(i.predictions, i.payments)


# The stored tables reference payments (FOREIGN_KEYS, which the writers enforce
# and ``fk_orphans`` measures): charts of prediction columns need no payment.
def _labels(i: Inputs, limit: int | None = None):
    return R.scored_labels(i.predictions, limit=limit)


# ----------------------------------------------------------------- lists

@register("latest_payments", """
SELECT id, trans_num, CAST(amt AS DOUBLE) AS amt, merchant, category, city, state,
  transaction_time, is_fraud, created_at
FROM payments ORDER BY id DESC LIMIT 100
""")
def latest_payments(i: Inputs):
    return R.latest_payments(i.payments, 100)


# The N newest of the scored rows (the fixture view joins both tables).
_RECENT_500 = "SELECT * FROM scored ORDER BY predicted_at DESC, trans_num DESC LIMIT 500"


@register("recent_predictions", _RECENT_500)
def recent_predictions(i: Inputs):
    return R.recent_predictions(i.predictions, i.payments, 500, enforced=True)


@register("recent_predictions_frauds", f"SELECT * FROM ({_RECENT_500}) r WHERE predicted_fraud")
def recent_predictions_frauds(i: Inputs):
    return R.recent_predictions(i.predictions, i.payments, 500, only_fraud=True, enforced=True)


# The N newest alerts that have a payment; the probability may be missing.
_RECENT_ALERTS = """
SELECT id, trans_num, amt, merchant, city, state,
  (SELECT max(fraud_probability) FROM predictions q WHERE q.trans_num = a.trans_num) AS fraud_probability,
  email_sent, email_sent_at, created_at
FROM (SELECT f.*, CAST(x.amt AS DOUBLE) AS amt, x.merchant, x.city, x.state
      FROM fraud_alerts f, payments x WHERE x.trans_num = f.trans_num) a
ORDER BY created_at DESC, trans_num DESC LIMIT 100
"""


@register("recent_alerts", _RECENT_ALERTS)
def recent_alerts(i: Inputs):
    return R.recent_alerts(i.fraud_alerts, i.payments, i.predictions, 100, enforced=True)


# ----------------------------------------------------------------- KPI

@register("kpi_totals", """
SELECT count(*) AS total_transactions,
  CAST(coalesce(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_frauds,
  round(avg(CAST(amt AS DOUBLE)), 4) AS avg_amount,
  round(sum(CAST(amt AS DOUBLE)), 2) AS total_amount
FROM payments
""")
def kpi_totals(i: Inputs):
    return R.kpi_totals(i.payments)


@register("kpi_fraud_rate", """
SELECT total_transactions, total_frauds,
  round(CASE WHEN total_transactions > 0 THEN total_frauds / total_transactions * 100 ELSE 0.0 END, 4)
    AS fraud_rate_pct
FROM (SELECT count(*) AS total_transactions,
        CAST(coalesce(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_frauds
      FROM payments) t
""")
def kpi_fraud_rate(i: Inputs):
    return R.kpi_fraud_rate(i.payments)


# ----------------------------------------------------------------- charts (whole table)

@register("fraud_vs_legit", """
SELECT CAST(count_if(NOT predicted_fraud) AS BIGINT) AS legit,
  CAST(count_if(predicted_fraud) AS BIGINT) AS fraud
FROM scored
""")
def fraud_vs_legit(i: Inputs):
    return R.fraud_vs_legit(_labels(i))


@register("probability_histogram", """
SELECT bin, CAST(bin AS DOUBLE) / 20.0 AS bin_start, n FROM (
  SELECT CAST(least(floor(fraud_probability * 20), 19) AS INTEGER) AS bin, count(*) AS n
  FROM scored WHERE fraud_probability IS NOT NULL GROUP BY 1) t
""")
def probability_histogram(i: Inputs):
    return R.probability_histogram(_labels(i), 20)


@register("daily_counts_pivot", """
SELECT CAST(predicted_at AS DATE) AS date,
  CAST(count_if(NOT predicted_fraud) AS BIGINT) AS legit,
  CAST(count_if(predicted_fraud) AS BIGINT) AS fraud
FROM scored GROUP BY 1
""")
def daily_counts_pivot(i: Inputs):
    return R.daily_counts_pivot(_labels(i))


@register("frauds_by_state", """
SELECT state, count(*) AS n_frauds FROM scored WHERE predicted_fraud
GROUP BY state ORDER BY n_frauds DESC, state LIMIT 10
""")
def frauds_by_state(i: Inputs):
    return R.frauds_by(_scored(i), "state", 10)


@register("frauds_by_category", """
SELECT category, count(*) AS n_frauds FROM scored WHERE predicted_fraud
GROUP BY category ORDER BY n_frauds DESC, category LIMIT 10
""")
def frauds_by_category(i: Inputs):
    return R.frauds_by(_scored(i), "category", 10)


@register("avg_amount_by_label", """
SELECT predicted_fraud, round(avg(amt), 4) AS avg_amount FROM scored GROUP BY 1
""")
def avg_amount_by_label(i: Inputs):
    return R.avg_amount_by_label(_scored(i))


@register("amount_quartiles", """
SELECT predicted_fraud, count(amt) AS n, min(amt) AS min_amt,
  round(quantile_cont(amt, 0.25), 4) AS q1, round(quantile_cont(amt, 0.5), 4) AS median,
  round(quantile_cont(amt, 0.75), 4) AS q3, max(amt) AS max_amt
FROM scored GROUP BY 1
""")
def amount_quartiles(i: Inputs):
    return R.amount_quartiles(_scored(i))


@register("label_distribution", """
SELECT is_fraud, count(*) AS n, round(count(*) / (SELECT count(*) FROM payments), 6) AS share
FROM payments GROUP BY 1
""")
def label_distribution(i: Inputs):
    return R.label_distribution(i.payments)


@register("alert_totals", """
SELECT total_alerts, emails_sent, total_alerts - emails_sent AS pending FROM (
  SELECT count(*) AS total_alerts,
    CAST(coalesce(sum(CAST(email_sent AS INTEGER)), 0) AS BIGINT) AS emails_sent
  FROM fraud_alerts) t
""")
def alert_totals(i: Inputs):
    return R.alert_totals(i.fraud_alerts)


@register("alert_totals_recent", """
SELECT total_alerts, emails_sent, total_alerts - emails_sent AS pending FROM (
  SELECT count(*) AS total_alerts,
    CAST(coalesce(sum(CAST(email_sent AS INTEGER)), 0) AS BIGINT) AS emails_sent
  FROM (SELECT * FROM fraud_alerts ORDER BY created_at DESC, trans_num DESC LIMIT 100) r) t
""")
def alert_totals_recent(i: Inputs):
    return R.alert_totals(i.fraud_alerts, limit=100)


@register("batch_fraud_count", """
SELECT count(*) AS n_scored, CAST(coalesce(sum(CAST(is_fraud AS INTEGER)), 0) AS BIGINT) AS n_detected
FROM predictions
""")
def batch_fraud_count(i: Inputs):
    return R.batch_fraud_count(i.predictions)


# ----------------------------------------------------------------- extracts

_TRAIN_COLS = """td.id, td.trans_num, td.cc_num, td.merchant, td.category, CAST(td.amt AS DOUBLE) AS amt,
  td.gender, td.state, td.zip, td.city_pop, td.distance_km, td.age, td.hour, td.is_business_hour,
  td.is_morning, td.is_afternoon, td.is_evening, td.is_night, td.year, td.month, td.day,
  td.dayofweek, td.is_we"""


@register("train_extract", f"""
SELECT {_TRAIN_COLS}, CAST(pred.is_fraud AS INTEGER) AS is_fraud
FROM predictions pred JOIN training_data td ON td.trans_num = pred.trans_num
""")
def train_extract(i: Inputs):
    df = R.train_extract(i.predictions, i.training_data, label="predicted")
    return df.withColumn("amt", df.amt.cast("double"))


@register("train_extract_actual", f"""
SELECT {_TRAIN_COLS}, td.is_fraud
FROM predictions pred JOIN training_data td ON td.trans_num = pred.trans_num
""")
def train_extract_actual(i: Inputs):
    df = R.train_extract(i.predictions, i.training_data, label="actual")
    return df.withColumn("amt", df.amt.cast("double"))


_SUMMARY = """
SELECT n_rows, n_frauds, n_rows - n_frauds AS n_legit,
  round(CASE WHEN n_rows > 0 THEN n_frauds / n_rows * 100 ELSE 0.0 END, 4) AS fraud_rate_pct
FROM (SELECT count(*) AS n_rows, CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS n_frauds FROM ({src}) s) t
"""


@register("train_extract_summary", _SUMMARY.format(src="""
SELECT CAST(pred.is_fraud AS INTEGER) AS is_fraud
FROM predictions pred JOIN training_data td ON td.trans_num = pred.trans_num"""))
def train_extract_summary(i: Inputs):
    return R.train_extract_summary(i.predictions, i.training_data)


_DAILY = f"""
SELECT {_TRAIN_COLS.replace('CAST(td.amt AS DOUBLE) AS amt', 'td.amt')},
  CAST(pred.is_fraud AS INTEGER) AS is_fraud,
  strftime(td.created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM predictions pred JOIN training_data td ON td.trans_num = pred.trans_num
WHERE td.created_at >= DATE '{FIXTURE_REPORT_DATE.isoformat()}' - INTERVAL 1 DAY
  AND td.created_at < DATE '{FIXTURE_REPORT_DATE.isoformat()}'
  AND pred.is_fraud
"""


@register("daily_report_rows", _DAILY.replace("td.amt,", "CAST(td.amt AS DOUBLE) AS amt,"))
def daily_report_rows(i: Inputs):
    df = R.daily_report_rows(i.predictions, i.training_data, FIXTURE_REPORT_DATE)
    return df.withColumn("amt", df.amt.cast("double"))


@register("daily_report_summary", _SUMMARY.format(src=_DAILY))
def daily_report_summary(i: Inputs):
    return R.daily_report_summary(i.predictions, i.training_data, FIXTURE_REPORT_DATE)


# ----------------------------------------------------------------- display

_FMT_RECENT = f"""
SELECT trans_num, printf('$%.2f', amt) AS amt, merchant, category, city, state,
  CASE WHEN predicted_fraud THEN {FRAUD} ELSE {LEGIT} END AS predicted_fraud,
  printf('%.1f%%', round(fraud_probability * 100, 1)) AS fraud_probability, predicted_at
FROM {{rows}} ORDER BY predicted_at DESC, trans_num DESC LIMIT 50
"""


@register("fmt_recent", _FMT_RECENT.format(rows="scored"))
def fmt_recent(i: Inputs):
    return R.fmt_recent(i.predictions, i.payments, enforced=True)


@register("fmt_recent_frauds", _FMT_RECENT.format(rows=f"({_RECENT_500}) r WHERE predicted_fraud"))
def fmt_recent_frauds(i: Inputs):
    return R.fmt_recent(i.predictions, i.payments, only_fraud=True, enforced=True)


@register("fmt_alerts", f"""
SELECT trans_num, printf('$%.2f', amt) AS amt, merchant, city, state,
  coalesce(printf('%.1f%%', round(fraud_probability * 100, 1)), 'N/A') AS fraud_probability,
  CASE WHEN email_sent THEN {SENT} ELSE {PENDING} END AS email_sent, created_at
FROM ({_RECENT_ALERTS}) a ORDER BY created_at DESC, trans_num DESC LIMIT 20
""")
def fmt_alerts(i: Inputs):
    return R.fmt_alerts(R.recent_alerts(i.fraud_alerts, i.payments, i.predictions, 100, enforced=True))


@register("alert_digest", """
SELECT trans_num, substr(trans_num, 1, 30) AS id_text, printf('$%.2f', amt) AS amount_text,
  substr(coalesce(merchant, 'N/A'), 1, 40) AS merchant_text,
  concat_ws(', ', coalesce(city, 'N/A'), coalesce(state, 'N/A')) AS place_text,
  printf('%.1f%%', round(fraud_probability * 100, 1)) AS probability_text,
  (SELECT count(*) FROM scored WHERE fraud_probability > 0.5) AS n_frauds,
  greatest((SELECT count(*) FROM scored WHERE fraud_probability > 0.5) - 10, 0) AS n_more
FROM scored WHERE fraud_probability > 0.5 ORDER BY predicted_at, trans_num LIMIT 10
""")
def alert_digest(i: Inputs):
    return R.alert_digest(i.predictions, i.payments, 10, enforced=True)


@register("sample_rows", """
SELECT id, trans_num, CAST(amt AS DOUBLE) AS amt, category, is_fraud FROM payments
ORDER BY md5(concat('42:', trans_num)), trans_num LIMIT 1000
""")
def sample_rows(i: Inputs):
    return R.sample_rows(i.payments, 1000, 42)


# ----------------------------------------------------------------- SQL text path (A-05)

# A statement of its own: monthly totals per category, as SQL text.
MONTHLY_SQL = """
SELECT category, CAST({month} AS INT) AS month, count(*) AS n_payments,
  round(sum(CAST(amt AS DOUBLE)), 2) AS amount
FROM payments GROUP BY category, CAST({month} AS INT)
"""


@register("sql_text_stats", MONTHLY_SQL.format(month="date_part('month', transaction_time)"))
def sql_text_stats(i: Inputs):
    """SQL text run by ``spark.sql`` over a session view of the payments table
    (Catalyst plans it like the DataFrame)."""
    i.payments.createOrReplaceTempView("payments")
    return i.spark.sql(MONTHLY_SQL.format(month="month(transaction_time)"))


# ----------------------------------------------------------------- dashboard charts on the recent N

_RECENT_SCORED = f"({_RECENT_500}) scored_recent"


def _recent_chart(name: str, fn, sql: str, labels_only: bool = False):
    """The dashboard charts the 500 most recent scored payments (its default
    time range); the limit is the feature here."""
    register(f"{name}_recent", sql.replace("FROM scored", f"FROM {_RECENT_SCORED}"))(
        lambda i: fn(_labels(i, 500) if labels_only else
                     R.scored_payments(i.predictions, i.payments, limit=500, enforced=True)))


def _body(name: str) -> str:
    from cardsentry.plans.catalog import ORACLE
    from cardsentry.plans.oracle import FIXTURE_CTES

    return ORACLE[name][len(FIXTURE_CTES):]


_recent_chart("fraud_vs_legit", R.fraud_vs_legit, _body("fraud_vs_legit"), labels_only=True)
_recent_chart("probability_histogram", R.probability_histogram, _body("probability_histogram"), labels_only=True)
_recent_chart("daily_counts_pivot", R.daily_counts_pivot, _body("daily_counts_pivot"), labels_only=True)
_recent_chart("frauds_by_state", lambda s: R.frauds_by(s, "state", 10), _body("frauds_by_state"))
_recent_chart("frauds_by_category", lambda s: R.frauds_by(s, "category", 10), _body("frauds_by_category"))
_recent_chart("avg_amount_by_label", R.avg_amount_by_label, _body("avg_amount_by_label"))
_recent_chart("amount_quartiles", R.amount_quartiles, _body("amount_quartiles"))
