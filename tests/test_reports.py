"""Lists keep their order through the join, and orphans do not shorten them."""

import datetime as dt

import pytest

from cardsentry.plans import reports as R


@pytest.fixture
def tables(spark):
    t0 = dt.datetime(2024, 1, 1)
    pay = spark.createDataFrame(
        [(f"T{k:02d}", 10.0 + k, "m", "c", "x", "s") for k in range(40)],
        "trans_num string, amt double, merchant string, category string, city string, state string")
    pred = spark.createDataFrame(
        [(f"T{k:02d}", k % 3 == 0, 0.9 if k % 3 == 0 else 0.1, t0 + dt.timedelta(minutes=(k * 7) % 40)) for k in range(40)]
        + [(f"X{k}", True, 0.9, t0 + dt.timedelta(days=1)) for k in range(3)],  # no payment
        "trans_num string, is_fraud boolean, fraud_probability double, predicted_at timestamp_ntz")
    alerts = pred.where("is_fraud").selectExpr(
        "cast(hash(trans_num) as bigint) as id", "trans_num", "false as email_sent",
        "cast(null as timestamp_ntz) as email_sent_at", "predicted_at as created_at")
    return pay, pred, alerts


def _newest(rows, time):
    keys = [(getattr(r, time), r.trans_num) for r in rows]
    return keys == sorted(keys, reverse=True)


def test_order_and_full_length(tables):
    pay, pred, alerts = tables
    recent = R.recent_predictions(pred, pay, 5).collect()
    assert len(recent) == 5 and _newest(recent, "predicted_at")
    shown = R.recent_alerts(alerts, pay, pred, 5).collect()
    assert len(shown) == 5 and _newest(shown, "created_at")
    fmt = R.fmt_recent(pred, pay, head=10).collect()
    assert len(fmt) == 10 and _newest(fmt, "predicted_at")
    digest = [r.trans_num for r in R.alert_digest(pred, pay, 6).collect()]
    when = {r.trans_num: (r.predicted_at, r.trans_num) for r in pred.collect()}
    assert len(digest) == 6 and digest == sorted(digest, key=when.get)


def test_frauds_only_table_filters_the_loaded_rows(tables):
    pay, pred, _ = tables
    loaded = R.recent_predictions(pred, pay, 9).collect()
    shown = R.fmt_recent(pred, pay, only_fraud=True, head=50, loaded=9).collect()
    assert [r.trans_num for r in shown] == [r.trans_num for r in loaded if r.predicted_fraud]
