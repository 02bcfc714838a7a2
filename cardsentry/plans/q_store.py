"""Registered sink queries: each writes real Parquet tables under the shared
folder and returns what a reader of the target then sees."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from cardsentry.operators import features as FE
from cardsentry.operators import store as ST
from cardsentry.plans import reports as R
from cardsentry.plans.catalog import Inputs, register
from cardsentry.plans.q_quality import VALID_SQL, typed_good
from cardsentry.plans.q_reports import _DAILY
from cardsentry.schemas import FEED_DROP_COLUMNS
from cardsentry.sources.storage import materialize, new_location
from cardsentry.sources.tables import FIXTURE_AGE_AS_OF, FIXTURE_REPORT_DATE

ALERT_TIME = _dt.datetime(2024, 1, 31, 0, 0, 0)

_PAY_COLS = ["id", "trans_num", "cc_num", "merchant", "category", "amt", "gender", "city", "state", "zip",
             "city_pop", "lat", "long", "merch_lat", "merch_long", "dob", "is_fraud", "transaction_time"]

_FIRST_VALID = f"""(SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY batch_id, row_idx) AS rn
    FROM payments_feed WHERE {VALID_SQL}) t WHERE rn = 1) fv"""

_PAY_SQL = """CAST(id AS BIGINT) AS id, trans_num, cc_num, merchant, category,
  CAST(CAST(amt AS DECIMAL(10,2)) AS DOUBLE) AS amt, gender, city, state, zip,
  CAST(city_pop AS INTEGER) AS city_pop, CAST(lat AS DOUBLE) AS lat, CAST(long AS DOUBLE) AS long,
  CAST(merch_lat AS DOUBLE) AS merch_lat, CAST(merch_long AS DOUBLE) AS merch_long, dob,
  CAST(is_fraud AS INTEGER) AS is_fraud, transaction_time"""


def _batches(i: Inputs) -> list:
    """The feed's batches in arrival order."""
    return [r[0] for r in i.payments_feed.select("batch_id").distinct().orderBy("batch_id").collect()]


def _load_payments(i: Inputs) -> tuple[ST.KeyedTable, dict]:
    """Feed batches, in arrival order, inserted into a fresh payments table,
    and how many rows the writer inserted of each."""
    good = typed_good(i)
    target = ST.KeyedTable.create(i.spark, "payments", stamp="created_at")
    return target, {b: target.insert_ignore(good.where(F.col("batch_id") == b)) for b in _batches(i)}


@register("sink_payments_insert_ignore", f"SELECT {_PAY_SQL} FROM {_FIRST_VALID}")
def sink_payments_insert_ignore(i: Inputs):
    t, _ = _load_payments(i)
    return t.read().select(*_PAY_COLS).withColumn("amt", F.col("amt").cast("double"))


_V = f"(SELECT batch_id, trans_num, {VALID_SQL} AS ok FROM payments_feed)"


@register("sink_insert_counts", f"""
SELECT v.batch_id, count(*) AS n_rows, CAST(count_if(NOT v.ok) AS BIGINT) AS n_invalid,
  coalesce(max(ins.n_inserted), 0) AS n_inserted,
  CAST(count(*) - count_if(NOT v.ok) - coalesce(max(ins.n_inserted), 0) AS BIGINT) AS n_skipped
FROM {_V} v LEFT JOIN (
  SELECT b AS batch_id, count(*) AS n_inserted
  FROM (SELECT trans_num, min(batch_id) AS b FROM {_V} x WHERE ok GROUP BY trans_num) f GROUP BY b
) ins ON v.batch_id = ins.batch_id
GROUP BY v.batch_id
""")
def sink_insert_counts(i: Inputs):
    feed = i.payments_feed
    from cardsentry.operators.quality import with_violations

    v = with_violations(feed).select("batch_id", (F.size("violations") == 0).alias("ok"))
    stats = v.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("ok")).alias("n_invalid")
    )
    _, counts = _load_payments(i)  # as counted by the writes themselves
    ins = i.spark.createDataFrame(list(counts.items()), "batch_id int, n_inserted bigint")
    return stats.join(ins, "batch_id", "left").select(
        "batch_id", "n_rows", "n_invalid",
        F.coalesce("n_inserted", F.lit(0)).alias("n_inserted"),
        (F.col("n_rows") - F.col("n_invalid") - F.coalesce("n_inserted", F.lit(0))).alias("n_skipped"),
    )


# SQL twin of the stored training rows: features of the first valid arrival.
def _training_twin() -> str:
    from cardsentry.plans.oracle import age_sql, clean_merchant_sql, flags_sql, haversine_sql, time_parts_sql

    ts = "CAST(transaction_time AS TIMESTAMP)"
    parts = time_parts_sql(ts)
    fl = flags_sql(ts, "stream")
    hav = haversine_sql("CAST(lat AS DOUBLE)", "CAST(long AS DOUBLE)",
                        "CAST(merch_lat AS DOUBLE)", "CAST(merch_long AS DOUBLE)")
    keep = [c for c in _PAY_COLS if c not in FEED_DROP_COLUMNS]
    sel = {
        "id": "CAST(id AS BIGINT)", "amt": "CAST(CAST(amt AS DECIMAL(10,2)) AS DOUBLE)",
        "city_pop": "CAST(city_pop AS INTEGER)", "is_fraud": "CAST(is_fraud AS INTEGER)",
        "merchant": clean_merchant_sql("merchant"),
    }
    cols = [f"{sel.get(c, c)} AS {c}" for c in keep]
    cols += [f"{age_sql('dob')} AS age", f"{hav} AS distance_km"]
    cols += [f"{parts['hour']} AS hour"] + [f"{v} AS {k}" for k, v in fl.items() if k != "is_we"]
    cols += [f"{parts[k]} AS {k}" for k in ("year", "month", "day", "dayofweek")]
    cols += [f"{fl['is_we']} AS is_we"]
    return f"SELECT {', '.join(cols)} FROM {_FIRST_VALID}"


@register("sink_training_insert_ignore", _training_twin())
def sink_training_insert_ignore(i: Inputs):
    payments, _ = _load_payments(i)
    good = typed_good(i)
    feats = FE.add_features(good, as_of=FIXTURE_AGE_AS_OF, variant="stream")
    feats = FE.clean_merchant(FE.drop_for_training(feats))
    # foreign key: only rows whose payment is stored
    feats = feats.join(payments.read().select("trans_num"), "trans_num", "left_semi")
    t = ST.KeyedTable.create(i.spark, "training_data")
    for b in _batches(i):
        t.insert_ignore(feats.where(F.col("batch_id") == b))
    return t.read().withColumn("amt", F.col("amt").cast("double"))


@register("sink_predictions_atomic", """
SELECT 1 AS attempt, true AS written, count(*) AS n_rows FROM predictions
UNION ALL SELECT 2, false, count(*) FROM predictions
""")
def sink_predictions_atomic(i: Inputs):
    """First append of the scored batch succeeds; replaying it is refused
    as a whole (one duplicate key fails the batch)."""
    batch = i.predictions.select("trans_num", "is_fraud", "fraud_probability", "predicted_at")
    t = ST.KeyedTable.create(i.spark, "predictions")
    first = t.append_atomic(batch)
    second = t.append_atomic(batch)
    stored = t.read()
    return (
        stored.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(1).alias("attempt"), F.lit(first).alias("written"), "n_rows")
        .unionByName(stored.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(2).alias("attempt"), F.lit(second).alias("written"), "n_rows"))
    )


_BATCH_COUNTS = """count(*) AS scored, count_if(id % 20 = 0) AS again, count_if(id % 50 = 0) AS strange,
  count_if(id % 33 = 0) AS unlabelled FROM predictions"""


@register("sink_predictions_checked", f"""
SELECT 1 AS attempt, CAST(scored AS BIGINT) AS inserted, CAST(again AS BIGINT) AS duplicate,
  CAST(strange AS BIGINT) AS orphan, CAST(unlabelled AS BIGINT) AS incomplete FROM (SELECT {_BATCH_COUNTS}) a
UNION ALL SELECT 2, 0, CAST(scored + again AS BIGINT), CAST(strange AS BIGINT), CAST(unlabelled AS BIGINT)
FROM (SELECT {_BATCH_COUNTS}) b
""")
def sink_predictions_checked(i: Inputs):
    """A batch with repeated, unknown and unlabelled rows written twice against
    the stored payments: what became of its rows."""
    t = ST.create_tables(i.spark, new_location(i.spark, "checked_tables"), parts=8)
    t["payments"].insert_ignore(i.payments, order_cols=())
    rows = i.predictions
    batch = rows.unionByName(rows.where("id % 20 = 0")).unionByName(
        rows.where("id % 50 = 0").withColumn("trans_num", F.concat(F.lit("X"), "trans_num"))).unionByName(
        rows.where("id % 33 = 0").withColumn("is_fraud", F.lit(None).cast("boolean")))
    batch = materialize(batch, "checked_batch")
    refused = ST.StoredRows.create(i.spark, "checked_refused")
    out = [(k, t["predictions"].insert_checked(batch, t["payments"], refused, k)) for k in (1, 2)]
    states = ("inserted", "duplicate", "orphan", "incomplete")
    return i.spark.createDataFrame([(k, *[c[s] for s in states]) for k, c in out],
                                   "attempt int, " + ", ".join(f"{s} bigint" for s in states))


@register("sink_fraud_alerts", f"""
SELECT trans_num, false AS email_sent, CAST(NULL AS TIMESTAMP) AS email_sent_at,
  TIMESTAMP '{ALERT_TIME.isoformat(sep=" ")}' AS created_at
FROM predictions WHERE is_fraud
""")
def sink_fraud_alerts(i: Inputs):
    """Alerts for predicted frauds; a replayed batch inserts nothing new."""
    scored = i.predictions.select("trans_num", F.col("is_fraud").cast("int").alias("is_fraud_pred"))
    t = ST.KeyedTable.create(i.spark, "fraud_alerts")
    for _ in range(2):
        t.insert_ignore(ST.alerts_from_scores(scored, ALERT_TIME), order_cols=())
    return t.read()


@register("sink_csv_roundtrip", _DAILY.replace("td.amt,", "CAST(td.amt AS DOUBLE) AS amt,"))
def sink_csv_roundtrip(i: Inputs):
    """Daily report written as CSV with a header, read back with its schema."""
    rows = R.daily_report_rows(i.predictions, i.training_data, FIXTURE_REPORT_DATE)
    rows = rows.withColumn("amt", F.col("amt").cast("double"))
    path = ST.export_csv(rows, new_location(i.spark, "daily_report_csv"))
    return i.spark.read.schema(rows.schema).option("header", True).csv(path)


@register("cascade_delete", """
SELECT 'payments' AS table_name, count(*) AS n_rows FROM payments WHERE category <> 'error'
UNION ALL SELECT 'training_data', count(*) FROM training_data
  WHERE trans_num IN (SELECT trans_num FROM payments WHERE category <> 'error')
UNION ALL SELECT 'predictions', count(*) FROM predictions
  WHERE trans_num IN (SELECT trans_num FROM payments WHERE category <> 'error')
UNION ALL SELECT 'fraud_alerts', count(*) FROM fraud_alerts
  WHERE trans_num IN (SELECT trans_num FROM payments WHERE category <> 'error')
""")
def cascade_delete(i: Inputs):
    """Delete the 'error' payments; children follow (rewritten tables)."""
    parent, children = ST.cascade_delete(
        i.payments,
        {"training_data": i.training_data, "predictions": i.predictions, "fraud_alerts": i.fraud_alerts},
        F.col("category") != "error",
    )
    out = None
    for name, df in [("payments", parent), *children.items()]:
        path = new_location(i.spark, f"cascade_{name}")
        df.write.parquet(path)
        part = i.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out
