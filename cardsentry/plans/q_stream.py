"""Registered streaming queries. Each runs a real Structured Streaming query
(file source, ``foreachBatch`` writers, checkpoint in the shared folder)
over landed fixture files and returns what the target tables then hold; the
SQL twin is the batch result the stream must equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import dates
from cardsentry.operators import store as ST
from cardsentry.plans import reports as R
from cardsentry.plans.catalog import Inputs, register
from cardsentry.plans.oracle import clean_merchant_sql
from cardsentry.plans.q_quality import VALID_SQL, VIOLATIONS_SQL
from cardsentry.plans.q_store import _FIRST_VALID, _PAY_COLS, _PAY_SQL, ALERT_TIME, _training_twin
from cardsentry.sources import feed
from cardsentry.sources.storage import new_location
from cardsentry.sources.tables import FIXTURE_AGE_AS_OF
from cardsentry.streaming import stream as SS


def _files(i: Inputs) -> int:
    """Files of a landed batch, and of a micro-batch: one a task."""
    return i.spark.sparkContext.defaultParallelism


def _landed_feed(i: Inputs) -> str:
    if not hasattr(i, "_landing"):
        i._landing = SS.land_batches(i.payments_feed, new_location(i.spark, "landing_feed"), files=_files(i))
    return i._landing


def _read_feed(i: Inputs) -> DataFrame:
    """The landed feed as a stream: each batch a micro-batch."""
    return SS.read_landed(i.spark, _landed_feed(i), _files(i))


@register("stream_ingest", "SELECT batch_id, row_idx, trans_num, dob, transaction_time FROM payments_feed")
def stream_ingest(i: Inputs):
    bronze = ST.StoredRows.create(i.spark, "bronze_feed")
    SS.run(_read_feed(i), SS.raw_appender(bronze), "ingest")
    return bronze.read().select("batch_id", "row_idx", "trans_num", "dob", "transaction_time")


@register("stream_insert_ignore", f"SELECT {_PAY_SQL} FROM {_FIRST_VALID}")
def stream_insert_ignore(i: Inputs):
    target = ST.KeyedTable.create(i.spark, "payments_stream")
    refused = ST.StoredRows.create(i.spark, "payments_quarantine")
    SS.run(_read_feed(i), SS.payment_inserter(target, refused), "insert_ignore")
    return target.read().select(*_PAY_COLS).withColumn("amt", F.col("amt").cast("double"))


def _score_tables(i: Inputs):
    if not hasattr(i, "_scored_tables"):
        pay = ST.KeyedTable.create(i.spark, "payments_stream", stamp="created_at")
        pred = ST.KeyedTable.create(i.spark, "predictions_stream", stamp="predicted_at")
        alerts = ST.KeyedTable.create(i.spark, "alerts_stream")
        refused = ST.StoredRows.create(i.spark, "quarantine_stream")
        training = ST.KeyedTable.create(i.spark, "training_stream", stamp="created_at")
        writer = SS.score_and_alert(pay, pred, alerts, SS.lookup_scorer(i.spread_predictions),
                                    as_of=FIXTURE_AGE_AS_OF, alert_time=ALERT_TIME,
                                    quarantine=refused, training=training)
        SS.run(_read_feed(i), writer, "score_alert")
        i._scored_tables = (pay, pred, alerts)
        i._training_table = training
    return i._scored_tables


# ------------------------------------------------------------ split-JSON feed

# Documents of the first batch that are cut on the way, and those that come
# without their index; the rows of a document are numbered together.
_CUT, _BARE = "batch_id = 1 AND row_idx // 100 % 5 = 0", "row_idx // 100 % 5 = 1"
_SENT = ["trans_num", "cc_num", "merchant", "category", "amt", "gender", "city", "state", "zip", "lat", "long",
         "city_pop", "dob", "merch_lat", "merch_long", "is_fraud", "current_time"]


def _land_documents(i: Inputs) -> str:
    """The dirty feed as landed files of split-JSON documents, a batch after the
    other: some documents cut in half, some without index."""
    landing = new_location(i.spark, "landing_documents")
    time = F.col("transaction_time").cast("timestamp_ntz")
    rows = i.payments_feed.withColumn("current_time", dates.ntz_epoch(time, "MILLISECOND"))
    for b in (1, 2):
        docs = feed.encode_split_documents(rows.where(F.col("batch_id") == b), _SENT, "row_idx", rows_per_doc=100)
        kind = F.col("doc_id") % 5
        value = F.when(kind == 1, F.regexp_replace("value", r',\\"index\\":\[[0-9,]*\]', "")).otherwise(F.col("value"))
        if b == 1:
            value = F.when(kind == 0, F.expr("substring(value, 1, length(value) div 2)")).otherwise(value)
        docs.select(value.alias("value")).write.mode("append").text(landing)
    return landing


def _feed_tables(i: Inputs):
    if not hasattr(i, "_feed_run"):
        payments = ST.create_tables(i.spark, new_location(i.spark, "feed_tables"), parts=16)["payments"]
        refused = ST.StoredRows.create(i.spark, "feed_refused")
        broken = ST.StoredRows.create(i.spark, "feed_broken")
        SS.run(SS.read_feed(i.spark, _land_documents(i), 100), SS.feed_inserter(payments, refused, broken), "feed")
        i._feed_run = (payments, refused, broken)
    return i._feed_run


_MS_TEXT = ("strftime(make_timestamp((epoch_us(CAST(transaction_time AS TIMESTAMP)) // 1000) * 1000), "
            "'%Y-%m-%d %H:%M:%S.%g')")


@register("stream_feed_json", f"""
SELECT trans_num, cc_num, {clean_merchant_sql("merchant")} AS merchant, category,
  CAST(CAST(amt AS DECIMAL(10,2)) AS DOUBLE) AS amt, gender, city, state, zip, CAST(lat AS DOUBLE) AS lat,
  CAST(long AS DOUBLE) AS long, CAST(city_pop AS INTEGER) AS city_pop, dob, CAST(is_fraud AS INTEGER) AS is_fraud,
  {_MS_TEXT} AS transaction_time, true AS stamped
FROM (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY batch_id) AS rn FROM payments_feed
  WHERE NOT ({_CUT}) AND {VALID_SQL}) t WHERE rn = 1
""")
def stream_feed_json(i: Inputs):
    """The split-JSON feed as a stream into the declared payments table."""
    payments, _, _ = _feed_tables(i)
    return payments.read().select(
        "trans_num", "cc_num", "merchant", "category", F.col("amt").cast("double").alias("amt"), "gender", "city",
        "state", "zip", "lat", "long", "city_pop", "dob", "is_fraud",
        F.date_format(F.col("transaction_time").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSS").alias("transaction_time"),
        F.col("created_at").isNotNull().alias("stamped"),
    )


@register("stream_feed_refused", f"""
SELECT 'document' AS kind, 'not a JSON string' AS reason, count(DISTINCT row_idx // 100) AS n
FROM payments_feed WHERE {_CUT}
UNION ALL SELECT 'row', {VIOLATIONS_SQL}, count(*) FROM payments_feed
WHERE NOT ({_CUT}) AND NOT ({VALID_SQL}) GROUP BY 2
""")
def stream_feed_refused(i: Inputs):
    """What the feed stream refused: whole documents and single rows, by reason."""
    _, refused, broken = _feed_tables(i)
    n = F.count(F.lit(1)).alias("n")
    rows = refused.read().groupBy(F.lit("row").alias("kind"), F.col("violations").alias("reason")).agg(n)
    return broken.read().groupBy(F.lit("document").alias("kind"), "reason").agg(n).unionByName(rows)


# ------------------------------------------------------------ one set of tables

_REPORTED = f"""(SELECT fv.trans_num, fv.state, fv.is_fraud, CAST(CAST(fv.amt AS DECIMAL(10,2)) AS DOUBLE) AS amt,
  p.fraud_probability AS p FROM {_FIRST_VALID} LEFT JOIN predictions p ON p.trans_num = fv.trans_num)"""


@register("stored_tables_report", f"""
SELECT 'payments' AS fact, CAST(count(*) AS DOUBLE) AS value FROM {_REPORTED} a
UNION ALL SELECT 'training_data', count(*) FROM {_REPORTED} b
UNION ALL SELECT 'predictions', count(p) FROM {_REPORTED} c
UNION ALL SELECT 'fraud_alerts', count_if(p > 0.5) FROM {_REPORTED} d
UNION ALL SELECT 'true frauds', count_if(CAST(is_fraud AS INTEGER) = 1) FROM {_REPORTED} e
UNION ALL SELECT 'total amount', round(sum(amt), 2) FROM {_REPORTED} f
UNION ALL SELECT 'pending alerts', count_if(p > 0.5) FROM {_REPORTED} g
UNION ALL SELECT 'training rows', count(p) FROM {_REPORTED} h
UNION ALL SELECT * FROM (SELECT 'frauds in ' || state, CAST(count(*) AS DOUBLE) FROM {_REPORTED} k WHERE p > 0.5
  GROUP BY state ORDER BY count(*) DESC, state LIMIT 10) m
""")
def stored_tables_report(i: Inputs):
    """Declared tables are created, the feed streams into them with scores,
    alerts and training rows, and the reports read these same tables."""
    t = ST.create_tables(i.spark, new_location(i.spark, "declared_tables"), parts=8)
    writer = SS.score_and_alert(
        t["payments"], t["predictions"], t["fraud_alerts"], SS.lookup_scorer(i.spread_predictions), as_of=FIXTURE_AGE_AS_OF,
        alert_time=ALERT_TIME, quarantine=ST.StoredRows.create(i.spark, "declared_refused"), training=t["training_data"])
    SS.run(SS.read_landed(i.spark, _landed_feed(i), 100), writer, "declared")
    rows = {name: table.read() for name, table in t.items()}
    scored = R.scored_payments(rows["predictions"], rows["payments"])

    def fact(df, name, column):
        return df.select(F.lit(name).alias("fact") if isinstance(name, str) else name.alias("fact"),
                         F.col(column).cast("double").alias("value"))

    counts = [fact(df.agg(F.count(F.lit(1)).alias("n")), name, "n") for name, df in rows.items()]
    kpi = R.kpi_totals(rows["payments"])
    parts = counts + [
        fact(kpi, "true frauds", "total_frauds"), fact(kpi, "total amount", "total_amount"),
        fact(R.alert_totals(rows["fraud_alerts"]), "pending alerts", "pending"),
        fact(R.train_extract_summary(rows["predictions"], rows["training_data"]), "training rows", "n_rows"),
        fact(R.frauds_by(scored, "state"), F.concat(F.lit("frauds in "), F.col("state")), "n_frauds"),
    ]
    return reduce(DataFrame.unionByName, parts)


_RISK = ("CASE WHEN p.fraud_probability < 0.3 THEN 'LOW' WHEN p.fraud_probability < 0.6 THEN 'MEDIUM' "
         "WHEN p.fraud_probability < 0.8 THEN 'HIGH' ELSE 'CRITICAL' END")


@register("stream_score", f"""
SELECT fv.trans_num, p.fraud_probability > 0.5 AS is_fraud, p.fraud_probability, {_RISK} AS risk_level,
  round(abs(p.fraud_probability - 0.5) * 2, 4) AS confidence
FROM {_FIRST_VALID} JOIN predictions p ON p.trans_num = fv.trans_num
""")
def stream_score(i: Inputs):
    _, pred, _ = _score_tables(i)
    return pred.read().select("trans_num", "is_fraud", "fraud_probability", "risk_level", "confidence")


@register("stream_alerts", f"""
SELECT fv.trans_num, false AS email_sent, CAST(NULL AS TIMESTAMP) AS email_sent_at,
  TIMESTAMP '{ALERT_TIME.isoformat(sep=" ")}' AS created_at
FROM {_FIRST_VALID} JOIN predictions p ON p.trans_num = fv.trans_num WHERE p.fraud_probability > 0.5
""")
def stream_alerts(i: Inputs):
    _, _, alerts = _score_tables(i)
    return alerts.read().select("trans_num", "email_sent", "email_sent_at", "created_at")


@register("stream_training", _training_twin())
def stream_training(i: Inputs):
    """Training rows that the stream writes beside its predictions."""
    _score_tables(i)
    return i._training_table.read().drop("created_at").withColumn("amt", F.col("amt").cast("double"))


@register("stream_daily_counts", """
SELECT CAST(predicted_at AS DATE) AS day, is_fraud AS predicted_fraud, count(*) AS n
FROM predictions GROUP BY 1, 2
""")
def stream_daily_counts(i: Inputs):
    """Predictions land in order of time; each micro-batch updates its days."""
    return _daily_counts(i.spark, i.spread_predictions)


def _daily_counts(spark, rows: DataFrame) -> DataFrame:
    landing, out = new_location(spark, "landing_predictions"), new_location(spark, "daily_counts")
    checkpoint = new_location(spark, "checkpoint_daily_counts")

    def count_landed() -> None:
        # all files of a piece in one micro-batch: each of them holds rows of all its
        # days, and a part of them would move the watermark past the others' rows
        counts = SS.daily_counts_stream(SS.read_landed(spark, landing, SS.ALL_FILES))
        SS.run(counts, SS.daily_upserter(out), "daily_counts", output_mode="update", checkpoint=checkpoint)

    SS.land_in_order(rows, landing, "predicted_at", landed=count_landed)
    return SS.read_daily(spark, out)


@register("stream_score_model")
def stream_score_model(i: Inputs):
    """The feed stream scored by the fitted forest (preprocessing + model
    loaded once, applied to every micro-batch); no SQL twin."""
    from cardsentry.plans.q_ml import _fitted

    model = _fitted(i)
    pay = ST.KeyedTable.create(i.spark, "payments_model_stream")
    pred = ST.KeyedTable.create(i.spark, "predictions_model_stream")
    alerts = ST.KeyedTable.create(i.spark, "alerts_model_stream")
    writer = SS.score_and_alert(pay, pred, alerts, SS.model_scorer(model), as_of=FIXTURE_AGE_AS_OF,
                                alert_time=ALERT_TIME, quarantine=ST.StoredRows.create(i.spark, "quarantine_model_stream"))
    SS.run(_read_feed(i), writer, "score_model")
    return pred.read().select("trans_num", "is_fraud", "fraud_probability", "risk_level", "confidence")


@register("stream_score_model_same", f"SELECT trans_num, true AS same FROM {_FIRST_VALID}")
def stream_score_model_same(i: Inputs):
    """Whether the stream gave each stored payment the score of a batch job
    over the same rows and model."""
    from cardsentry.plans.q_ml import _fitted
    from cardsentry.plans.q_quality import typed_good

    streamed = stream_score_model(i).select("trans_num", F.col("fraud_probability").alias("streamed"))
    rows = ST.first_arrival(typed_good(i))
    batch = SS.scored_rows(rows, SS.model_scorer(_fitted(i)), FIXTURE_AGE_AS_OF)
    both = batch.select("trans_num", "fraud_probability").join(streamed, "trans_num")
    return both.select("trans_num", (F.col("fraud_probability") == F.col("streamed")).alias("same"))
