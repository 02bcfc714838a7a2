"""Registered source queries: history CSV and split-orient JSON feed, each
written from the fixture payments to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardsentry.functions import dates
from cardsentry.plans.catalog import Inputs, register
from cardsentry.plans.oracle import clean_merchant_sql
from cardsentry.sources import feed
from cardsentry.sources.storage import new_location

_FEED_COLS = ["trans_num", "cc_num", "merchant", "category", "amt", "gender", "city", "state", "zip", "lat",
              "long", "city_pop", "dob", "merch_lat", "merch_long", "is_fraud", "current_time"]


@register("src_csv_history", """
SELECT strftime(transaction_time, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time, cc_num, merchant, category,
  CAST(amt AS DOUBLE) AS amt, CAST(NULL AS VARCHAR) AS first, CAST(NULL AS VARCHAR) AS last, gender,
  CAST(NULL AS VARCHAR) AS street, city, state, zip, lat, long, city_pop, CAST(NULL AS VARCHAR) AS job, dob,
  trans_num, epoch_us(transaction_time) // 1000000 AS unix_time, merch_lat, merch_long, is_fraud
FROM payments
""")
def src_csv_history(i: Inputs):
    path = feed.write_history_csv(i.payments, new_location(i.spark, "history_csv"))
    return feed.read_history_csv(i.spark, path)


# Lines that are cut in half on the way, and ones whose amount is no number.
_CUT, _WRONG = "id % 7 = 0", "id % 11 = 1"


@register("src_csv_quarantine", f"""
SELECT CASE WHEN {_CUT} OR {_WRONG} THEN 'damaged' ELSE 'sound' END AS state, count(*) AS n,
  round(sum(CASE WHEN NOT ({_CUT} OR {_WRONG}) THEN CAST(amt AS DOUBLE) END), 2) AS amount
FROM payments GROUP BY 1
""")
def src_csv_quarantine(i: Inputs):
    """A history CSV with damaged lines: sound rows, and the lines set apart."""
    path, sent = feed.write_history_csv(i.payments, new_location(i.spark, "history_csv")), new_location(i.spark, "sent_csv")
    line, id_ = F.col("value"), F.regexp_extract("value", "^([0-9]+),", 1).try_cast("bigint")
    damaged = F.when(id_ % 7 == 0, F.expr("substring(value, 1, length(value) div 2)")).when(
        id_ % 11 == 1, F.regexp_replace("value", ",[0-9.]+,,,", ",many,,,")).otherwise(line)
    i.spark.read.text(path).select(damaged.alias("value")).write.text(sent)
    sound, lost = feed.split_history_csv(i.spark, sent)
    n = F.count(F.lit(1)).alias("n")
    return sound.agg(n, F.round(F.sum("amt"), 2).alias("amount")).select(F.lit("sound").alias("state"), "n", "amount").unionByName(
        lost.agg(n).select(F.lit("damaged").alias("state"), "n", F.lit(None).cast("double").alias("amount")))


def _feed_lines(i: Inputs):
    pay = i.spread_payments.withColumn("current_time", dates.ntz_epoch(F.col("transaction_time"), "MILLISECOND"))
    lines = feed.encode_split_documents(pay, _FEED_COLS, "id", rows_per_doc=100)
    path = new_location(i.spark, "feed_json")
    lines.select("value").write.text(path)
    return i.spark.read.text(path)


@register("feed_quarantine", """
SELECT CASE WHEN d % 5 = 0 THEN 'not a JSON string' ELSE 'not a split document' END AS reason, count(*) AS n
FROM (SELECT DISTINCT id // 100 AS d FROM payments) t WHERE d % 5 < 2 GROUP BY 1
""")
def feed_quarantine(i: Inputs):
    """Two of five documents are damaged on the way (cut in half, or replaced
    by other text); the quarantine holds exactly these."""
    pay = i.payments.withColumn("current_time", dates.ntz_epoch(F.col("transaction_time"), "MILLISECOND"))
    docs = feed.encode_split_documents(pay, _FEED_COLS, "id", rows_per_doc=100)
    kind = F.col("doc_id") % 5
    damaged = F.when(kind == 0, F.expr("substring(value, 1, length(value) div 2)")).when(
        kind == 1, F.lit('"no document"')).otherwise(F.col("value"))
    path = new_location(i.spark, "feed_json")
    docs.select(damaged.alias("value")).write.text(path)
    return feed.broken_documents(i.spark.read.text(path)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_MS = "make_timestamp((epoch_us(transaction_time) // 1000) * 1000)"


@register("src_json_split", f"""
SELECT trans_num, cc_num, {clean_merchant_sql('merchant')} AS merchant, category, CAST(amt AS DOUBLE) AS amt,
  gender, city, state, zip, lat, long, city_pop, dob, merch_lat, merch_long, is_fraud,
  {_MS} AS transaction_time
FROM payments
""")
def src_json_split(i: Inputs):
    df = feed.extract_feed(_feed_lines(i))
    cols = [c for c in _FEED_COLS if c != "current_time"] + ["transaction_time"]
    return df.select(*cols)


@register("src_feed_time", f"""
SELECT trans_num, {_MS} AS transaction_time, strftime({_MS}, '%Y-%m-%d %H:%M:%S.%g') AS transaction_time_text
FROM payments
""")
def src_feed_time(i: Inputs):
    df = feed.feed_time(feed.decode_split_documents(_feed_lines(i)))
    return df.select("trans_num", "transaction_time", "transaction_time_text")


# ------------------------------------------------------------ notebook history path

_HIST_TS = "TRY_CAST(trans_date_trans_time AS TIMESTAMP)"


def _history_twin() -> str:
    from cardsentry.plans.oracle import age_sql, flags_sql, haversine_sql, time_parts_sql

    parts = time_parts_sql(_HIST_TS)
    fl = flags_sql(_HIST_TS, "training")
    cols = ["cc_num", f"{clean_merchant_sql('merchant')} AS merchant", "category", "CAST(amt AS DOUBLE) AS amt",
            "gender", "state", "zip", "city_pop", "is_fraud",
            f"{age_sql('dob')} AS age", f"{haversine_sql('lat', 'long', 'merch_lat', 'merch_long')} AS distance_km",
            f"{parts['hour']} AS hour"]
    cols += [f"{fl[k]} AS {k}" for k in ("is_night", "is_morning", "is_afternoon", "is_evening",
                                         "is_business_hour")]
    cols += [f"{parts[k]} AS {k}" for k in ("year", "month", "day", "dayofweek")] + [f"{fl['is_we']} AS is_we"]
    return ("SELECT " + ", ".join(cols) + " FROM (SELECT strftime(transaction_time, '%Y-%m-%d %H:%M:%S') AS "
            "trans_date_trans_time, * EXCLUDE (transaction_time) FROM payments) h")


@register("history_features", _history_twin())
def history_features(i: Inputs):
    """The training notebook's path: history CSV -> merchant cleaning ->
    features with the ``training`` flag variant -> drop the 14 raw columns."""
    from cardsentry.operators import features as FE
    from cardsentry.schemas import HISTORY_DROP_COLUMNS
    from cardsentry.sources.tables import FIXTURE_AGE_AS_OF

    path = feed.write_history_csv(i.payments, new_location(i.spark, "history_csv"))
    hist = FE.clean_merchant(feed.read_history_csv(i.spark, path))
    feats = FE.add_distance(FE.add_age(hist, as_of=FIXTURE_AGE_AS_OF))
    feats = FE.add_time_features(feats, time_col="trans_date_trans_time", variant="training")
    return FE.drop_for_training(feats, HISTORY_DROP_COLUMNS)
