"""Table scans and the fixture views derived from the driver's test tables.

The stored tables of the fraud application (``payments``, ``predictions``,
``training_data``, ``fraud_alerts``) and a dirty feed (``payments_feed``) are
derived from ``events``, ``customer``, ``nation`` and ``supplier`` so that
every query's work grows with the input tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions import dates, geo, text

# Age and report dates pinned so results do not change by the day.
FIXTURE_AGE_AS_OF = _dt.date(2026, 1, 29)
FIXTURE_REPORT_DATE = _dt.date(2024, 1, 15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table; column pruning and filters reach the Parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dbl(x) -> Column:
    return F.lit(x).cast("double")


def payments(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One payment per event: card holder from ``customer``/``nation``,
    merchant from ``supplier`` (``event_id mod |supplier|``).

    ``spread`` shuffles the events into both joins, for jobs that write the rows
    out: the work is then dealt to all tasks, however few files or row groups
    ``events`` has, and neither customers nor suppliers pass through the driver."""
    e = read_table(spark, sf_dir, "events")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    s = read_table(spark, sf_dir, "supplier")
    n_suppliers = s.select(F.count(F.lit(1))).scalar()
    # nation is the fixed 25-row TPC-H dimension: broadcasting it is bounded.
    # customer and supplier grow with the scale factor, so the planner (AQE,
    # on measured sizes) decides between broadcast and sort-merge for them.
    holders = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name"
    )
    merchants = s.select("s_suppkey", "s_name")
    if spread:
        holders, merchants = holders.hint("merge"), merchants.hint("merge")
    ev = e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        (F.col("event_id") % n_suppliers).alias("supp_key"),
    )
    j = ev.join(holders, ev.user_id == holders.c_custkey).join(
        merchants, F.col("supp_key") == F.col("s_suppkey")
    )
    ck = F.col("c_custkey")
    eid = F.col("event_id")
    lat = _dbl(24.5) + ((ck * 37) % 2500).cast("double") / _dbl(100)
    lon = _dbl(-66.5) - ((ck * 53) % 5800).cast("double") / _dbl(100)
    return j.select(
        eid.alias("id"),
        F.concat(F.lit("T"), eid.cast("string")).alias("trans_num"),
        F.col("user_id").cast("string").alias("cc_num"),
        F.concat(F.lit("fraud_"), F.col("s_name")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("value").cast("decimal(10,2)").alias("amt"),
        F.when(ck % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("c_mktsegment").alias("city"),
        F.col("n_name").alias("state"),
        (F.lit(10000) + ck % 89999).cast("string").alias("zip"),
        (F.lit(1000) + (ck * 7919) % 1000000).cast("int").alias("city_pop"),
        lat.alias("lat"),
        lon.alias("long"),
        (lat + ((eid * 41) % 200 - 100).cast("double") / _dbl(100)).alias("merch_lat"),
        (lon + ((eid * 59) % 200 - 100).cast("double") / _dbl(100)).alias("merch_long"),
        F.date_add(F.lit(_dt.date(1940, 1, 1)), ((ck * 97) % 22000).cast("int"))
        .cast("string")
        .alias("dob"),
        F.when(eid % 50 == 0, 1).otherwise(0).alias("is_fraud"),
        F.col("ts").alias("transaction_time"),
        F.col("ts").alias("created_at"),
    )


def predictions(spark: SparkSession, sf_dir: str, pay: DataFrame | None = None) -> DataFrame:
    """Scores for 9 of 10 payments; label = probability > 0.5."""
    pay = payments(spark, sf_dir) if pay is None else pay
    k = (F.col("id") * 7919) % 1001
    p = (k * k).cast("double") / _dbl(1000000)
    return (
        pay.where(F.col("id") % 10 != 3)
        .select("id", "trans_num", "created_at", p.alias("p"))
        .select(
            "id",
            "trans_num",
            (F.col("p") > _dbl(0.5)).alias("is_fraud"),
            F.col("p").alias("fraud_probability"),
            (F.col("created_at") + F.expr("INTERVAL 20 SECONDS")).alias("predicted_at"),
        )
    )


def training_data(spark: SparkSession, sf_dir: str, pay: DataFrame | None = None) -> DataFrame:
    """Six of seven payments with the engineered features of the feed path."""
    pay = payments(spark, sf_dir) if pay is None else pay
    rows = pay.where(F.col("id") % 7 != 0)
    ts = F.col("transaction_time")
    flags = dates.time_flags(F.hour(ts), F.weekday(ts), variant="stream")
    return rows.select(
        "id",
        "trans_num",
        "cc_num",
        text.clean_merchant(F.col("merchant")).alias("merchant"),
        "category",
        "amt",
        "gender",
        "state",
        "zip",
        "city_pop",
        geo.haversine_km("lat", "long", "merch_lat", "merch_long").alias("distance_km"),
        dates.age_years(F.col("dob"), FIXTURE_AGE_AS_OF).alias("age"),
        F.hour(ts).alias("hour"),
        flags["is_business_hour"].alias("is_business_hour"),
        flags["is_morning"].alias("is_morning"),
        flags["is_afternoon"].alias("is_afternoon"),
        flags["is_evening"].alias("is_evening"),
        flags["is_night"].alias("is_night"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.weekday(ts).alias("dayofweek"),
        flags["is_we"].alias("is_we"),
        "is_fraud",
        "created_at",
    )


def fraud_alerts(spark: SparkSession, sf_dir: str, pay: DataFrame | None = None,
                 pred: DataFrame | None = None) -> DataFrame:
    """Alerts for every scored fraud, plus unscored payments (``id mod 100 = 3``)
    so that the alert-to-prediction LEFT join meets missing probabilities."""
    pay = payments(spark, sf_dir) if pay is None else pay
    pred = predictions(spark, sf_dir, pay) if pred is None else pred
    scored = pred.where("is_fraud").select(
        "id",
        "trans_num",
        (F.col("id") % 3 == 0).alias("email_sent"),
        F.when(F.col("id") % 3 == 0, F.col("predicted_at") + F.expr("INTERVAL 1 SECONDS"))
        .alias("email_sent_at"),
        F.col("predicted_at").alias("created_at"),
    )
    unscored = pay.where(F.col("id") % 100 == 3).select(
        "id",
        "trans_num",
        F.lit(False).alias("email_sent"),
        F.lit(None).cast("timestamp_ntz").alias("email_sent_at"),
        "created_at",
    )
    return scored.unionByName(unscored)


FEED_COLUMNS = [
    "id", "trans_num", "cc_num", "merchant", "category", "amt", "gender", "city",
    "state", "zip", "city_pop", "lat", "long", "merch_lat", "merch_long", "dob",
    "is_fraud", "transaction_time",
]


def payments_feed(spark: SparkSession, sf_dir: str, pay: DataFrame | None = None) -> DataFrame:
    """Dirty text-typed feed: every 20th payment arrives twice (second
    batch), with range, sign, empty-date and null-time defects."""
    pay = payments(spark, sf_dir) if pay is None else pay
    i = F.col("id")
    base = pay.select(
        i.alias("row_idx"),
        *[
            (
                F.when(i % 97 == 0, F.col("lat") + _dbl(100)).otherwise(F.col("lat"))
                if c == "lat"
                else F.when(i % 101 == 0, -F.col("amt")).otherwise(F.col("amt"))
                if c == "amt"
                else F.when(i % 89 == 0, F.lit("")).otherwise(F.col("dob"))
                if c == "dob"
                else F.when(i % 83 == 0, F.lit(None)).otherwise(
                    F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                )
                if c == "transaction_time"
                else F.col(c)
            )
            .cast("string")
            .alias(c)
            for c in FEED_COLUMNS
        ],
    )
    first = base.select(F.lit(1).alias("batch_id"), "*")
    again = base.where(i % 20 == 0).select(F.lit(2).alias("batch_id"), "*")
    return first.unionByName(again)


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register the fixture views as temp views; returns them by name."""
    pay = payments(spark, sf_dir)
    pred = predictions(spark, sf_dir, pay)
    views = {
        "payments": pay,
        "predictions": pred,
        "training_data": training_data(spark, sf_dir, pay),
        "fraud_alerts": fraud_alerts(spark, sf_dir, pay, pred),
        "payments_feed": payments_feed(spark, sf_dir, pay),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
