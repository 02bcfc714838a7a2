"""Registered feature queries (distance, age, time parts and flags, all features)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardsentry.operators import features as FE
from cardsentry.operators import serving as SV
from cardsentry.plans.catalog import Inputs, register
from cardsentry.plans.oracle import age_sql, clean_merchant_sql, flags_sql, haversine_sql, time_parts_sql
from cardsentry.schemas import FEED_DROP_COLUMNS, MODEL_FEATURES, NUMERIC_FEATURES
from cardsentry.sources.tables import FIXTURE_AGE_AS_OF

TS = "transaction_time"
_PARTS = time_parts_sql(TS)
_HAV = haversine_sql("lat", "long", "merch_lat", "merch_long")
_AGE = age_sql("dob")

_PAYMENT_COLS = ["id", "trans_num", "cc_num", "merchant", "category", "amt", "gender", "city", "state",
                 "zip", "city_pop", "lat", "long", "merch_lat", "merch_long", "dob", "is_fraud",
                 "transaction_time", "created_at"]
_PAYMENT_SQL = ", ".join("CAST(amt AS DOUBLE) AS amt" if c == "amt" else c for c in _PAYMENT_COLS)


def _payments(i: Inputs):
    return i.payments.select(*_PAYMENT_COLS).withColumn("amt", F.col("amt").cast("double"))


@register("feat_distance", f"SELECT trans_num, {_HAV} AS distance_km FROM payments")
def feat_distance(i: Inputs):
    return FE.add_distance(_payments(i)).select("trans_num", "distance_km")


@register("feat_age", f"SELECT trans_num, dob, {_AGE} AS age FROM payments")
def feat_age(i: Inputs):
    return FE.add_age(_payments(i), as_of=FIXTURE_AGE_AS_OF).select("trans_num", "dob", "age")


@register("feat_time_parts", "SELECT trans_num, " + ", ".join(f"{v} AS {k}" for k, v in _PARTS.items())
          + " FROM payments")
def feat_time_parts(i: Inputs):
    df = FE.add_time_features(_payments(i))
    return df.select("trans_num", *_PARTS.keys())


def _flags_query(variant: str):
    fl = flags_sql(TS, variant)
    sql = f"SELECT trans_num, {_PARTS['hour']} AS hour, " + ", ".join(f"{v} AS {k}" for k, v in fl.items()) \
        + " FROM payments"

    def fn(i: Inputs):
        df = FE.add_time_features(_payments(i), variant=variant)
        return df.select("trans_num", "hour", *fl.keys())

    register(f"feat_time_flags_{variant}", sql)(fn)


for _v in ("request", "stream", "training"):
    _flags_query(_v)


_REQ_FLAGS = flags_sql(TS, "request")
_ALL_FEATURES = {
    "age": _AGE, "distance_km": _HAV, "time": _PARTS["time"], "hour": _PARTS["hour"],
    **{k: _REQ_FLAGS[k] for k in ("is_night", "is_morning", "is_afternoon", "is_evening", "is_business_hour")},
    "year": _PARTS["year"], "month": _PARTS["month"], "day": _PARTS["day"],
    "dayofweek": _PARTS["dayofweek"], "is_we": _REQ_FLAGS["is_we"],
}
_ALL_FEATURES_SQL = ", ".join(f"{v} AS {k}" for k, v in _ALL_FEATURES.items())


@register("feat_all", f"SELECT {_PAYMENT_SQL}, {_ALL_FEATURES_SQL} FROM payments")
def feat_all(i: Inputs):
    return FE.add_features(_payments(i), as_of=FIXTURE_AGE_AS_OF)


_KEPT = [c for c in _PAYMENT_COLS if c not in FEED_DROP_COLUMNS]


@register("proj_drop_for_training",
          "SELECT " + ", ".join("CAST(amt AS DOUBLE) AS amt" if c == "amt" else c for c in _KEPT)
          + ", " + ", ".join(f"{v} AS {k}" for k, v in _ALL_FEATURES.items() if k not in FEED_DROP_COLUMNS)
          + " FROM payments")
def proj_drop_for_training(i: Inputs):
    return FE.drop_for_training(FE.add_features(_payments(i), as_of=FIXTURE_AGE_AS_OF))


_FEED_NUM = {c: f"TRY_CAST({c} AS DOUBLE)" for c in ("lat", "long", "merch_lat", "merch_long")}


@register("feat_coverage", f"""
SELECT count(*) AS n_rows, count({age_sql('dob')}) AS n_age,
  count({haversine_sql(_FEED_NUM['lat'], _FEED_NUM['long'], _FEED_NUM['merch_lat'], _FEED_NUM['merch_long'])})
    AS n_distance,
  count(hour(TRY_CAST(transaction_time AS TIMESTAMP))) AS n_time
FROM payments_feed
""")
def feat_coverage(i: Inputs):
    return FE.feature_coverage(FE.add_features(i.payments_feed, as_of=FIXTURE_AGE_AS_OF))


@register("clean_merchant", f"""
SELECT trans_num, merchant, {clean_merchant_sql('merchant')} AS merchant_clean FROM payments
""")
def clean_merchant(i: Inputs):
    return FE.clean_merchant(i.payments.select("trans_num", "merchant"), out="merchant_clean")


@register("feat_original_vs_engineered", """
SELECT trans_num, 19 AS n_original,
  'age,distance_km,time,hour,is_night,is_morning,is_afternoon,is_evening,is_business_hour,year,month,day,dayofweek,is_we'
    AS added_columns
FROM payments
""")
def feat_original_vs_engineered(i: Inputs):
    before = _payments(i)
    after = FE.add_features(before, as_of=FIXTURE_AGE_AS_OF)
    added = FE.added_columns(before, after)
    return after.select(
        "trans_num",
        F.lit(len(before.columns)).alias("n_original"),
        F.lit(",".join(added)).alias("added_columns"),
    )


@register("feat_original_engineered", "SELECT trans_num, " + ", ".join(
    [f"{'CAST(amt AS DOUBLE)' if c == 'amt' else c} AS original_{c}" for c in _PAYMENT_COLS if c != "trans_num"]
    + [f"{v} AS engineered_{k}" for k, v in _ALL_FEATURES.items()]) + " FROM payments")
def feat_original_engineered(i: Inputs):
    """The values of every row before and after feature derivation."""
    both = SV.original_and_engineered(_payments(i), as_of=FIXTURE_AGE_AS_OF)
    fields = {p: both.schema[p].dataType.names for p in ("original", "engineered")}
    return both.select("trans_num", *[
        F.col(p)[c].alias(f"{p}_{c}") for p, names in fields.items() for c in names if c != "trans_num"])


@register("proj_rename", """
SELECT trans_num, is_fraud AS is_fraud, fraud_probability FROM (
  SELECT trans_num, predicted_fraud AS is_fraud, fraud_probability FROM scored) t
""")
def proj_rename(i: Inputs):
    from cardsentry.plans.reports import scored_payments

    s = scored_payments(i.predictions, i.payments)
    return s.select("trans_num", "predicted_fraud", "fraud_probability").withColumnRenamed(
        "predicted_fraud", "is_fraud"
    )


_MODEL_SQL = ", ".join(
    ("TRY_CAST(" + (
        {"distance_km": _HAV, "age": _AGE, "hour": _PARTS["hour"], "year": _PARTS["year"],
         "month": _PARTS["month"], "day": _PARTS["day"], "dayofweek": _PARTS["dayofweek"]}.get(c)
        or _REQ_FLAGS.get(c) or c
    ) + f" AS DOUBLE) AS {c}") if c in NUMERIC_FEATURES else c
    for c in MODEL_FEATURES
)
_FEED_TYPED = """(SELECT trans_num, cc_num, merchant, category, amt, gender, state, zip, city_pop, dob,
    TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(long AS DOUBLE) AS long,
    TRY_CAST(merch_lat AS DOUBLE) AS merch_lat, TRY_CAST(merch_long AS DOUBLE) AS merch_long,
    TRY_CAST(transaction_time AS TIMESTAMP) AS transaction_time
  FROM payments_feed) f"""


@register("prep_model_features",
          f"SELECT trans_num, {_MODEL_SQL} FROM {_FEED_TYPED} WHERE transaction_time IS NOT NULL")
def prep_model_features(i: Inputs):
    df = FE.add_features(i.payments_feed, as_of=FIXTURE_AGE_AS_OF)
    return FE.model_features(df.where(FE.complete_time_features(df)), keep=["trans_num"])
