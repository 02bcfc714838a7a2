"""One call from raw rows to verdicts."""

import datetime as dt

from pyspark.sql import functions as F

from cardsentry.operators import serving as SV

AS_OF = dt.date(2026, 1, 29)
GOOD = ("T1", "374125201044065", "fraud_Shop", "misc", "12.5", "F", "NY", "10001", "40.0", "-74.0", "100", "40.1",
        "-74.1", "1990-01-01", "2026-01-29 14:30:00")
NAMES = ("trans_num cc_num merchant category amt gender state zip lat long city_pop merch_lat merch_long dob "
         "transaction_time").split()


def _rows(spark, *changes):
    rows = [tuple({**dict(zip(NAMES, GOOD)), **c}[n] for n in NAMES) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES))


def test_every_row_gets_a_verdict_or_a_reason(spark):
    rows = _rows(spark, {}, {"trans_num": "T2", "amt": "0.001"}, {"trans_num": "T3", "dob": "garbage"},
                 {"trans_num": "T4", "transaction_time": "garbage", "lat": "95"}, {"trans_num": "T5"}, {"trans_num": "T5"},
                 {"trans_num": None})
    rows = rows.withColumn("status", F.lit("mine"))  # a clashing name
    scored = SV.score_requests(rows, SV.stored_probability(spark.createDataFrame(
        [("T1", 0.81395), ("T2", 0.9)], "trans_num string, fraud_probability double")), as_of=AS_OF)
    got = sorted(((r.trans_num or "", r.status, r.reason or "", r.is_fraud, r.fraud_probability, r.risk_level) for r in scored.collect()))
    assert got == [
        ("", "unscored", "no probability", None, None, None), ("T1", "scored", "", True, 0.8139, "CRITICAL"),
        ("T2", "refused", "range:amt", None, None, None), ("T3", "refused", "type:dob", None, None, None),
        ("T4", "refused", "type:transaction_time,range:lat", None, None, None),
        ("T5", "unscored", "no probability", None, None, None), ("T5", "unscored", "no probability", None, None, None)]
    assert [c for c in scored.columns if c not in SV.VERDICT] == NAMES


def test_original_and_engineered_values(spark):
    r = SV.original_and_engineered(_rows(spark, {}), as_of=AS_OF).first()
    assert r.original.amt == "12.5" and r.original.dob == "1990-01-01"
    assert r.engineered.age == 36 and r.engineered.hour == 14 and "amt" not in r.engineered.asDict()
    assert 13 < r.engineered.distance_km < 15
