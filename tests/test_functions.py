import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cardsentry.functions import dates, geo, scoring, text
from cardsentry.functions.numeric import round_binary

EDGE_HOURS = [0, 5, 6, 7, 8, 11, 12, 16, 17, 18, 21, 22, 23]


def _hours(spark):
    return spark.createDataFrame([(h,) for h in range(24)], "h int")


def _flags(spark, variant):
    df = _hours(spark)
    fl = dates.time_flags(F.col("h"), F.lit(0), variant)
    rows = df.select("h", *[c.alias(n) for n, c in fl.items()]).collect()
    return {r["h"]: r.asDict() for r in rows}


def test_request_flags_partition_the_day(spark):
    f = _flags(spark, "request")
    for h in range(24):
        periods = f[h]["is_night"] + f[h]["is_morning"] + f[h]["is_afternoon"] + f[h]["is_evening"]
        assert periods == 1, h
    assert [h for h in range(24) if f[h]["is_business_hour"]] == list(range(8, 17))
    assert [h for h in range(24) if f[h]["is_night"]] == [0, 1, 2, 3, 4, 5, 22, 23]


@pytest.mark.parametrize("h", EDGE_HOURS)
def test_stream_and_training_variants(spark, h):
    s = _flags(spark, "stream")[h]
    t = _flags(spark, "training")[h]
    assert s["is_night"] == 0 and t["is_night"] == 0  # between(22, 6) never holds
    assert s["is_morning"] == int(6 <= h < 12)
    assert t["is_morning"] == int(6 <= h <= 12)
    assert s["is_afternoon"] == int(12 <= h < 18)
    assert t["is_afternoon"] == int(12 <= h <= 18)
    assert s["is_evening"] == int(18 <= h < 22)
    assert t["is_evening"] == int(18 <= h <= 22)
    assert s["is_business_hour"] == int(8 <= h <= 17) == t["is_business_hour"]


def test_null_hour_gives_null_flags(spark):
    df = spark.createDataFrame([(None,)], "h int")
    for v in ("request", "stream", "training"):
        fl = dates.time_flags(F.col("h"), F.col("h"), v)
        row = df.select(*[c.alias(n) for n, c in fl.items()]).first()
        assert all(x is None for x in row), v


def test_weekend_and_weekday(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 29, 14, 30),), (dt.datetime(2026, 1, 31, 9, 0),),
                                (dt.datetime(2026, 2, 1, 9, 0),)], "ts timestamp_ntz")
    parts = dates.time_parts(F.col("ts"))
    rows = df.select(parts["dayofweek"].alias("d"), parts["hour"].alias("h"), parts["time"].alias("t")).collect()
    assert [r.d for r in rows] == [3, 5, 6]  # Thursday, Saturday, Sunday
    assert rows[0].h == 14 and rows[0].t == "14:30:00"


@pytest.mark.parametrize("dob,expected", [
    ("1990-01-15", 36), ("1990-01-29", 36), ("1990-01-30", 35), ("2000-02-29", 25),
    ("", None), (None, None), ("1990-13-01", None), ("not a date", None),
])
def test_age(spark, dob, expected):
    df = spark.createDataFrame([(dob,)], "dob string")
    got = df.select(dates.age_years(F.col("dob"), dt.date(2026, 1, 29)).alias("a")).first().a
    assert got == expected


def test_age_leap_day_birthday(spark):
    df = spark.createDataFrame([("2000-02-29",)], "dob string")
    a = lambda d: df.select(dates.age_years(F.col("dob"), d).alias("a")).first().a
    assert a(dt.date(2026, 2, 28)) == 25
    assert a(dt.date(2026, 3, 1)) == 26
    assert a(dt.date(2028, 2, 29)) == 28


def _py_haversine(lat1, lon1, lat2, lon2):
    r = math.radians
    p1, p2 = r(lat1), r(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((r(lon2) - r(lon1)) / 2) ** 2
    return 6371 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine(spark):
    pts = [(40.7128, -74.0060, 40.7589, -73.9851), (48.8566, 2.3522, 51.5074, -0.1278),
           (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = df.select(geo.haversine_km("a", "b", "c", "d").alias("x"),
                    geo.haversine_km("c", "d", "a", "b").alias("y"),
                    geo.haversine_km("a", "b", "c", "d", None).alias("raw")).collect()
    assert got[0].x == 5.42  # the request sample
    assert got[1].x == 343.56
    assert got[2].x == 0.0
    assert abs(got[3].raw - math.pi * 6371) < 1e-6
    assert got[4].x is None
    for r, p in zip(got[:4], pts[:4]):
        assert r.x == r.y  # symmetric
        assert abs(r.raw - _py_haversine(*p)) < 1e-9


@pytest.mark.parametrize("raw,clean", [
    ("fraud_X", "X"), ("fraud_fraud_X", "X"), ("fraud_", ""), ("Y", "Y"), (None, None),
    ("a fraud_b", "b"),
])
def test_clean_merchant(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "m string")
    assert df.select(text.clean_merchant(F.col("m")).alias("c")).first().c == clean


@pytest.mark.parametrize("p,level,conf", [
    (0.0, "LOW", 1.0), (0.2999, "LOW", 0.4002), (0.3, "MEDIUM", 0.4), (0.5, "MEDIUM", 0.0),
    (0.6, "HIGH", 0.2), (0.7999, "HIGH", 0.5998), (0.8, "CRITICAL", 0.6), (1.0, "CRITICAL", 1.0),
])
def test_risk_and_confidence(spark, p, level, conf):
    df = spark.createDataFrame([(p,)], "p double")
    r = df.select(scoring.risk_level(F.col("p")).alias("r"), scoring.confidence(F.col("p")).alias("c"),
                  scoring.above_threshold(F.col("p")).alias("a")).first()
    assert r.r == level
    assert r.c == pytest.approx(conf)
    assert r.a == (p > 0.5)


def test_round_binary_matches_python(spark):
    vals = [0.81395, 2.675, 1.005, 0.125, 0.375, -2.675, 123.4550001, 5.4249999]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.x for r in df.select(round_binary(F.col("v"), 2).alias("x")).collect()]
    for v, g in zip(vals, got):
        # C rule: round(x * 100) / 100 in double arithmetic, half away from zero
        expected = math.copysign(math.floor(abs(v) * 100 + 0.5), v) / 100
        assert g == expected, v
    assert got[0] == 0.81  # 0.81395 is below the tie in binary
    conf = spark.createDataFrame([(0.81395,)], "v double").select(round_binary(F.col("v"), 4).alias("x")).first().x
    assert conf == 0.8139


def test_display_formats(spark):
    df = spark.createDataFrame([(12.3, 0.1234, True, False), (0.5, None, False, True)],
                               "amt double, p double, f boolean, s boolean")
    rows = df.select(scoring.money(F.col("amt")).alias("m"), scoring.percent_or_na(F.col("p")).alias("pc"),
                     scoring.fraud_status(F.col("f")).alias("st"), scoring.email_status(F.col("s")).alias("e")
                     ).collect()
    assert rows[0].m == "$12.30" and rows[0].pc == "12.3%" and rows[0].st.endswith("FRAUD")
    assert rows[1].m == "$0.50" and rows[1].pc == "N/A" and rows[1].st.endswith("LEGIT")
    assert rows[0].e.endswith("Pending") and rows[1].e.endswith("Sent")
