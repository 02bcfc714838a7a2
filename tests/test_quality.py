from pyspark.sql import functions as F

from cardsentry.operators import quality as Q

COLS = ["trans_num", "cc_num", "merchant", "category", "amt", "gender", "state", "zip", "lat", "long",
        "city_pop", "merch_lat", "merch_long", "dob", "transaction_time"]
GOOD = ["T1", "374125201044065", "Amazon", "shopping_net", "150.75", "M", "NY", "10001", "40.7128",
        "-74.0060", "8000000", "40.7589", "-73.9851", "1990-01-15", "2026-01-29 14:30:00"]


def _row(**changes):
    r = dict(zip(COLS, GOOD))
    r.update(changes)
    return tuple(r[c] for c in COLS)


def test_violations(spark):
    rows = [
        _row(),
        _row(trans_num="T2", amt="-1"),
        _row(trans_num="T3", lat="120", merch_long="-181"),
        _row(trans_num="T4", cc_num="abc", city_pop="0"),
        _row(trans_num="T5", transaction_time=None, dob=""),
        _row(trans_num="T6", amt="0", lat="90", long="-180"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))
    got = {r.trans_num: r.violations for r in Q.with_violations(df).collect()}
    assert got["T1"] == []
    assert got["T2"] == ["range:amt"]
    assert set(got["T3"]) == {"range:lat", "range:merch_long"}
    assert set(got["T4"]) == {"type:cc_num", "range:city_pop"}
    assert got["T5"] == ["missing:transaction_time"]  # an empty birth date is accepted
    assert got["T6"] == ["range:amt"]  # bounds are inclusive, amt must be > 0
    good, bad = Q.split_good_bad(df)
    assert good.count() == 1 and bad.count() == 5
    counts = {r.rule: r.n for r in Q.violation_counts(df).collect()}
    assert counts["range:amt"] == 2


def test_table_checks(spark):
    a = spark.createDataFrame([("T1", 1), ("T1", 2), ("T2", None)], "trans_num string, x int")
    empty = spark.createDataFrame([], "trans_num string, x int")
    ne = {r.table_name: r.ok for r in Q.non_empty({"a": a, "e": empty}).collect()}
    assert ne == {"a": True, "e": False}
    dups = Q.duplicate_keys({"a": a}).collect()
    assert [(d.key, d.n) for d in dups] == [("T1", 2)]
    nulls = {r.column_name: r.n_null for r in Q.null_counts({"a": (a, ["trans_num", "x"])}).collect()}
    assert nulls == {"trans_num": 0, "x": 1}
    parent = spark.createDataFrame([("T1",)], "trans_num string")
    orph = Q.orphan_counts({("a", "p"): (a, parent)}).first()
    assert orph.n_orphans == 1


def test_values_that_do_not_fit_are_violations(spark):
    rows = [("123456789012.5", "10"), ("NaN", "10"), ("5", "3000000000"), ("5", "10")]
    df = spark.createDataFrame(rows, "amt string, city_pop string")
    good, bad = Q.split_good_bad(df)
    assert good.count() == 1
    assert sorted(v for r in bad.collect() for v in r.violations) == ["overflow:amt", "overflow:amt", "overflow:city_pop"]


def test_every_value_must_survive_being_stored(spark):
    good = {"id": "7", "amt": "0.01", "is_fraud": "1", "dob": "1990-01-01", "transaction_time": "2024-01-10 10:00:00.123456"}
    bad = [({"id": "abc"}, "type:id"), ({"is_fraud": "abc"}, "type:is_fraud"), ({"is_fraud": "7"}, "range:is_fraud"),
           ({"amt": "0.001"}, "range:amt"), ({"dob": "garbage"}, "type:dob"),
           ({"transaction_time": "garbage"}, "type:transaction_time"), ({"transaction_time": "2024-13-01"}, "type:transaction_time")]
    fine = [{}, {"dob": ""}, {"is_fraud": None}, {"id": None}, {"transaction_time": "2024-01-10"}]
    rows = [tuple({**good, **c}[k] for k in good) for c in [c for c, _ in bad] + fine]
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in good))
    found = [r.violations for r in Q.with_violations(df).collect()]
    assert found == [[rule] for _, rule in bad] + [[]] * len(fine)
    kept = Q.typed_payments(Q.split_good_bad(df)[0])
    lost = [c for c in good if kept.where(F.col(c).isNull()).count() != sum(f.get(c, "") is None for f in fine)]
    assert lost == []
