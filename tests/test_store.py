import pytest
from pyspark.sql import functions as F

from cardsentry.operators import store as ST

SCHEMA = "trans_num string, batch_id int, row_idx long, amt double"


def test_first_arrival_wins_and_hot_key(spark):
    rows = [("T1", 2, 0, 1.0), ("T1", 1, 5, 2.0), ("T1", 1, 3, 3.0), ("T2", 1, 1, 4.0)]
    rows += [("HOT", 1, 10 + i, float(i)) for i in range(3000)]  # one key, most rows
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.trans_num: r for r in ST.first_arrival(df).collect()}
    assert got["T1"].amt == 3.0 and got["T2"].amt == 4.0 and got["HOT"].amt == 0.0
    assert len(got) == 3


def test_insert_ignore_idempotent(spark):
    t = ST.KeyedTable.create(spark, "test_payments")
    b1 = spark.createDataFrame([("T1", 1, 0, 1.0), ("T2", 1, 1, 2.0), ("T2", 1, 2, 9.0)], SCHEMA)
    t.insert_ignore(b1)
    t.insert_ignore(b1)  # replay
    b2 = spark.createDataFrame([("T2", 2, 0, 5.0), ("T3", 2, 1, 3.0)], SCHEMA)
    t.insert_ignore(b2)
    got = {r.trans_num: r.amt for r in t.read().collect()}
    assert got == {"T1": 1.0, "T2": 2.0, "T3": 3.0}


def test_atomic_append(spark):
    t = ST.KeyedTable.create(spark, "test_predictions")
    a = spark.createDataFrame([("T1", 0.2), ("T2", 0.9)], "trans_num string, p double")
    assert t.append_atomic(a) is True
    b = spark.createDataFrame([("T3", 0.1), ("T2", 0.4)], "trans_num string, p double")
    assert t.append_atomic(b) is False  # one stored key fails the whole batch
    c = spark.createDataFrame([("T4", 0.1), ("T4", 0.4)], "trans_num string, p double")
    assert t.append_atomic(c) is False  # duplicate inside the batch
    assert sorted(r.trans_num for r in t.read().collect()) == ["T1", "T2"]


def test_alerts_and_cascade(spark):
    scored = spark.createDataFrame([("T1", 1), ("T2", 0), ("T3", 1)], "trans_num string, is_fraud_pred int")
    alerts = ST.alerts_from_scores(scored).collect()
    assert sorted(a.trans_num for a in alerts) == ["T1", "T3"]
    assert all(a.email_sent is False and a.email_sent_at is None for a in alerts)
    parent = spark.createDataFrame([("T1", "x"), ("T2", "error"), ("T3", "y")], "trans_num string, category string")
    child = spark.createDataFrame([("T1",), ("T2",), ("T2",)], "trans_num string")
    rem, kids = ST.cascade_delete(parent, {"c": child}, F.col("category") != "error")
    assert rem.count() == 2 and [r.trans_num for r in kids["c"].collect()] == ["T1"]


def test_export_csv_roundtrip(spark):
    from cardsentry.sources.storage import new_location

    df = spark.createDataFrame([("T1", 1.5), ("T2", None)], "trans_num string, amt double")
    path = ST.export_csv(df, new_location(spark, "csv"), single_file=True)
    back = spark.read.schema(df.schema).option("header", True).csv(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_write_on_conflict_modes(spark):
    t = ST.KeyedTable.create(spark, "test_modes")
    a = spark.createDataFrame([("T1", 0.2)], "trans_num string, p double")
    b = spark.createDataFrame([("T1", 0.9), ("T2", 0.4)], "trans_num string, p double")
    assert t.write(a, on_conflict="fail") is True
    assert t.write(b, on_conflict="fail") is False
    assert t.write(b) is True  # ignore: only T2 is new
    assert sorted((r.trans_num, r.p) for r in t.read().collect()) == [("T1", 0.2), ("T2", 0.4)]


def test_reopened_table_goes_on(spark):
    first = ST.KeyedTable.create(spark, "test_reopen", stamp="created_at")
    a = spark.createDataFrame([("T1", 1, 0, 1.0), ("T2", 1, 1, 2.0)], SCHEMA)
    assert first.insert_ignore(a) == 2
    again = ST.KeyedTable(spark, first.path, stamp="created_at")
    b = spark.createDataFrame([("T2", 2, 0, 9.0), ("T3", 2, 1, 3.0)], SCHEMA)
    assert again.insert_ignore(b) == 1 and again.insert_ignore(b) == 0
    rows = {r.trans_num: r for r in again.read().collect()}
    assert {k: r.amt for k, r in rows.items()} == {"T1": 1.0, "T2": 2.0, "T3": 3.0}
    assert all(r.created_at is not None for r in rows.values())
    assert ST.KeyedTable(spark, first.path + "-none").read() is None


def test_cascade_leaves_children_without_a_parent_alone(spark):
    parent = spark.createDataFrame([("T1", "x")], "trans_num string, category string")
    child = spark.createDataFrame([("T1",), ("T9",)], "trans_num string")
    _, kids = ST.cascade_delete(parent, {"c": child}, F.col("category") != "error")
    assert sorted(r.trans_num for r in kids["c"].collect()) == ["T1", "T9"]


def test_fallback_folder_is_refused_on_a_cluster():
    from cardsentry.sources import storage

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        storage.shared_root(Session())


def _declared(spark, parts=0):
    from cardsentry.sources.storage import new_location

    return ST.create_tables(spark, new_location(spark, "declared"), parts=parts)


@pytest.mark.parametrize("parts", [0, 8])
def test_declared_tables_take_their_own_writers(spark, parts):
    from cardsentry import schemas as S

    t = _declared(spark, parts)
    batch = spark.createDataFrame([("T1", "12.345", "x", 1, 0), ("T1", "9", "y", 1, 1), ("T2", "3", "z", 1, 2)],
                                  "trans_num string, amt string, not_declared string, batch_id int, row_idx bigint")
    assert t["payments"].insert_ignore(batch) == 2 and t["payments"].insert_ignore(batch) == 0
    rows = {r.trans_num: r for r in t["payments"].read().collect()}
    assert t["payments"].read().columns == S.PAYMENTS.names
    assert str(rows["T1"].amt) == "12.35" and rows["T1"].city is None and rows["T1"].created_at is not None
    assert len({r.id for r in rows.values()}) == 2
    scores = spark.createDataFrame([("T1", True, 0.9, "HIGH")], "trans_num string, is_fraud boolean, fraud_probability double, risk_level string")
    assert t["predictions"].append_atomic(scores) is True and t["predictions"].append_atomic(scores) is False
    t["fraud_alerts"].insert_ignore(scores.select("trans_num"), order_cols=())
    assert [r.email_sent for r in t["fraud_alerts"].read().collect()] == [False]
    again = ST.create_tables(spark, t["payments"].path.rsplit("/", 1)[0], parts)
    assert {n: x.read().count() for n, x in again.items()} == {
        "payments": 2, "training_data": 0, "predictions": 1, "fraud_alerts": 1}
    assert {n: x.read().schema.simpleString() for n, x in again.items()} == {
        n: s.simpleString() for n, s in S.STORED_TABLES.items()}


def test_a_batch_reads_the_folders_of_its_keys_only(spark):
    t = ST.KeyedTable.create(spark, "parted", schema=None, parts=16)
    t.append(spark.range(2000).selectExpr("concat('K', id) as trans_num", "id as v"))
    batch = spark.createDataFrame([("K5", -1), ("K1999", -1), ("N1", -1)], "trans_num string, v bigint")
    near = t.near(batch)
    plan = near._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in plan and "key_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < near.count() < 600  # 3 of 16 folders at most
    assert t.insert_ignore(batch, order_cols=()) == 1
    few = t.rewritten(t.path + "-few")
    assert sorted(few.read().collect()) == sorted(t.read().collect())
    assert len(few.read().inputFiles()) <= 16 < len(t.read().inputFiles())
    assert few.insert_ignore(batch, order_cols=()) == 0


def test_referential_write_accounts_for_every_row(spark):
    t, refused = _declared(spark, 4), ST.StoredRows.create(spark, "refused")
    t["payments"].insert_ignore(spark.createDataFrame([(f"T{k}",) for k in range(6)], "trans_num string"), order_cols=())
    rows = [("T0", True, 0.9), ("T1", False, 0.1), ("T1", False, 0.2), ("X", True, 0.8), (None, True, 0.7),
            ("T2", None, 0.6), ("T3", True, None)]
    batch = spark.createDataFrame(rows, "trans_num string, is_fraud boolean, fraud_probability double")
    got = t["predictions"].insert_checked(batch, t["payments"], refused, 0)
    assert got == {"inserted": 2, "duplicate": 1, "orphan": 1, "incomplete": 3}
    assert sorted((r.trans_num or "", r.reason) for r in refused.read().collect()) == [
        ("", "incomplete"), ("T2", "incomplete"), ("T3", "incomplete"), ("X", "orphan")]
    again = t["predictions"].insert_checked(batch, t["payments"], refused, 0)  # a replay
    assert again == {"inserted": 0, "duplicate": 3, "orphan": 1, "incomplete": 3} and refused.read().count() == 4
    empty = t["predictions"].insert_checked(batch.limit(0), t["payments"], refused, 1)
    assert set(empty.values()) == {0} and t["predictions"].read().count() == 2
