"""Streaming jobs: model-scored stream and replay idempotence."""

from pyspark.sql import functions as F

from cardsentry.operators import store as ST
from cardsentry.plans import q_stream
from cardsentry.plans.catalog import Inputs
from cardsentry.sources.storage import new_location
from cardsentry.streaming import stream as SS

SF = "/root/testdata/sf0.001"


def test_stream_scored_by_model(spark):
    i = Inputs(spark, SF)
    out = q_stream.stream_score_model(i)
    rows = out.collect()
    n_valid_keys = q_stream.stream_insert_ignore(Inputs(spark, SF)).count()
    assert len(rows) == n_valid_keys  # every stored payment got one prediction
    for r in rows:
        assert 0.0 <= r.fraud_probability <= 1.0
        assert r.is_fraud == (r.fraud_probability > 0.5)


def test_stream_replay_inserts_nothing_twice(spark):
    i = Inputs(spark, SF)
    landing = new_location(spark, "landing_replay")
    SS.land_batches(i.payments_feed, landing)
    target = ST.KeyedTable.create(spark, "payments_replay")
    writer = SS.payment_inserter(target, ST.StoredRows.create(spark, "refused_replay"))
    SS.run(SS.read_landed(spark, landing), writer, "replay_a")
    first = target.read().count()
    # a second query over the same files (as after losing the checkpoint) adds nothing
    SS.run(SS.read_landed(spark, landing), writer, "replay_b")
    assert target.read().count() == first
    assert target.read().groupBy("trans_num").count().where(F.col("count") > 1).count() == 0


def test_empty_micro_batch_is_skipped(spark):
    from cardsentry.streaming import stream as SS

    calls = []
    w = SS.skip_empty(lambda df, bid: calls.append(bid))
    w(spark.range(0), 0)
    w(spark.range(3), 1)
    assert calls == [1]


def _feed_row(i, trans, amt, time="2024-01-10 10:00:00", batch=1, row=0):
    one = i.payments_feed.where("transaction_time is not null and dob <> ''").limit(1)
    lit = {"trans_num": trans, "amt": amt, "transaction_time": time}
    out = one.select(*[F.lit(lit[c]).cast("string").alias(c) if c in lit else F.col(c) for c in one.columns])
    return out.withColumn("batch_id", F.lit(batch).cast("int")).withColumn("row_idx", F.lit(row).cast("bigint")) \
        .select(*[F.col(c).cast(one.schema[c].dataType).alias(c) for c in one.columns])


def test_conflicting_duplicate_restart_and_untimed_rows(spark):
    """A stored payment's later duplicate changes neither prediction nor
    alerts; all objects are rebuilt from paths between the two runs."""
    i = Inputs(spark, SF)
    landing, root = new_location(spark, "landing_conflict"), new_location(spark, "conflict_tables")
    scorer = lambda rows: rows.select(
        "trans_num", F.when(F.col("amt").cast("double") > 100, 0.9).otherwise(0.1).alias("fraud_probability"))

    def run():
        names = ("payments", "predictions", "alerts", "quarantine", "training")
        stamps = {"payments": "created_at", "predictions": "predicted_at", "training": "created_at"}
        t = {n: ST.KeyedTable(spark, f"{root}/{n}", stamp=stamps.get(n)) for n in names}
        writer = SS.score_and_alert(t["payments"], t["predictions"], t["alerts"], scorer,
                                    quarantine=t["quarantine"], training=t["training"])
        SS.run(SS.read_landed(spark, landing), writer, "conflict", checkpoint=f"{root}/checkpoint")
        return t

    a = _feed_row(i, "T1", "5").unionByName(_feed_row(i, "T2", "900", row=1))
    a.unionByName(_feed_row(i, "T3", "7", time="garbage", row=2)).write.mode("append").parquet(landing)
    run()
    b = _feed_row(i, "T1", "900", batch=2).unionByName(_feed_row(i, "T4", "1", batch=2, row=1))
    b.write.mode("append").parquet(landing)
    t = run()
    assert {r.trans_num: r.is_fraud for r in t["predictions"].read().collect()} == {"T1": False, "T2": True, "T4": False}
    assert [r.trans_num for r in t["alerts"].read().collect()] == ["T2"]
    assert [(r.trans_num, r.violations) for r in t["quarantine"].read().collect()] == [("T3", "type:transaction_time")]
    assert sorted(r.trans_num for r in t["payments"].read().collect()) == ["T1", "T2", "T4"]
    assert sorted(r.trans_num for r in t["training"].read().collect()) == ["T1", "T2", "T4"]
    assert all(r.predicted_at is not None for r in t["predictions"].read().collect())


def test_all_landed_batches_are_read(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (7, "c")], "batch_id int, trans_num string")
    landing = SS.land_batches(rows, new_location(spark, "landing_all"))
    assert spark.read.parquet(landing).count() == 3


def _document(rows, **more):
    import json

    columns = ["trans_num", "cc_num", "merchant", "category", "amt", "gender", "state", "zip", "lat", "long", "city_pop",
               "dob", "merch_lat", "merch_long", "current_time"]
    full = [[t, 7, "fraud_Shop", "misc", amt, "F", "NY", 10001, 40.0, -74.0, 100, "1990-01-01", 40.1, -74.1, ms]
            for t, amt, ms in rows]
    return json.dumps(json.dumps({"columns": columns, "data": full, **more}))


def test_json_feed_goes_on_after_a_restart(spark, tmp_path):
    landing, root = str(tmp_path / "in"), new_location(spark, "json_feed")

    def land(name, *documents):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(documents) + "\n")

    def run():  # everything is opened anew, as after a restart
        payments = ST.create_tables(spark, f"{root}/tables", parts=4)["payments"]
        refused, broken = ST.StoredRows(spark, f"{root}/refused"), ST.StoredRows(spark, f"{root}/broken")
        SS.run(SS.read_feed(spark, landing), SS.feed_inserter(payments, refused, broken), "json",
               checkpoint=f"{root}/checkpoint")
        return payments, refused, broken

    good = _document([("T1", 5, 1769697000000), ("T2", -3, 1769697000000), ("T1", 6, 1769697000000)], index=[3, 4, 5])
    land("a.json", good, good[:40], _document([("T3", 9, None)]))
    run()
    land("b.json", _document([("T1", 99, 1769697000000), ("T4", "x", 1769697000000), ("T5", 1, 1769697000000)]), "no JSON")
    payments, refused, broken = run()
    rows = {r.trans_num: r for r in payments.read().collect()}
    assert {t: float(r.amt) for t, r in rows.items()} == {"T1": 5.0, "T5": 1.0}
    assert rows["T1"].merchant == "Shop" and rows["T1"].created_at is not None and rows["T1"].id is not None
    assert rows["T1"].transaction_time == "2026-01-29 14:30:00"
    assert {r.trans_num: r.violations for r in refused.read().collect()} == {
        "T2": "range:amt", "T3": "missing:transaction_time", "T4": "missing:amt"}
    assert sorted((r.value[:5], r.reason, r.source_file[-6:]) for r in broken.read().collect()) == [
        (good[:5], "not a JSON string", "a.json"), ("no JS", "not a JSON string", "b.json")]
    run()  # nothing new has landed
    assert payments.read().count() == 2 and broken.read().count() == 2 and refused.read().count() == 3


def test_a_replayed_batch_is_stored_once(spark):
    log = ST.StoredRows.create(spark, "log")
    for batch_id in (0, 1, 1):
        log.put(spark.createDataFrame([(f"r{batch_id}",)], "x string"), batch_id)
    assert sorted(r.x for r in log.read().collect()) == ["r0", "r1"]


def test_day_counts_in_order_late_rows_and_bounded_state(spark):
    import datetime as dt

    day = lambda d, h=12: dt.datetime(2024, 1, d, h)
    schema = "trans_num string, is_fraud boolean, predicted_at timestamp_ntz"
    landing, out = new_location(spark, "landing_days"), new_location(spark, "days")
    for k in range(1, 17):
        rows = [(f"a{k}", False, day(k)), (f"b{k}", True, day(k)), (f"c{k}", True, day(k, 13))]
        if k == 4:
            rows.append(("late", True, day(3, 23)))  # a day behind: counted
        if k == 9:
            rows.append(("lost", True, day(2)))  # a week behind: its day is final
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    q = SS.run(SS.daily_counts_stream(SS.read_landed(spark, landing)), SS.daily_upserter(out), "days", output_mode="update")
    got = {(r.day.day, r.predicted_fraud): r.n for r in SS.read_daily(spark, out).collect()}
    want = {(k, f): 2 if f else 1 for k in range(1, 17) for f in (False, True)}
    assert got == want | {(3, True): 3}
    states = [p.stateOperators[0] for p in q.recentProgress if p.stateOperators]
    # six days at most, of sixteen: those of the delay and of the batches that the watermark lags
    assert max(s.numRowsTotal for s in states) <= 12 and any(s.numRowsDroppedByWatermark for s in states)


def test_day_counts_of_pieces_in_several_files(spark):
    import datetime as dt

    rows = [(f"t{k}", False, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k)) for k in range(480)]
    df = spark.createDataFrame(rows, "trans_num string, is_fraud boolean, predicted_at timestamp_ntz").repartition(4)
    got = q_stream._daily_counts(spark, df).collect()
    assert {r.day: r.n for r in got} == {dt.date(2024, 1, 1 + d): 24 for d in range(20)}


def test_a_landed_batch_is_dealt_to_files_and_read_at_once(spark):
    rows = spark.range(1000).selectExpr("CAST(id % 2 AS int) AS batch_id", "id").coalesce(1)
    landing = SS.land_batches(rows, new_location(spark, "landing_dealt"), files=4)
    assert spark.read.parquet(landing).select(F.input_file_name()).distinct().count() == 8
    seen = []
    SS.run(SS.read_landed(spark, landing, 4), lambda b, _: seen.append(sorted(r[0] for r in b.select("batch_id").distinct().collect())), "dealt")
    assert seen == [[0], [1]]
