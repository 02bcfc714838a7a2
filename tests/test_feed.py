import datetime as dt

from cardsentry.sources import feed


def test_decode_split_documents_by_name(spark):
    doc1 = '"{\\"columns\\":[\\"trans_num\\",\\"amt\\",\\"merchant\\",\\"current_time\\"],\\"index\\":[7,8],' \
           '\\"data\\":[[\\"T1\\",12.5,\\"fraud_Shop\\",1769697000000],[\\"T2\\",\\"bad\\",\\"X\\",null]]}"'
    doc2 = '"{\\"columns\\":[\\"merchant\\",\\"trans_num\\"],\\"index\\":[0],\\"data\\":[[\\"fraud_fraud_Y\\",\\"T3\\"]]}"'
    lines = spark.createDataFrame([(doc1,), (doc2,)], "value string")
    rows = {r.trans_num: r for r in feed.extract_feed(lines).collect()}
    assert rows["T1"].amt == 12.5 and rows["T1"].merchant == "Shop" and rows["T1"].feed_index == 7
    assert rows["T1"].transaction_time == dt.datetime(2026, 1, 29, 14, 30)
    assert rows["T1"].transaction_time_text == "2026-01-29 14:30:00.000"
    assert rows["T2"].amt is None and rows["T2"].transaction_time is None  # bad value -> null
    assert rows["T3"].merchant == "Y" and rows["T3"].amt is None  # absent column -> null


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([(i, f"T{i}", f"fraud_M{i % 3}", float(i) / 4, 1769697000000 + i)
                                for i in range(250)], "id long, trans_num string, merchant string, amt double, "
                                                      "current_time long")
    lines = feed.encode_split_documents(df, ["trans_num", "merchant", "amt", "current_time"], "id", 100)
    assert lines.count() == 3  # documents of at most 100 rows
    back = {r.trans_num: r for r in feed.extract_feed(lines).collect()}
    assert len(back) == 250 and back["T9"].amt == 2.25 and back["T9"].merchant == "M0"


def test_broken_documents_are_kept_apart(spark):
    from cardsentry.sources import feed

    import json
    good = json.dumps(json.dumps({"columns": ["trans_num"], "index": [0], "data": [["T1"]]}))
    lines = spark.createDataFrame([(good,), (good[:20],), (json.dumps("no document"),), (json.dumps('{"data": [["x"]]}'),),
                                   (json.dumps('{"columns": ["a"]}'),)], "value string")
    assert [r.trans_num for r in feed.decode_split_documents(lines).where("trans_num is not null").collect()] == ["T1"]
    bad = sorted(r.reason for r in feed.broken_documents(lines).collect())
    assert bad == ["no columns", "no data", "not a JSON string", "not a split document"]


def _doc(**parts):
    import json
    return json.dumps(json.dumps(parts))


def test_a_document_gives_all_its_rows_or_is_kept_apart(spark):
    columns = ["trans_num", "amt"]
    sound = [
        _doc(columns=columns, index=[4, 9], data=[["T1", 1], ["T2", 2]]),
        _doc(columns=columns, data=[["T3", 3], ["T4", 4]]),  # no index
        _doc(columns=columns, index=["a", "7"], data=[["T5", 5], ["T6", 6]]),  # labels that are no numbers
        _doc(columns=columns, index=[], data=[]),
    ]
    broken = [
        (_doc(index=[0], data=[["T7", 7]]), "no columns"),
        (_doc(columns=columns, index=[0]), "no data"),
        (_doc(columns=columns, data=[["T8", 8], ["T9"]]), "ragged rows"),
        (_doc(columns=columns, data=[["T8", 8], None]), "ragged rows"),
        (_doc(columns=columns, index=[0], data=[["TA", 1], ["TB", 2]]), "index does not fit"),
        (_doc(other=1), "not a split document"),
        ("", "not a JSON string"), ("{", "not a JSON string"), (None, "not a JSON string"),
    ]
    lines = spark.createDataFrame([(d,) for d in sound] + [(d,) for d, _ in broken], "value string")
    rows = {r.trans_num: r for r in feed.decode_split_documents(lines).collect()}
    assert {t: (r.feed_index, r.feed_pos, r.feed_label) for t, r in rows.items()} == {
        "T1": (4, 0, "4"), "T2": (9, 1, "9"), "T3": (0, 0, None), "T4": (1, 1, None),
        "T5": (0, 0, "a"), "T6": (1, 1, "7")}
    assert sorted((r.value or "", r.reason) for r in feed.broken_documents(lines).collect()) == sorted(
        (d or "", why) for d, why in broken)
    account = {r.state: (r.documents, r.entries) for r in feed.feed_account(lines).collect()}
    assert account["sound"] == (4, len(rows)) and sum(n for n, _ in account.values()) == lines.count()


def test_damaged_history_lines_are_set_apart(spark, tmp_path):
    path = str(tmp_path / "history.csv")
    header = ",".join([""] + [n for n, _ in feed.HISTORY_COLUMNS])
    good = '1,2019-01-01 00:00:18,27,"fraud_Rippin, Kub",misc_net,4.97,J,B,F,"561 Perry, Cove",Moravian,NC,28654,36.0,-81.1,3495,Job,1988-03-09,0b24,13,36.0,-82.0,0'
    lines = [header, good, good[:40], good.replace("4.97", "a lot"), good + ",more", "", good.replace("4.97", "")]
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    sound, lost = feed.split_history_csv(spark, path)
    rows = sound.orderBy("amt").collect()
    assert [r.amt for r in rows] == [None, 4.97] and rows[1].merchant == "fraud_Rippin, Kub" and rows[1].is_fraud == 0
    assert sorted(r.line for r in lost.collect()) == sorted([lines[2], lines[3], lines[4]])


def test_a_document_is_parsed_once(spark, tmp_path):
    """A parse for every use, one of them per entry, made the time grow with the
    square of a document's entries."""
    (tmp_path / "d.json").write_text('"{}"\n')
    rows = feed.extract_feed(spark.read.text(str(tmp_path)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # the string, and the document in it
