"""Structured Streaming jobs for the payment feed.

The original job pulled a feed every 20 seconds and inserted row by row. Here
a file stream source reads landed feed files, and ``foreachBatch`` applies
the same batch operators to every micro-batch: validation, keyed
insert-if-new, feature derivation, scoring, alerting. Every write is an
insert-ignore keyed on ``trans_num``, so replaying a micro-batch after a
failure (the checkpoint's at-least-once retry) adds nothing twice. The
checkpoint and the tables live under the shared folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardsentry.functions import dates, scoring
from cardsentry.operators import features as FE
from cardsentry.operators import quality as Q
from cardsentry.operators import store as ST
from cardsentry.sources import feed
from cardsentry.sources.storage import materialize, new_location

DEFAULT_TRIGGER = "20 seconds"  # cadence of the original feed pull
ALL_FILES = 2**31 - 1  # as many files a micro-batch as have landed


def land_batches(df: DataFrame, landing: str, batch_col: str = "batch_id",
                 batches: Sequence[int] | None = None, files: int | None = None) -> str:
    """Write feed batches to a landing folder, one append per batch, in
    arrival order (the file source replays them in that order). The batches
    are those that ``df`` holds unless they are named. ``files`` deals each
    batch to that many files, so that a reader has as many tasks."""
    if batches is None:
        batches = [r[0] for r in df.select(batch_col).distinct().orderBy(batch_col).collect()]
    for b in batches:
        rows = df.where(F.col(batch_col) == b)
        (rows if files is None else rows.repartition(files)).write.mode("append").parquet(landing)
    return landing


def read_landed(spark: SparkSession, landing: str, max_files_per_trigger: int = 1, schema=None) -> DataFrame:
    """Streaming read of landed Parquet files; without ``schema``, with that of
    the files landed so far. ``max_files_per_trigger`` bounds a micro-batch:
    raise it to catch up on many files."""
    schema = schema or spark.read.parquet(landing).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(landing))


def read_feed(spark: SparkSession, landing: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of landed split-JSON files: one document a line, as it was
    sent, with the file that it came in (``source_file``)."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(landing)
            .select("value", F.col("_metadata.file_path").alias("source_file")))


def run(stream: DataFrame, writer: Callable[[DataFrame, int], None], name: str,
        trigger_available_now: bool = True, output_mode: str = "append",
        checkpoint: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query with a checkpoint in the shared folder.

    ``checkpoint`` names the folder of an earlier run to go on from; without
    it the query starts afresh.

    ``trigger_available_now`` processes what has landed and stops (tests,
    catch-up runs); otherwise the query runs on the 20-second cadence.
    """
    spark = stream.sparkSession
    w = (stream.writeStream.foreachBatch(writer).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or new_location(spark, f"checkpoint_{name}")))
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime=DEFAULT_TRIGGER)
    q = w.start()
    if trigger_available_now:
        q.awaitTermination()
    return q


# ------------------------------------------------------------ writers


def skip_empty(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run ``write`` only when the micro-batch has a row.

    A batch without rows (an empty landed file) would still plan and run
    every branch of the writer (validation, key probe, table writes); one
    ``isEmpty`` probe (a one-row scan) skips them. The batch itself is not
    cached: it is bounded by ``maxFilesPerTrigger`` and re-reading its files
    measured faster than persisting them.
    """

    def wrapped(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write(batch, batch_id)

    return wrapped


def raw_appender(target: ST.StoredRows) -> Callable[[DataFrame, int], None]:
    """Store every landed row as it arrived (bronze copy), a replayed batch once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target.put(batch, batch_id)

    return write


def _listed(bad: DataFrame) -> DataFrame:
    return bad.withColumn("violations", F.array_join("violations", ","))


def _checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of a micro-batch, validated once for all its writes."""
    return Q.split_good_bad(rows, materialize(Q.with_violations(rows), "checked_batch"))


def payment_inserter(target: ST.KeyedTable, quarantine: ST.StoredRows) -> Callable[[DataFrame, int], None]:
    """Validate a micro-batch, quarantine bad rows, insert new good ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = _checked(batch)
        quarantine.put(_listed(bad), batch_id)
        target.insert_ignore(Q.typed_payments(good))

    return skip_empty(write)


def feed_inserter(target: ST.KeyedTable, quarantine: ST.StoredRows, broken: ST.StoredRows
                  ) -> Callable[[DataFrame, int], None]:
    """Decode a micro-batch of split-JSON documents (``read_feed``) and insert
    their new valid rows.

    Every document either gives all its rows or goes to ``broken`` with its text,
    file and reason; every row is inserted, skipped as a duplicate, or goes to
    ``quarantine`` with its violations. Of rows that share a key the first of the
    first file is taken. All three sinks belong to one checkpoint: a replayed
    batch replaces what it stored in the quarantines and inserts nothing twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        documents = feed.read_documents(batch)
        lost = documents.where(F.col("reason").isNotNull())
        broken.put(lost.select("value", "source_file", "reason"), batch_id)
        rows = feed.extract_rows(documents, keep=["source_file"])
        good, bad = _checked(rows.drop("transaction_time_text"))
        quarantine.put(_listed(bad), batch_id)
        order = ("source_file", "feed_index")
        target.insert_ignore(Q.typed_payments(good).drop("feed_pos", "feed_label"), order_cols=order)

    return skip_empty(write)


def lookup_scorer(probabilities: DataFrame, key: str = "trans_num",
                  column: str = "fraud_probability") -> Callable[[DataFrame], DataFrame]:
    """Scorer that reads stored probabilities (stream-static join on the key).

    The stored table grows without bound and a micro-batch is small, so the
    stored scan probes the batch keys (semi join, keys broadcast when the
    batch's row count proves them few) instead of being shuffled per batch.
    """
    probs = probabilities.select(key, F.col(column).alias("fraud_probability"))

    def score(rows: DataFrame) -> DataFrame:
        return rows.join(ST.stored_rows(probs, rows, key, bound=rows), key)

    return score


def model_scorer(model) -> Callable[[DataFrame], DataFrame]:
    """Scorer backed by a fitted ``PipelineModel`` (preprocessing + forest)."""
    from cardsentry.operators import model as M

    def score(rows: DataFrame) -> DataFrame:
        out = M.score(model, FE.model_features(rows, keep=["trans_num"]))
        return out.select("trans_num", "fraud_probability")

    return score


def scored_rows(rows: DataFrame, scorer: Callable[[DataFrame], DataFrame], as_of: _dt.date | None = None,
                variant: str = "stream") -> DataFrame:
    """Features of a micro-batch, scored: label, probability, risk, confidence."""
    feats = FE.clean_merchant(FE.add_features(rows, as_of=as_of, variant=variant))
    s = scorer(feats)
    p = F.col("fraud_probability")
    return s.select(
        "trans_num",
        scoring.above_threshold(p).cast("int").alias("is_fraud_pred"),
        p.alias("fraud_probability"),
        scoring.risk_level(p).alias("risk_level"),
        scoring.confidence(p).alias("confidence"),
    )


def score_and_alert(payments: ST.KeyedTable, predictions: ST.KeyedTable, alerts: ST.KeyedTable,
                    scorer: Callable[[DataFrame], DataFrame], as_of: _dt.date | None = None,
                    alert_time: _dt.datetime | None = None, *, quarantine: ST.StoredRows,
                    training: ST.KeyedTable | None = None) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: insert new payments, score them, write predictions and
    one alert per predicted fraud, and the training rows if asked for.

    What is scored is the stored payment of a key that has no prediction yet,
    so a later duplicate changes nothing, and alerts come from the stored
    predictions. All writes are insert-ignore: a replay after a failure
    between two of them completes the set. Invalid rows, and rows whose time
    cannot be read, go to ``quarantine``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = _checked(batch)
        quarantine.put(_listed(bad), batch_id)
        typed = Q.typed_payments(good)
        payments.insert_ignore(typed)
        stored = ST.stored_rows(payments.near(typed), typed, bound=batch)
        done = predictions.near(typed)
        todo = stored
        if done is not None:
            todo = stored.join(ST.stored_keys(done, typed, bound=batch), "trans_num", "left_anti")
        s = materialize(scored_rows(todo, scorer, as_of), "scored_batch")  # read by the writer's checks too
        predictions.insert_ignore(s.select(
            "trans_num", F.col("is_fraud_pred").cast("boolean").alias("is_fraud"), "fraud_probability",
            "risk_level", "confidence",
        ), order_cols=())
        known = ST.stored_rows(predictions.near(typed), typed, bound=batch)
        alerts.insert_ignore(ST.alerts_from_scores(known, alert_time, label="is_fraud"), order_cols=())
        if training is not None:
            feats = FE.clean_merchant(FE.drop_for_training(FE.add_features(stored, as_of=as_of, variant="stream")))
            training.insert_ignore(feats, order_cols=())

    return skip_empty(write)


# ------------------------------------------------------------ rolling counts


def daily_counts_stream(stream: DataFrame, time_col: str = "predicted_at", label: str = "is_fraud",
                        delay: str = "1 day") -> DataFrame:
    """Counts per day and predicted label. Rows up to ``delay`` behind the newest
    one still count; then a day is final and leaves the state, so the state holds
    the days of the delay and not the history. A later row is dropped (Spark
    counts these in the query's progress)."""
    # wall clock read as UTC: the instant, the window and the day do not
    # depend on the session time zone
    ts = F.timestamp_micros(dates.ntz_epoch(F.col(time_col), "MICROSECOND"))
    day = F.to_date(dates.epoch_to_ntz(F.unix_micros(F.col("w.start")), "MICROSECOND"))
    return (
        stream.withColumn("_event_time", ts)
        .withWatermark("_event_time", delay)
        .groupBy(F.window("_event_time", "1 day").alias("w"), F.col(label).alias("predicted_fraud"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(day.alias("day"), "predicted_fraud", "n")
    )


def daily_upserter(path: str) -> Callable[[DataFrame, int], None]:
    """Update-mode sink: the days that a micro-batch changed take the place of
    their earlier counts, others are not touched. Every (day, label) is a folder
    of its own, so nothing is read, and a replay writes the same again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.repartition("day", "predicted_fraud").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", "predicted_fraud").parquet(path))

    return skip_empty(write)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """(day, predicted_fraud, n) as ``daily_upserter`` stored it."""
    return spark.read.schema("n bigint, day date, predicted_fraud boolean").parquet(path).select(
        "day", "predicted_fraud", "n")


def land_in_order(df: DataFrame, landing: str, time_col: str, pieces: int = 3,
                  landed: Callable[[], object] | None = None) -> str:
    """Land rows in ``pieces`` appends by time, as a feed would have brought them.
    ``landed`` is called after each of them."""
    lo, hi = df.select(F.min(time_col), F.max(time_col)).first()
    if lo is None:
        return landing
    cuts = [lo + (hi - lo) * k / pieces for k in range(1, pieces)]
    t, lits = F.col(time_col), [F.lit(c.isoformat(sep=" ")).cast("timestamp_ntz") for c in cuts]
    for k in range(pieces):
        piece = df if k == 0 else df.where(t >= lits[k - 1])
        (piece if k == pieces - 1 else piece.where(t < lits[k])).write.mode("append").parquet(landing)
        if landed is not None:
            landed()
    return landing
