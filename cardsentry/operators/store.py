"""Keyed writes to Parquet tables: insert-if-new, checked against a parent
table, all-or-nothing append, alert append, cascade delete and CSV export.

Plain Parquet has no unique index, so key uniqueness is kept by the writer:
one writer per table (a batch job or one streaming query's foreachBatch).
``insert_ignore`` is idempotent, so a retried micro-batch re-inserts nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from cardsentry.operators.joins import BROADCAST_ROWS_LIMIT, broadcast_if_small
from cardsentry.sources.storage import materialize, new_location

# Folder levels of a table: a part of the keys, and one micro-batch of a log.
PART, MICRO_BATCH = "key_part", "micro_batch"


def now() -> Column:
    """The time of writing, as the stored tables hold it."""
    return F.current_timestamp().cast("timestamp_ntz")


def create_tables(spark: SparkSession, root: str, parts: int = 0) -> dict[str, "KeyedTable"]:
    """The four stored tables under ``root``, opened with their declared columns
    and defaults, and created empty where they do not exist yet."""
    from cardsentry import schemas as S

    serial = {"id": lambda: F.xxhash64("trans_num")}
    defaults: dict[str, dict[str, Callable[[], Column]]] = {
        "payments": {"created_at": now},
        "training_data": {"created_at": now},
        "predictions": {"predicted_at": now},
        "fraud_alerts": {"email_sent": lambda: F.lit(False), "created_at": now},
    }
    tables = {}
    for name, schema in S.STORED_TABLES.items():
        table = KeyedTable(spark, f"{root.rstrip('/')}/{name}", key=S.UNIQUE_KEYS[name], schema=schema,
                           defaults=serial | defaults[name], parts=parts)
        if table.read() is None:
            table.append(spark.createDataFrame([], schema))
        tables[name] = table
    return tables


def first_arrival(batch: DataFrame, key: str = "trans_num",
                  order_cols: Sequence[str] = ("batch_id", "row_idx")) -> DataFrame:
    """One row per key: the earliest by ``order_cols`` (first arrival wins).

    ``min(struct(order..., row...))`` aggregates map-side before the shuffle,
    so a key repeated in a third of all rows still moves one row per task;
    a ``row_number()`` window would sort the whole hot key in one task.
    """
    payload = [c for c in batch.columns if c != key and c not in order_cols]
    if not order_cols:
        return batch.dropDuplicates([key])
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in payload])
    return (
        batch.groupBy(key)
        .agg(F.min(packed).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in list(order_cols) + payload])
        .select(*batch.columns)
    )


def stored_rows(target: DataFrame, keys: DataFrame, key: str = "trans_num",
                broadcast_limit: int = BROADCAST_ROWS_LIMIT, bound: DataFrame | None = None) -> DataFrame:
    """Rows of ``target`` whose key is among ``keys`` (see ``stored_keys``)."""
    distinct = keys.select(key).distinct()
    if bound is None:
        distinct = broadcast_if_small(distinct, broadcast_limit)
    elif bound.count() <= broadcast_limit:
        distinct = F.broadcast(distinct)
    return target.join(distinct, key, "left_semi")


def stored_keys(target: DataFrame, keys: DataFrame, key: str = "trans_num",
                broadcast_limit: int = BROADCAST_ROWS_LIMIT, bound: DataFrame | None = None) -> DataFrame:
    """Keys of ``keys`` already present in ``target``.

    The target grows without bound and a micro-batch is small, so the target
    scan probes the batch keys (semi join) instead of being shuffled. The
    keys are broadcast only after a count proves them few; beyond the limit
    the plain shuffle join is used. ``bound`` is a frame with at least one
    row per distinct key (the batch before deduplication): counting its rows
    needs no shuffle, unlike counting the distinct keys themselves.
    """
    return stored_rows(target.select(key), keys, key, broadcast_limit, bound)


def new_rows(batch: DataFrame, target: DataFrame | None, key: str = "trans_num",
             order_cols: Sequence[str] = ("batch_id", "row_idx")) -> DataFrame:
    """Rows of ``batch`` to insert: deduplicated, and absent from ``target``.

    ``batch LEFT ANTI target`` could only broadcast the target; instead the
    (small) set of batch keys already stored is found first and removed.
    """
    rows = first_arrival(batch, key, order_cols)
    if target is None:
        return rows
    return rows.join(stored_keys(target, rows, key, bound=batch), key, "left_anti")


@dataclass
class StoredRows:
    """Parquet rows in a folder. The folder alone says whether there are any, so
    a table opened again after a restart goes on where it was."""

    spark: SparkSession
    path: str

    @classmethod
    def create(cls, spark: SparkSession, name: str) -> "StoredRows":
        """Rows at a fresh place under the shared folder."""
        return cls(spark, new_location(spark, name))

    def _scan(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self) -> DataFrame | None:
        """The stored rows; None before the first write."""
        found = self._scan()
        return None if found is None else found.drop(PART, MICRO_BATCH)

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of one micro-batch in a folder of its own: a replayed
        batch takes the place of its first try, so nothing is stored twice."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{MICRO_BATCH}={batch_id}")


@dataclass
class KeyedTable(StoredRows):
    """A Parquet table at a path, appended to by one writer, a row for each key.

    With a declared ``schema`` every write gets its columns and types: missing
    columns take their default or null, others are not stored. Otherwise rows are
    stored as they come, and ``stamp`` names a column that gets the time of
    writing where a batch lacks it. With ``parts`` the rows are kept in that many
    folders by a hash of the key; a batch then reads those of its keys only.
    """

    key: str = "trans_num"
    stamp: str | None = None
    schema: T.StructType | None = None
    defaults: dict[str, Callable[[], Column]] = field(default_factory=dict)
    parts: int = 0

    @classmethod
    def create(cls, spark: SparkSession, name: str, key: str = "trans_num", stamp: str | None = None,
               **more) -> "KeyedTable":
        """A table at a fresh place under the shared folder."""
        return cls(spark, new_location(spark, name), key, stamp, **more)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _scan(self) -> DataFrame | None:
        if self.schema is None:
            return super()._scan()
        part = [T.StructField(PART, T.IntegerType())] if self.parts else []
        full = T.StructType([*self.schema, *part])
        try:
            return self.spark.read.schema(full).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def near(self, keys: DataFrame) -> DataFrame | None:
        """The stored rows among which those of ``keys`` are: with ``parts``,
        only the folders that the keys fall into are read. What reaches the
        driver are part numbers."""
        found = self._scan()
        if found is None or not self.parts:
            return found
        hit = sorted(r[0] for r in keys.select(self._part().alias("p")).distinct().collect())
        return found.where(F.col(PART).isin(hit)).drop(PART)

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns that the table stores."""
        if self.schema is None:
            if self.stamp is not None and self.stamp not in df.columns:
                df = df.withColumn(self.stamp, now())
            return df
        cols = []
        for f in self.schema:
            if f.name in df.columns:
                c = F.col(f.name)
            else:
                c = self.defaults[f.name]() if f.name in self.defaults else F.lit(None)
            cols.append(c.cast(f.dataType).alias(f.name))
        return df.select(*cols)

    def append(self, df: DataFrame) -> int:
        """Append rows; returns how many, as counted by the write itself."""
        rows = self.conform(df)
        if self.parts:
            # one file a part and batch
            rows = rows.withColumn(PART, self._part()).repartition(PART)
        written = Observation()
        rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
        writer = rows.write.mode("append")
        (writer.partitionBy(PART) if self.parts else writer).parquet(self.path)
        return written.get["n"]

    def rewritten(self, path: str) -> "KeyedTable":
        """The same rows at another path, in few files: the many small ones of
        single batches are read together. The table itself is left alone."""
        other = KeyedTable(self.spark, path, self.key, self.stamp, self.schema, self.defaults, self.parts)
        rows = self.read()
        if rows is not None:
            other.append(rows)
        return other

    def insert_ignore(self, batch: DataFrame, order_cols: Sequence[str] = ("batch_id", "row_idx"),
                      keep_order_cols: bool = False) -> int:
        """Insert the batch rows whose key is new; duplicates are skipped.
        Returns the number of rows inserted."""
        # one listing of the growing target folder per batch
        target = self.near(batch)
        rows = new_rows(batch, target, self.key, order_cols)
        if not keep_order_cols:
            rows = rows.drop(*[c for c in order_cols if c != self.key])
        if target is not None and self.schema is None:
            rows = rows.select(*[c for c in target.columns if c not in (self.stamp, PART) or c in rows.columns])
        return self.append(rows)

    def insert_checked(self, batch: DataFrame, parent: "KeyedTable", refused: StoredRows, batch_id: int,
                       order_cols: Sequence[str] = ()) -> dict[str, int]:
        """Insert the rows whose key is new and stored in ``parent``.

        Each row is ``inserted``, a ``duplicate`` (of a stored row, or of an
        earlier one of the batch), an ``orphan`` (no parent row) or
        ``incomplete`` (null in a column declared as not null, or in the key).
        Orphans and incomplete rows are stored in ``refused`` with that reason.
        Returns how many of each there are; they add up to the batch.
        """
        needed = [self.key] + [f.name for f in self.schema or [] if not f.nullable and f.name in batch.columns]
        incomplete = F.greatest(*[F.col(c).isNull().cast("int") for c in dict.fromkeys(needed)], F.lit(0)) == 1
        rows = first_arrival(batch.where(~incomplete), self.key, order_cols)
        mine, theirs = self.near(batch), parent.near(batch)
        for name, table in (("_stored", mine), ("_known", theirs)):
            if table is None:
                rows = rows.withColumn(name, F.lit(False))
                continue
            keys = stored_keys(table, rows, self.key, bound=batch).distinct().withColumn(name, F.lit(True))
            rows = rows.join(keys, self.key, "left").fillna(False, [name])
        state = F.when(~F.col("_known"), "orphan").when(F.col("_stored"), "duplicate").otherwise("inserted")
        tagged = materialize(rows.withColumn("_state", state).drop("_stored", "_known"), "checked-rows")
        lost = batch.where(incomplete).withColumn("_state", F.lit("incomplete"))
        refused.put(
            tagged.where("_state = 'orphan'").unionByName(lost).withColumnRenamed("_state", "reason"), batch_id)
        counts = {r[0]: r[1] for r in tagged.groupBy("_state").count().collect()}
        total, n_lost = batch.agg(F.count(F.lit(1)), F.count_if(incomplete)).first()
        inserted = self.append(tagged.where("_state = 'inserted'").drop("_state"))
        # an orphan's later copies are orphans too, but one row tells
        return {"inserted": inserted, "orphan": counts.get("orphan", 0), "incomplete": n_lost,
                "duplicate": total - inserted - counts.get("orphan", 0) - n_lost}

    def append_atomic(self, batch: DataFrame) -> bool:
        """All-or-nothing append: refuse the whole batch when any key is
        already stored or repeated inside the batch. Returns True if written.

        The check is two distributed aggregates reduced to one boolean each
        (``limit(1)`` stops at the first conflict).
        """
        key = self.key
        dup_in_batch = batch.groupBy(key).count().where(F.col("count") > 1).limit(1).count() > 0
        target = self.near(batch)
        clash = False
        if target is not None:
            clash = stored_keys(target, batch, key, bound=batch).limit(1).count() > 0
        if dup_in_batch or clash:
            return False
        self.append(batch)
        return True

    def write(self, batch: DataFrame, on_conflict: str = "ignore",
              order_cols: Sequence[str] = ()) -> bool:
        """Write a batch keyed on ``key``.

        ``on_conflict="ignore"`` (default) inserts the new keys and skips the
        rest, so a retried stream batch is idempotent; ``"fail"`` is the
        original all-or-nothing append (returns False and writes nothing when
        any key clashes).
        """
        if on_conflict == "ignore":
            self.insert_ignore(batch, order_cols=order_cols)
            return True
        if on_conflict == "fail":
            return self.append_atomic(batch)
        raise ValueError("on_conflict must be 'ignore' or 'fail'")


def alerts_from_scores(scored: DataFrame, created_at=None, label: str = "is_fraud_pred") -> DataFrame:
    """One pending alert per predicted fraud (email not sent)."""
    if created_at is None:
        ts = now()
    else:  # a wall-clock literal, independent of the session time zone
        ts = F.lit(created_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return scored.where(F.col(label).cast("int") == 1).select(
        "trans_num",
        F.lit(False).alias("email_sent"),
        F.lit(None).cast("timestamp_ntz").alias("email_sent_at"),
        ts.cast("timestamp_ntz").alias("created_at"),
    )


def cascade_delete(parent: DataFrame, children: dict[str, DataFrame], keep: F.Column,
                   key: str = "trans_num") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete parent rows not matching ``keep`` and every child row that
    referenced them. Children are joined with the deleted keys, the few; a
    child without a parent row is left alone."""
    gone = parent.where(~F.coalesce(keep, F.lit(False))).select(key)
    return parent.where(keep), {n: c.join(gone, key, "left_anti") for n, c in children.items()}


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write ``df`` as CSV with a header row. ``single_file`` coalesces to one
    part (only for small reports; a large export stays parallel)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path
