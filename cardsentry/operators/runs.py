"""History of training runs: an append-only table of runs, one of stage changes,
and the champion that both give."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.operators.evaluate import champion_challenger
from cardsentry.operators.store import KeyedTable, now

PRODUCTION, ARCHIVED = "Production", "Archived"

MODEL_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("recall", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("meets_requirements", T.BooleanType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("recorded_at", T.TimestampNTZType()),
])
# ``step`` numbers the changes; ``change_id`` names one, so a retry adds none.
STAGE_CHANGES = T.StructType([
    T.StructField("change_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("stage", T.StringType()),
    T.StructField("step", T.LongType(), False),
    T.StructField("changed_at", T.TimestampNTZType()),
])


@dataclass
class RunHistory:
    """Runs are recorded once and never changed; a stage is what the last change
    of a run says. Promoting a run archives the one in production before."""

    runs: KeyedTable
    changes: KeyedTable

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "RunHistory":
        """The history under ``root``; what an earlier job recorded is there."""
        root = root.rstrip("/")
        tables = (
            KeyedTable(spark, f"{root}/model_runs", "run_id", schema=MODEL_RUNS, defaults={"recorded_at": now}),
            KeyedTable(spark, f"{root}/stage_changes", "change_id", schema=STAGE_CHANGES, defaults={"changed_at": now}),
        )
        for t in tables:
            if t.read() is None:
                t.append(spark.createDataFrame([], t.schema))
        return cls(*tables)

    def record(self, runs: DataFrame, params: dict | None = None) -> int:
        """Record runs (run_id and metrics); a run that is recorded already stays
        as it is. Returns how many were new."""
        if params is not None:
            pairs = [F.lit(x) for k, v in params.items() for x in (str(k), str(v))]
            runs = runs.withColumn("params", F.create_map(*pairs))
        return self.runs.insert_ignore(runs, order_cols=())

    def current(self) -> DataFrame:
        """The runs with their present stage (null if never changed) and the step
        of that change."""
        last = self.changes.read().groupBy("run_id").agg(
            F.max_by("stage", "step").alias("stage"), F.max("step").alias("step"))
        return self.runs.read().join(last, "run_id", "left")

    def promote(self, run_id: str) -> bool:
        """Put a recorded run into production and archive the one there before.
        False, and nothing written, if there is no such run or it is there."""
        spark = self.runs.spark
        now_ = self.current().select(
            F.max(F.coalesce("step", F.lit(0))).alias("step"),
            F.max(F.when(F.col("run_id") == run_id, F.coalesce("stage", F.lit("")))).alias("stage"),
        ).first()
        if now_.stage is None or now_.stage == PRODUCTION:
            return False
        there = [r.run_id for r in self.current().where(F.col("stage") == PRODUCTION).select("run_id").collect()]
        step = now_.step + 1
        rows = [(f"{step}:{r}", r, ARCHIVED, step) for r in there] + [(f"{step}:{run_id}", run_id, PRODUCTION, step)]
        batch = spark.createDataFrame(rows, "change_id string, run_id string, stage string, step bigint")
        self.changes.insert_ignore(batch, order_cols=())  # one write: both changes or none
        return True

    def champion(self) -> DataFrame:
        """The run in production, no row if there is none."""
        return self.current().where(F.col("stage") == PRODUCTION)

    def decide(self) -> DataFrame:
        """The deploy decision for every run not yet staged, against the run in
        production (see ``champion_challenger``)."""
        runs = self.current().where(F.col("stage").isNull() | (F.col("stage") == PRODUCTION))
        return champion_challenger(runs.drop("step", "params", "recorded_at", "accuracy"), PRODUCTION)

    def stage_log(self) -> DataFrame:
        """(run_id, stage, step, until): when a stage began and by which step it
        ended, null for the present one."""
        until = F.lead("step").over(Window.partitionBy("run_id").orderBy("step"))
        return self.changes.read().select("run_id", "stage", "step", until.alias("until"))
