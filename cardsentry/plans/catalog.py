"""Registry of named queries: key -> (Spark plan builder, DuckDB twin).

Every registered query reads the driver's test tables (through the fixture
views derived from them), so its work grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cardsentry.plans.oracle import with_fixtures
from cardsentry.sources import tables
from cardsentry.sources.storage import materialize


class Inputs:
    """The fixture tables of one scale-factor folder, built once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def payments(self) -> DataFrame:
        return tables.payments(self.spark, self.sf_dir)

    @cached_property
    def predictions(self) -> DataFrame:
        return tables.predictions(self.spark, self.sf_dir, self.payments)

    @cached_property
    def training_data(self) -> DataFrame:
        return tables.training_data(self.spark, self.sf_dir, self.payments)

    @cached_property
    def fraud_alerts(self) -> DataFrame:
        return tables.fraud_alerts(self.spark, self.sf_dir, self.payments, self.predictions)

    @cached_property
    def spread_payments(self) -> DataFrame:
        """The payments for jobs that write them out or score them in bulk."""
        return tables.payments(self.spark, self.sf_dir, spread=True)

    @cached_property
    def spread_predictions(self) -> DataFrame:
        # every micro-batch and landed piece reads them: written once
        return materialize(tables.predictions(self.spark, self.sf_dir, self.spread_payments), "predictions")

    @cached_property
    def payments_feed(self) -> DataFrame:
        # The feed is a landing table of arrived files: write it once to the
        # shared folder so every consumer reads plain text columns instead of
        # re-deriving (and re-inlining) the defect expressions.
        return materialize(tables.payments_feed(self.spark, self.sf_dir, self.spread_payments), "payments_feed")


QueryFn = Callable[[Inputs], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name`` with its SQL twin."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name!r}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn

    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from cardsentry.plans import (  # noqa: F401
        q_features, q_ml, q_quality, q_reports, q_scoring, q_sources, q_store, q_stream,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {name: (lambda spark, sf_dir, _fn=fn: _fn(Inputs(spark, sf_dir))) for name, fn in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
