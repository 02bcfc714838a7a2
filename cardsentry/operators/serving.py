"""Scoring of raw rows in one call: a verdict for each row, or the reasons why
it is refused, and the values before and after feature derivation."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import scoring
from cardsentry.functions.numeric import round_binary
from cardsentry.operators import features as FE
from cardsentry.operators import quality as Q
from cardsentry.schemas import MODEL_FEATURES, NUMERIC_FEATURES

Scorer = Callable[[DataFrame], DataFrame]
# What a scored row gets beside its own columns.
VERDICT = ("status", "reason", "is_fraud", "fraud_probability", "risk_level", "confidence")


def model_probability(model: PipelineModel) -> Scorer:
    """A scorer that adds ``fraud_probability`` by a fitted model; rows keep
    their columns and nothing is joined."""

    def score(rows: DataFrame) -> DataFrame:
        numbers = {c: FE.numeric(rows, c) for c in NUMERIC_FEATURES}
        ready = rows.select(F.struct(*rows.columns).alias("_row"), *[numbers.get(c, F.col(c)).alias(c) for c in MODEL_FEATURES])
        out = model.transform(ready)
        return out.select("_row.*", vector_to_array("probability")[1].alias("fraud_probability"))

    return score


def stored_probability(probabilities: DataFrame, key: str = "trans_num") -> Scorer:
    """A scorer that looks ``fraud_probability`` up; null for an unknown key.
    ``probabilities`` holds a row for each key."""
    known = probabilities.select(key, "fraud_probability")
    return lambda rows: rows.join(known, key, "left")


def score_requests(rows: DataFrame, scorer: Scorer, as_of: _dt.date | None = None,
                   variant: str = "request") -> DataFrame:
    """``rows`` with a verdict: validation, features, score and its shape at once.

    ``status`` is ``scored``, ``refused`` (with the violated rules in ``reason``)
    or ``unscored`` (the scorer has no probability). Every row comes back once;
    only scored rows have a label, probability, risk level and confidence. The
    probability is rounded, the others are taken from the unrounded one.
    """
    checked = Q.with_violations(rows, "_violations")
    good = Q.typed_payments(checked.where(F.size("_violations") == 0).drop("_violations"))
    feats = FE.clean_merchant(FE.add_features(good, as_of=as_of, variant=variant))
    p = F.col("fraud_probability")
    scored = scorer(feats).select(
        F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns]).alias("_row"),
        F.when(p.isNull(), "unscored").otherwise("scored").alias("status"),
        F.when(p.isNull(), "no probability").alias("reason"),
        scoring.above_threshold(p).alias("is_fraud"), round_binary(p, 4).alias("fraud_probability"),
        F.when(p.isNotNull(), scoring.risk_level(p)).alias("risk_level"), scoring.confidence(p).alias("confidence"),
    )
    refused = checked.where(F.size("_violations") > 0).select(
        F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns]).alias("_row"),
        F.lit("refused").alias("status"), F.array_join("_violations", ",").alias("reason"),
        F.lit(None).cast("boolean").alias("is_fraud"), F.lit(None).cast("double").alias("fraud_probability"),
        F.lit(None).cast("string").alias("risk_level"), F.lit(None).cast("double").alias("confidence"),
    )
    kinds = dict(rows.dtypes)
    own = [F.col("_row").getField(c).cast(kinds[c]).alias(c) for c in rows.columns if c not in VERDICT]
    return scored.unionByName(refused).select(*own, *VERDICT)


def original_and_engineered(rows: DataFrame, as_of: _dt.date | None = None, variant: str = "request",
                            key: str = "trans_num") -> DataFrame:
    """(key, original, engineered): the values a row came with, and those of the
    features derived from them, as two structs."""
    after = FE.add_features(rows, as_of=as_of, variant=variant)
    return after.select(
        key, F.struct(*rows.columns).alias("original"), F.struct(*FE.added_columns(rows, after)).alias("engineered"))
