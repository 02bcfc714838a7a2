"""Feature derivation: one expression library for batch, request and stream.

All functions are ``DataFrame -> DataFrame`` and add columns in a single
projection, so they stay inside one whole-stage-codegen span. A derivation
whose input columns are absent is skipped (checked at plan time), as in the
original feed job; scoring then refuses the frame in ``model_features``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions import dates, geo, text
from cardsentry.schemas import FEED_DROP_COLUMNS, MODEL_FEATURES


class MissingFeaturesError(ValueError):
    """Raised when the model's feature contract cannot be met."""


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric(df: DataFrame, name: str) -> Column:
    """Column as double; text is parsed with ``try_cast`` (bad text -> null)."""
    if isinstance(_type_of(df, name), T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name).cast("double")


def add_age(df: DataFrame, dob_col: str = "dob", as_of: _dt.date | Column | None = None) -> DataFrame:
    if dob_col not in df.columns:
        return df
    return df.withColumn("age", dates.age_years(F.col(dob_col), as_of))


def add_distance(df: DataFrame, lat: str = "lat", lon: str = "long",
                 merch_lat: str = "merch_lat", merch_lon: str = "merch_long") -> DataFrame:
    if any(c not in df.columns for c in (lat, lon, merch_lat, merch_lon)):
        return df
    return df.withColumn(
        "distance_km",
        geo.haversine_km(numeric(df, lat), numeric(df, lon), numeric(df, merch_lat), numeric(df, merch_lon)),
    )


def event_time(df: DataFrame, time_col: str = "transaction_time") -> Column:
    return dates.as_timestamp(F.col(time_col), _type_of(df, time_col))


def add_time_features(df: DataFrame, time_col: str = "transaction_time", variant: str = "request",
                      with_time_text: bool = True) -> DataFrame:
    """hour, time-of-day flags (by variant), calendar parts, weekday, weekend."""
    if time_col not in df.columns:
        return df
    ts = event_time(df, time_col)
    parts = dates.time_parts(ts)
    flags = dates.time_flags(parts["hour"], parts["dayofweek"], variant)
    cols = {}
    if with_time_text:
        cols["time"] = parts["time"]
    cols["hour"] = parts["hour"]
    for name in ("is_night", "is_morning", "is_afternoon", "is_evening", "is_business_hour"):
        cols[name] = flags[name]
    for name in ("year", "month", "day", "dayofweek"):
        cols[name] = parts[name]
    cols["is_we"] = flags["is_we"]
    return df.withColumns(cols)


def add_features(df: DataFrame, as_of: _dt.date | Column | None = None, variant: str = "request",
                 with_time_text: bool = True) -> DataFrame:
    """All engineered features: age, distance, time parts and flags."""
    return (
        df.transform(add_age, as_of=as_of)
        .transform(add_distance)
        .transform(add_time_features, variant=variant, with_time_text=with_time_text)
    )


def clean_merchant(df: DataFrame, col: str = "merchant", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, text.clean_merchant(F.col(col)))


def drop_for_training(df: DataFrame, columns=FEED_DROP_COLUMNS) -> DataFrame:
    """Drop the listed raw columns that are present (absent ones are ignored)."""
    return df.drop(*[c for c in columns if c in df.columns])


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Names present after feature engineering but not before (plan-time)."""
    seen = set(before.columns)
    return [c for c in after.columns if c not in seen]


def model_features(df: DataFrame, keep: list[str] | None = None, numeric_cast: bool = True) -> DataFrame:
    """Select the 21 model features in contract order.

    ``day_of_week`` stands in for ``dayofweek`` when only it exists. A missing
    feature column raises ``MissingFeaturesError`` at plan time. ``keep`` adds
    pass-through columns (keys, labels) in front.
    """
    if "dayofweek" not in df.columns and "day_of_week" in df.columns:
        df = df.withColumnRenamed("day_of_week", "dayofweek")
    missing = [c for c in MODEL_FEATURES if c not in df.columns]
    if missing:
        raise MissingFeaturesError(f"missing features: {missing}")
    from cardsentry.schemas import NUMERIC_FEATURES

    cols = []
    for c in MODEL_FEATURES:
        if numeric_cast and c in NUMERIC_FEATURES:
            cols.append(numeric(df, c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*(keep or []), *cols)


def split_by_dtype(df: DataFrame, columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, other) column names by schema type (plan-time, no data read)."""
    cols = columns or df.columns
    numeric_cols = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    return numeric_cols, [c for c in cols if c not in numeric_cols]


def complete_time_features(df: DataFrame) -> Column:
    """Rows whose time features exist (others go to quarantine)."""
    return F.col("hour").isNotNull()


def feature_coverage(df: DataFrame) -> DataFrame:
    """Rows, and non-null counts of age, distance and hour."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c, name in (("age", "n_age"), ("distance_km", "n_distance"), ("hour", "n_time")):
        if c in df.columns:
            aggs.append(F.count(c).alias(name))
    return df.agg(*aggs)
