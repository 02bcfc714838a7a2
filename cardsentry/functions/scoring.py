"""Score-shaping and display column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardsentry.functions.numeric import round_binary

from cardsentry.schemas import (
    ALERT_THRESHOLD, EMAIL_PENDING, EMAIL_SENT, NOT_AVAILABLE, RISK_LEVELS, RISK_TOP_LEVEL,
    STATUS_FRAUD, STATUS_LEGIT,
)


def risk_level(p: Column) -> Column:
    """LOW < 0.3 <= MEDIUM < 0.6 <= HIGH < 0.8 <= CRITICAL (unrounded p)."""
    expr = None
    for bound, name in RISK_LEVELS:
        expr = F.when(p < bound, name) if expr is None else expr.when(p < bound, name)
    return expr.otherwise(RISK_TOP_LEVEL)


def confidence(p: Column, decimals: int = 4) -> Column:
    """Distance from the 0.5 decision point, scaled to [0, 1]."""
    return round_binary(F.abs(p - F.lit(0.5)) * 2, decimals)


def above_threshold(p: Column) -> Column:
    return p > F.lit(ALERT_THRESHOLD)


def money(amount: Column) -> Column:
    """``$12.30`` display text (null stays null)."""
    return F.when(amount.isNotNull(), F.format_string("$%.2f", amount.cast("double")))


def percent(p: Column) -> Column:
    """``12.3%`` display text; rounding done numerically first."""
    return F.when(p.isNotNull(), F.format_string("%.1f%%", round_binary(p * 100, 1)))


def percent_or_na(p: Column) -> Column:
    # format_string renders a null argument as the text "null": test first
    return F.when(p.isNull(), F.lit(NOT_AVAILABLE)).otherwise(percent(p))


def fraud_status(flag: Column) -> Column:
    return F.when(flag, STATUS_FRAUD).otherwise(STATUS_LEGIT)


def email_status(flag: Column) -> Column:
    return F.when(flag, EMAIL_SENT).otherwise(EMAIL_PENDING)
