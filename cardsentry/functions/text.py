"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardsentry.schemas import MERCHANT_PREFIX


def clean_merchant(col: Column) -> Column:
    """Text after the last ``fraud_`` marker (whole value when absent)."""
    return F.element_at(F.split(col, MERCHANT_PREFIX, -1), -1)
