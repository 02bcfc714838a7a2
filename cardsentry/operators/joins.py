"""Size-checked broadcast for joins whose small side is small by nature but
not by proof (batch keys, category dictionaries), and joins on group keys
that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a side is never broadcast (about 100 MB of short keys).
BROADCAST_ROWS_LIMIT = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS_LIMIT) -> DataFrame:
    """``broadcast(df)`` when a count shows at most ``max_rows`` rows, else
    ``df`` unchanged (the planner then shuffles both sides; AQE still splits
    skewed partitions). The count is one small job over the small side."""
    return F.broadcast(df) if df.count() <= max_rows else df


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys where a null group matches the null group, as in
    ``GROUP BY``; the keys appear once in the result."""
    other = right.select(*[
        F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns
    ])
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, match, how).drop(*[f"_right_{k}" for k in keys])
