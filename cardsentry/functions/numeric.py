"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(x: Column, decimals: int) -> Column:
    """Scale-then-round in double arithmetic, half away from zero (the C
    ``round(x * 10^d) / 10^d`` rule, also DuckDB's).

    Spark's ``round`` rounds the shortest decimal text of the double half-up,
    so 0.81395 (stored as 0.81394999...) becomes 0.8140; this rule follows
    the binary value and gives 0.8139, as the original Python code does.
    Where the scaled product itself rounds onto a half (2.675 * 100 is
    exactly 267.5) it rounds up, while Python's exact rounding gives 2.67.
    """
    m = float(10 ** decimals)
    return F.signum(x) * F.floor(F.abs(x) * m + F.lit(0.5)) / F.lit(m)
