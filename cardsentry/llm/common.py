"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words in the contracts of this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
# Rows and bytes that a Python worker is sent at a time, whichever is reached first.
SMALL_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches as SMALL_BATCH bounds them while the steps inside are run."""
    before = {name: spark.conf.get(name) for name in SMALL_BATCH}
    for name, value in SMALL_BATCH.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def col(name: str) -> Column:
    """A top-level column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that helper columns cannot clash with them."""
    return F.struct(*[col(c) for c in df.columns]).alias(name)


def unpacked(columns: list[str], new: dict[str, Column], name: str = "row") -> list[Column]:
    """The columns of a packed row; a computed column takes the place of one
    of the same name."""
    kept = [F.col(name).getField(c).alias(c) for c in columns if c not in new]
    return kept + [v.alias(k) for k, v in new.items()]


def unit_hash(*parts: Column | str) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the parts joined by ':'.

    A null part counts as '~'. DuckDB can compute the same from ``md5``.
    """
    cols = [F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(p) for p in parts]
    digits = F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 13), 16, 10)
    return (digits.cast("bigint").cast("double") + F.lit(0.5)) / F.lit(2.0**52)


def key_hash(*parts: Column | str) -> Column:
    """52 bits of the MD5 of the parts joined by ':' as a bigint."""
    cols = [F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 13), 16, 10).cast("bigint")
