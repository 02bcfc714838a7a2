"""Row validation with quarantine, and table-level data-quality checks.

Validation mirrors the request schema: 14 required fields, integer and
float fields that must parse, and range rules. Instead of failing a whole
request, every row carries the list of rules it breaks; good rows have an
empty list, bad rows go to quarantine. All checks are aggregates or joins
that Spark partitions; nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.schemas import LAT_RANGE, LONG_RANGE, REQUIRED_FIELDS

# Field types of the request schema.
INT_FIELDS = ["cc_num", "zip", "city_pop"]
FLOAT_FIELDS = ["amt", "lat", "long", "merch_lat", "merch_long"]
# Further whole numbers of the stored rows, and texts that must name a time.
STORED_INTS = ["id", "is_fraud"]
DATE_FIELDS = {"dob": "date", "transaction_time": "timestamp_ntz"}
# What feed text is stored as.
STORED_TYPES = {
    "id": "bigint", "amt": "decimal(10,2)", "lat": "double", "long": "double",
    "merch_lat": "double", "merch_long": "double", "city_pop": "int", "is_fraud": "int",
}


def _parsed(df: DataFrame, name: str, kind: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.try_cast("bigint" if kind == "int" else "double")
    return c.cast("bigint" if kind == "int" else "double")


def _text_that_is_no(df: DataFrame, name: str, kind: str) -> Column:
    """Whether a text column holds a value that is neither null, empty nor of ``kind``."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return F.col(name).isNotNull() & (F.trim(name) != "") & F.col(name).try_cast(kind).isNull()


def rules(df: DataFrame) -> list[tuple[str, Column]]:
    """(rule name, violated?) for every rule whose field exists in ``df``.

    A value must also survive being stored: one that would become null, another
    value or an amount of zero breaks a rule. An empty date of birth is an
    unknown one and no fault.
    """
    out: list[tuple[str, Column]] = []
    cols = set(df.columns)
    for f in REQUIRED_FIELDS:
        if f not in cols:
            continue
        out.append((f"missing:{f}", F.col(f).isNull()))
    for f in INT_FIELDS + STORED_INTS:
        if f in cols:
            out.append((f"type:{f}", F.col(f).isNotNull() & _parsed(df, f, "int").isNull()))
    for f in FLOAT_FIELDS:
        if f in cols:
            out.append((f"type:{f}", F.col(f).isNotNull() & _parsed(df, f, "float").isNull()))
    for f, kind in DATE_FIELDS.items():
        if f in cols:
            out.append((f"type:{f}", _text_that_is_no(df, f, kind)))
    if "amt" in cols:
        stored = F.col("amt").try_cast(STORED_TYPES["amt"])
        out.append(("range:amt", (_parsed(df, "amt", "float") <= 0) | (stored <= 0)))
    if "city_pop" in cols:
        out.append(("range:city_pop", _parsed(df, "city_pop", "int") <= 0))
    if "is_fraud" in cols:
        out.append(("range:is_fraud", ~_parsed(df, "is_fraud", "int").isin(0, 1)))
    # a value that parses but does not fit the stored type would become null
    for f, kind, stored in (("amt", "float", STORED_TYPES["amt"]), ("city_pop", "int", STORED_TYPES["city_pop"])):
        if f in cols:
            out.append((f"overflow:{f}", _parsed(df, f, kind).isNotNull() & F.col(f).try_cast(stored).isNull()))
    for f, (lo, hi) in (("lat", LAT_RANGE), ("merch_lat", LAT_RANGE),
                        ("long", LONG_RANGE), ("merch_long", LONG_RANGE)):
        if f in cols:
            v = _parsed(df, f, "float")
            out.append((f"range:{f}", (v < lo) | (v > hi) | F.isnan(v)))
    return out


def with_violations(df: DataFrame, name: str = "violations") -> DataFrame:
    """Add an array of violated rule names (empty when the row is good)."""
    checks = [F.when(F.coalesce(cond, F.lit(False)), F.lit(rule)) for rule, cond in rules(df)]
    return df.withColumn(name, F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"))


def split_good_bad(df: DataFrame, checked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marker, quarantined rows with their violations).
    ``checked`` are the rows with their violations, if they are known."""
    v = with_violations(df) if checked is None else checked
    good = v.where(F.size("violations") == 0).drop("violations")
    bad = v.where(F.size("violations") > 0)
    return good, bad


def typed_payments(df: DataFrame) -> DataFrame:
    """Cast validated feed text to the stored payment types."""
    cols = []
    for c in df.columns:
        if c in STORED_TYPES and isinstance(df.schema[c].dataType, T.StringType):
            cols.append(F.col(c).try_cast(STORED_TYPES[c]).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def violation_counts(df: DataFrame) -> DataFrame:
    """(rule, n): rows breaking each rule (one row can break several)."""
    return (
        with_violations(df)
        .select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ------------------------------------------------------------- table checks

def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, ok): each table has at least one row; reads one row each."""
    parts = [
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("ok")).select(F.lit(name).alias("table_name"), "ok")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(tables: dict[str, DataFrame], key: str = "trans_num") -> DataFrame:
    """(table_name, key, n) for keys held by more than one row.

    ``count`` aggregates map-side first, so a hot key costs one row per task
    before the shuffle.
    """
    parts = [
        df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(name).alias("table_name"), "key", "n")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_name, column_name, n_null): one pass per table, then unpivot."""
    parts = []
    for name, (df, columns) in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(
            agg.unpivot([], list(columns), "column_name", "n_null").select(
                F.lit(name).alias("table_name"), "column_name", "n_null"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(child: DataFrame, parent: DataFrame, key: str = "trans_num") -> DataFrame:
    """Child rows whose key has no parent row (left anti join)."""
    return child.join(parent.select(key), key, "left_anti")


def orphan_counts(pairs: dict[tuple[str, str], tuple[DataFrame, DataFrame]], key: str = "trans_num") -> DataFrame:
    parts = [
        orphans(c, p, key).agg(F.count(F.lit(1)).alias("n_orphans")).select(
            F.lit(cn).alias("child"), F.lit(pn).alias("parent"), "n_orphans"
        )
        for (cn, pn), (c, p) in pairs.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
