"""Registered validation and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardsentry.operators import quality as Q
from cardsentry.plans.catalog import Inputs, register
from cardsentry.schemas import FOREIGN_KEYS, NOT_NULL

# Rule texts for the DuckDB twins, in the order the Spark rules are listed.
_REQ = ["cc_num", "merchant", "category", "amt", "gender", "state", "zip",
        "lat", "long", "city_pop", "merch_lat", "merch_long", "dob", "transaction_time"]
RULES_SQL: list[tuple[str, str]] = (
    [(f"missing:{f}", f"{f} IS NULL") for f in _REQ]
    + [(f"type:{f}", f"{f} IS NOT NULL AND TRY_CAST({f} AS BIGINT) IS NULL") for f in ("cc_num", "zip", "city_pop")]
    + [(f"type:{f}", f"{f} IS NOT NULL AND TRY_CAST({f} AS DOUBLE) IS NULL")
       for f in ("amt", "lat", "long", "merch_lat", "merch_long")]
    + [("range:amt", "TRY_CAST(amt AS DOUBLE) <= 0"),
       ("range:city_pop", "TRY_CAST(city_pop AS BIGINT) <= 0")]
    + [(f"range:{f}", f"(TRY_CAST({f} AS DOUBLE) < -90 OR TRY_CAST({f} AS DOUBLE) > 90)")
       for f in ("lat", "merch_lat")]
    + [(f"range:{f}", f"(TRY_CAST({f} AS DOUBLE) < -180 OR TRY_CAST({f} AS DOUBLE) > 180)")
       for f in ("long", "merch_long")]
)
VALID_SQL = " AND ".join(f"NOT coalesce({c}, false)" for _, c in RULES_SQL)
VIOLATIONS_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in RULES_SQL) + ")"

GOOD_COLS_SQL = """batch_id, row_idx, trans_num, cc_num, CAST(CAST(amt AS DECIMAL(10,2)) AS DOUBLE) AS amt,
  CAST(lat AS DOUBLE) AS lat, CAST(long AS DOUBLE) AS long, CAST(merch_lat AS DOUBLE) AS merch_lat,
  CAST(merch_long AS DOUBLE) AS merch_long, CAST(city_pop AS INTEGER) AS city_pop, dob, transaction_time"""


def typed_good(i: Inputs):
    good, _ = Q.split_good_bad(i.payments_feed)
    return Q.typed_payments(good)


@register("validate_good", f"SELECT {GOOD_COLS_SQL} FROM payments_feed WHERE {VALID_SQL}")
def validate_good(i: Inputs):
    return typed_good(i).select(
        "batch_id", "row_idx", "trans_num", "cc_num", F.col("amt").cast("double").alias("amt"),
        "lat", "long", "merch_lat", "merch_long", "city_pop", "dob", "transaction_time",
    )


@register("validate_violations", " UNION ALL ".join(
    f"SELECT '{r}' AS rule, count(*) AS n FROM payments_feed WHERE {c} HAVING count(*) > 0"
    for r, c in RULES_SQL
))
def validate_violations(i: Inputs):
    return Q.violation_counts(i.payments_feed)


@register("validate_overflow", """
SELECT 'overflow:amt' AS rule, count(*) AS n FROM payments_feed WHERE row_idx % 97 IN (0, 1)
UNION ALL SELECT 'overflow:city_pop', count(*) FROM payments_feed WHERE row_idx % 97 = 2
""")
def validate_overflow(i: Inputs):
    """Values that parse but do not fit the stored types are violations."""
    kind = F.col("row_idx") % 97
    feed = i.payments_feed.withColumn(
        "amt", F.when(kind == 0, F.lit("123456789012.5")).when(kind == 1, F.lit("NaN")).otherwise(F.col("amt"))
    ).withColumn("city_pop", F.when(kind == 2, F.lit("3000000000")).otherwise(F.col("city_pop")))
    return Q.violation_counts(feed).where(F.col("rule").startswith("overflow:"))


@register("validate_quarantine", f"""
SELECT batch_id, row_idx, trans_num, {VIOLATIONS_SQL} AS violations
FROM payments_feed WHERE NOT ({VALID_SQL})
""")
def validate_quarantine(i: Inputs):
    _, bad = Q.split_good_bad(i.payments_feed)
    return bad.select("batch_id", "row_idx", "trans_num", F.array_join("violations", ",").alias("violations"))


_STORED = ["payments", "training_data", "predictions", "fraud_alerts"]


def _stored(i: Inputs) -> dict:
    return {n: getattr(i, n) for n in _STORED}


@register("dq_non_empty", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, EXISTS (SELECT 1 FROM {t}) AS ok" for t in _STORED
))
def dq_non_empty(i: Inputs):
    return Q.non_empty(_stored(i))


_KEYED = _STORED + ["payments_feed"]


@register("dq_duplicate_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, trans_num AS key, count(*) AS n FROM {t} GROUP BY trans_num HAVING count(*) > 1"
    for t in _KEYED
))
def dq_duplicate_keys(i: Inputs):
    return Q.duplicate_keys({n: getattr(i, n) for n in _KEYED})


_NULL_SPEC = {**NOT_NULL, "payments_feed": ["trans_num", "amt", "dob", "transaction_time"]}


@register("dq_nulls", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM {t}"
    for t, cols in _NULL_SPEC.items() for c in cols
))
def dq_nulls(i: Inputs):
    return Q.null_counts({t: (getattr(i, t), cols) for t, cols in _NULL_SPEC.items()})


@register("fk_orphans", " UNION ALL ".join(
    f"SELECT '{c}' AS child, '{p}' AS parent, count(*) AS n_orphans FROM {c} x "
    f"WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{k})"
    for c, p, k in FOREIGN_KEYS
))
def fk_orphans(i: Inputs):
    return Q.orphan_counts({(c, p): (getattr(i, c), getattr(i, p)) for c, p, _ in FOREIGN_KEYS})
