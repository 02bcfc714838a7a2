"""DuckDB twins of the registered queries.

Each text is a complete statement over the raw test tables: the fixture
views are spelled out as CTEs (``FIXTURE_CTES``), then the query itself.
The texts are independent of the Spark code paths they check.
"""

from __future__ import annotations

# ------------------------------------------------------------ SQL snippets

def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    return f"round(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - ({a})))), 2)"


def age_sql(dob: str, y: int = 2026, m: int = 1, d: int = 29) -> str:
    dd = f"TRY_CAST(NULLIF(trim(CAST({dob} AS VARCHAR)), '') AS DATE)"
    return (
        f"CAST({y} - year({dd}) - CASE WHEN {m * 100 + d} < month({dd}) * 100 + day({dd}) "
        f"THEN 1 ELSE 0 END AS INTEGER)"
    )


def flags_sql(ts: str, variant: str) -> dict[str, str]:
    h = f"hour({ts})"
    dow = f"(isodow({ts}) - 1)"

    def b(cond: str) -> str:
        return f"CAST({cond} AS INTEGER)"

    zero = f"CASE WHEN {h} IS NOT NULL THEN 0 END"
    if variant == "request":
        out = {
            "is_night": b(f"({h} >= 22 OR {h} < 6)"),
            "is_morning": b(f"({h} >= 6 AND {h} < 12)"),
            "is_afternoon": b(f"({h} >= 12 AND {h} < 18)"),
            "is_evening": b(f"({h} >= 18 AND {h} < 22)"),
            "is_business_hour": b(f"({h} >= 8 AND {h} < 17)"),
        }
    elif variant == "stream":
        out = {
            "is_night": zero,
            "is_morning": b(f"({h} >= 6 AND {h} < 12)"),
            "is_afternoon": b(f"({h} >= 12 AND {h} < 18)"),
            "is_evening": b(f"({h} >= 18 AND {h} < 22)"),
            "is_business_hour": b(f"({h} BETWEEN 8 AND 17)"),
        }
    else:
        out = {
            "is_night": zero,
            "is_morning": b(f"({h} BETWEEN 6 AND 12)"),
            "is_afternoon": b(f"({h} BETWEEN 12 AND 18)"),
            "is_evening": b(f"({h} BETWEEN 18 AND 22)"),
            "is_business_hour": b(f"({h} BETWEEN 8 AND 17)"),
        }
    out["is_we"] = b(f"({dow} BETWEEN 5 AND 6)")
    return out


def time_parts_sql(ts: str) -> dict[str, str]:
    return {
        "time": f"strftime({ts}, '%H:%M:%S')",
        "hour": f"CAST(hour({ts}) AS INTEGER)",
        "year": f"CAST(year({ts}) AS INTEGER)",
        "month": f"CAST(month({ts}) AS INTEGER)",
        "day": f"CAST(day({ts}) AS INTEGER)",
        "dayofweek": f"CAST(isodow({ts}) - 1 AS INTEGER)",
    }


def clean_merchant_sql(col: str) -> str:
    return f"string_split({col}, 'fraud_')[-1]"


_STREAM_FLAGS = flags_sql("transaction_time", "stream")
_PARTS = time_parts_sql("transaction_time")

FIXTURE_CTES = f"""
WITH payments AS (
  SELECT e.event_id AS id, concat('T', CAST(e.event_id AS VARCHAR)) AS trans_num,
    CAST(e.user_id AS VARCHAR) AS cc_num, concat('fraud_', s.s_name) AS merchant,
    e.event_type AS category, CAST(e.value AS DECIMAL(10,2)) AS amt,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, c.c_mktsegment AS city,
    n.n_name AS state, CAST(10000 + c.c_custkey % 89999 AS VARCHAR) AS zip,
    CAST(1000 + (c.c_custkey * 7919) % 1000000 AS INTEGER) AS city_pop,
    CAST(24.5 AS DOUBLE) + CAST((c.c_custkey * 37) % 2500 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat,
    CAST(-66.5 AS DOUBLE) - CAST((c.c_custkey * 53) % 5800 AS DOUBLE) / CAST(100 AS DOUBLE) AS long,
    CAST(24.5 AS DOUBLE) + CAST((c.c_custkey * 37) % 2500 AS DOUBLE) / CAST(100 AS DOUBLE)
      + CAST((e.event_id * 41) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_lat,
    CAST(-66.5 AS DOUBLE) - CAST((c.c_custkey * 53) % 5800 AS DOUBLE) / CAST(100 AS DOUBLE)
      + CAST((e.event_id * 59) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_long,
    CAST(DATE '1940-01-01' + CAST((c.c_custkey * 97) % 22000 AS INTEGER) AS VARCHAR) AS dob,
    CASE WHEN e.event_id % 50 = 0 THEN 1 ELSE 0 END AS is_fraud,
    e.ts AS transaction_time, e.ts AS created_at
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN supplier s ON e.event_id % (SELECT count(*) FROM supplier) = s.s_suppkey
),
predictions AS (
  SELECT id, trans_num, p > CAST(0.5 AS DOUBLE) AS is_fraud, p AS fraud_probability,
    created_at + INTERVAL '20' SECOND AS predicted_at
  FROM (SELECT id, trans_num, created_at,
          CAST(((id * 7919) % 1001) * ((id * 7919) % 1001) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS p
        FROM payments WHERE id % 10 <> 3) t
),
training_data AS (
  SELECT id, trans_num, cc_num, {clean_merchant_sql('merchant')} AS merchant, category, amt, gender,
    state, zip, city_pop,
    {haversine_sql('lat', 'long', 'merch_lat', 'merch_long')} AS distance_km,
    {age_sql('dob')} AS age,
    {_PARTS['hour']} AS hour,
    {_STREAM_FLAGS['is_business_hour']} AS is_business_hour,
    {_STREAM_FLAGS['is_morning']} AS is_morning,
    {_STREAM_FLAGS['is_afternoon']} AS is_afternoon,
    {_STREAM_FLAGS['is_evening']} AS is_evening,
    {_STREAM_FLAGS['is_night']} AS is_night,
    {_PARTS['year']} AS year, {_PARTS['month']} AS month, {_PARTS['day']} AS day,
    {_PARTS['dayofweek']} AS dayofweek,
    {_STREAM_FLAGS['is_we']} AS is_we,
    is_fraud, created_at
  FROM payments WHERE id % 7 <> 0
),
fraud_alerts AS (
  SELECT id, trans_num, id % 3 = 0 AS email_sent,
    CASE WHEN id % 3 = 0 THEN predicted_at + INTERVAL '1' SECOND END AS email_sent_at,
    predicted_at AS created_at
  FROM predictions WHERE is_fraud
  UNION ALL
  SELECT id, trans_num, false, CAST(NULL AS TIMESTAMP), created_at FROM payments WHERE id % 100 = 3
),
payments_feed AS (
  SELECT 1 AS batch_id, * FROM (
    SELECT id AS row_idx, CAST(id AS VARCHAR) AS id, trans_num, cc_num, merchant, category,
      CAST(CASE WHEN id % 101 = 0 THEN -amt ELSE amt END AS VARCHAR) AS amt,
      gender, city, state, zip, CAST(city_pop AS VARCHAR) AS city_pop,
      CAST(CASE WHEN id % 97 = 0 THEN lat + CAST(100 AS DOUBLE) ELSE lat END AS VARCHAR) AS lat,
      CAST(long AS VARCHAR) AS long, CAST(merch_lat AS VARCHAR) AS merch_lat,
      CAST(merch_long AS VARCHAR) AS merch_long,
      CASE WHEN id % 89 = 0 THEN '' ELSE dob END AS dob,
      CAST(is_fraud AS VARCHAR) AS is_fraud,
      CASE WHEN id % 83 = 0 THEN NULL ELSE strftime(transaction_time, '%Y-%m-%d %H:%M:%S.%f') END
        AS transaction_time
    FROM payments) b
  UNION ALL
  SELECT 2 AS batch_id, * FROM (
    SELECT id AS row_idx, CAST(id AS VARCHAR) AS id, trans_num, cc_num, merchant, category,
      CAST(CASE WHEN id % 101 = 0 THEN -amt ELSE amt END AS VARCHAR) AS amt,
      gender, city, state, zip, CAST(city_pop AS VARCHAR) AS city_pop,
      CAST(CASE WHEN id % 97 = 0 THEN lat + CAST(100 AS DOUBLE) ELSE lat END AS VARCHAR) AS lat,
      CAST(long AS VARCHAR) AS long, CAST(merch_lat AS VARCHAR) AS merch_lat,
      CAST(merch_long AS VARCHAR) AS merch_long,
      CASE WHEN id % 89 = 0 THEN '' ELSE dob END AS dob,
      CAST(is_fraud AS VARCHAR) AS is_fraud,
      CASE WHEN id % 83 = 0 THEN NULL ELSE strftime(transaction_time, '%Y-%m-%d %H:%M:%S.%f') END
        AS transaction_time
    FROM payments WHERE id % 20 = 0) b
),
scored AS (
  SELECT p.trans_num, CAST(p.amt AS DOUBLE) AS amt, p.merchant, p.category, p.city, p.state,
    pred.is_fraud AS predicted_fraud, pred.fraud_probability, pred.predicted_at
  FROM predictions pred JOIN payments p ON pred.trans_num = p.trans_num
)
"""


def with_fixtures(body: str) -> str:
    return FIXTURE_CTES + body
