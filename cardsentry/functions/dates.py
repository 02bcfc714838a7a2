"""Calendar and time-of-day column expressions.

Three variants of the time-of-day flags exist in the original application
(training notebook, feed job, request API); they are exposed through
``variant`` so that train and score can be made to agree.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANTS = ("request", "stream", "training")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(col) -> Column:
    """Text ``YYYY-MM-DD`` (or a date) to date; empty or bad text -> null."""
    return F.try_to_date(F.nullif(F.trim(_c(col).cast("string")), F.lit("")), "yyyy-MM-dd")


def as_timestamp(col, dtype: T.DataType | None = None) -> Column:
    """Text or timestamp to timestamp; bad text -> null (ANSI-safe)."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _c(col)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return epoch_to_ntz(_c(col), "MILLISECOND")  # epoch milliseconds
    return F.try_to_timestamp(_c(col).cast("string"))


def age_years(dob, as_of: _dt.date | Column | None = None) -> Column:
    """Whole years between birth date and ``as_of`` (default today),
    minus one before the birthday in the ``as_of`` year."""
    born = as_date(dob)
    ref = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    before_birthday = (F.month(ref) * 100 + F.dayofmonth(ref)) < (F.month(born) * 100 + F.dayofmonth(born))
    return (F.year(ref) - F.year(born) - before_birthday.cast("int")).cast("int")


def _flag(cond: Column) -> Column:
    # boolean -> 0/1 with null kept null (no time -> no time features)
    return cond.cast("int")


def time_flags(hour: Column, dow: Column, variant: str = "request") -> dict[str, Column]:
    """Time-of-day and weekend flags for one of the three variants.

    ``request``: night is 22h-6h, half-open periods, business 8h-17h open.
    ``stream``: night never set, half-open periods, business 8h-17h closed.
    ``training``: night never set, closed periods, business 8h-17h closed.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    h = hour
    if variant == "request":
        night = _flag((h >= 22) | (h < 6))
        morning = _flag((h >= 6) & (h < 12))
        afternoon = _flag((h >= 12) & (h < 18))
        evening = _flag((h >= 18) & (h < 22))
        business = _flag((h >= 8) & (h < 17))
    elif variant == "stream":
        night = F.when(h.isNotNull(), F.lit(0))
        morning = _flag((h >= 6) & (h < 12))
        afternoon = _flag((h >= 12) & (h < 18))
        evening = _flag((h >= 18) & (h < 22))
        business = _flag(h.between(8, 17))
    else:
        night = F.when(h.isNotNull(), F.lit(0))
        morning = _flag(h.between(6, 12))
        afternoon = _flag(h.between(12, 18))
        evening = _flag(h.between(18, 22))
        business = _flag(h.between(8, 17))
    return {
        "is_night": night,
        "is_morning": morning,
        "is_afternoon": afternoon,
        "is_evening": evening,
        "is_business_hour": business,
        "is_we": _flag(dow.between(5, 6)),
    }


def time_parts(ts: Column) -> dict[str, Column]:
    """Hour, calendar parts, weekday (0 = Monday) and time-of-day text."""
    return {
        "time": F.date_format(ts, "HH:mm:ss"),
        "hour": F.hour(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "dayofweek": F.weekday(ts),
    }


# ------------------------------------------------------------ zone-free epoch arithmetic
# Wall-clock (TIMESTAMP_NTZ) values are converted to and from epoch counts
# as if they were UTC, whatever the session time zone is.

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_epoch(col: Column, unit: str = "MILLISECOND") -> Column:
    """Whole ``unit``s since 1970-01-01 00:00 of a wall-clock timestamp."""
    return F.timestamp_diff(unit, F.expr(_EPOCH_NTZ), col.cast("timestamp_ntz"))


def epoch_to_ntz(count: Column, unit: str = "MILLISECOND") -> Column:
    """Wall-clock timestamp ``count`` ``unit``s after 1970-01-01 00:00."""
    return F.timestamp_add(unit, count, F.expr(_EPOCH_NTZ))
