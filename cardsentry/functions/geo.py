"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardsentry.functions.numeric import round_binary
from cardsentry.schemas import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, decimals: int | None = 2) -> Column:
    """Great-circle distance in km on a sphere of radius 6371 km.

    Any null coordinate gives null (native null propagation). Rounded to
    ``decimals`` places (2 by default), or unrounded when ``None``.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    km = F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))
    return km if decimals is None else round_binary(km, decimals)
