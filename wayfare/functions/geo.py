"""Great-circle distance and position predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Haversine distance in km; NULL when any coordinate is NULL.

    ``1 - a`` is clamped at zero because rounding can push ``a`` past one for
    antipodal points. Squares are written with ``pow`` so each trigonometric
    call stands once in the expression.
    """
    lat1, lon1, lat2, lon2 = (F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2))
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2.0)
    )
    arc = F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))
    return F.lit(2.0) * arc * F.lit(EARTH_RADIUS_KM)


def pickup_to_dropoff_km() -> Column:
    return haversine_km("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def in_box(lon: str, lat: str, lon_range: tuple[float, float], lat_range: tuple[float, float]) -> Column:
    """Inclusive bounding box; NaN fails (it compares above every number)."""
    return F.col(lon).between(*lon_range) & F.col(lat).between(*lat_range)


def grid_cell(value: Column | str, size: float) -> Column:
    """Index of the grid cell of edge ``size`` that holds ``value``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value / F.lit(float(size))).cast("bigint")
