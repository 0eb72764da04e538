"""Trip measures, flags and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
AIRPORT_KM = (18, 23)
SHORT_BELOW_MIN = 10
LONG_FROM_MIN = 30
SECONDS_PER_HOUR = 3600


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_to_int(flag: Column | str = "store_and_fwd_flag") -> Column:
    """'Y' -> 1, any other value -> 0, NULL stays NULL."""
    return (_col(flag) == "Y").cast("int")


def log_label(seconds: Column | str = "trip_duration") -> Column:
    return F.log1p(_col(seconds))


def seconds_from_log(log_seconds: Column | str) -> Column:
    return F.expm1(_col(log_seconds))


def minutes(seconds: Column | str) -> Column:
    return _col(seconds) / F.lit(60.0)


def speed_kmh(distance: Column | str, seconds: Column | str) -> Column:
    """Average speed; NULL for a zero duration."""
    return F.try_divide(_col(distance), _col(seconds) / SECONDS_PER_HOUR)


def speed_kmh_or_zero(distance: Column | str, seconds: Column | str) -> Column:
    """Average speed with 0 where the duration is not positive."""
    return F.when(_col(seconds) > 0, speed_kmh(distance, seconds)).otherwise(F.lit(0.0))


def airport_trip(distance: Column | str = "distance_km", bounds: tuple[float, float] = AIRPORT_KM) -> Column:
    return _col(distance).between(*bounds).cast("int")


def distance_peak(distance: Column | str = "distance_km", peak: Column | str = "is_peak") -> Column:
    return _col(distance) * _col(peak)


def distance_bin(distance: Column | str, width: float = 1.0) -> Column:
    return F.floor(_col(distance) / F.lit(float(width))) * F.lit(float(width))


def duration_band(duration_minutes: Column | str) -> Column:
    m = _col(duration_minutes)
    return (
        F.when(m < SHORT_BELOW_MIN, F.lit("short"))
        .when(m < LONG_FROM_MIN, F.lit("normal"))
        .when(m.isNotNull(), F.lit("long"))
    )


def fixed_text(value: Column | str, places: int) -> Column:
    """Decimal text with a fixed number of places and no thousands separator."""
    rounded = F.round(_col(value).cast("double"), places)
    return F.format_string(f"%.{places}f", rounded)


def yes_no(flag: Column | str) -> Column:
    return F.when(_col(flag) == 1, F.lit("Yes")).otherwise(F.lit("No"))
