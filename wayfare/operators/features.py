"""Derived trip columns, shared by training, batch scoring and stream scoring."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import calendar, geo, trip


def add_distance(df: DataFrame) -> DataFrame:
    """Add ``distance_km``, computed once per row.

    A plain computed column is copied into every later filter that uses it, and
    the copies of this formula can grow the generated code past what the JVM will
    compile. A one-element generator keeps the filter above the computation, so
    later filters and columns read the finished value.
    """
    return df.drop("distance_km").select("*", F.explode(F.array(geo.pickup_to_dropoff_km())).alias("distance_km"))


def add_calendar(df: DataFrame, peak_hours: Iterable[int] = calendar.TRAINING_PEAK_HOURS) -> DataFrame:
    ts = F.col("pickup_datetime")
    return df.withColumns(
        {
            "pickup_hour": calendar.pickup_hour(ts),
            "pickup_weekday": calendar.pickup_weekday(ts),
            "pickup_month": calendar.pickup_month(ts),
            "is_peak": calendar.is_peak(calendar.pickup_hour(ts), peak_hours),
        }
    )


def add_serving_features(
    df: DataFrame,
    peak_hours: Iterable[int] = calendar.TRAINING_PEAK_HOURS,
    null_distance_as_zero: bool = False,
) -> DataFrame:
    """Every feature a request needs before it is scored.

    ``null_distance_as_zero`` gives distance 0 to rows with a missing coordinate;
    by default the distance stays NULL.
    """
    df = add_distance(df)
    if null_distance_as_zero:
        df = df.withColumn("distance_km", F.coalesce("distance_km", F.lit(0.0)))
    return add_calendar(df, peak_hours).withColumns(
        {
            "airport_trip": trip.airport_trip(),
            "distance_peak": trip.distance_peak(),
            "store_and_fwd_flag_num": trip.flag_to_int(),
        }
    )
