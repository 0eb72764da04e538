"""Outlier rules, the cleaned table and the cleaning funnel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import calendar, geo, trip
from wayfare.operators.features import add_calendar, add_distance
from wayfare.operators.profile import OneRow
from wayfare.schema import DERIVED_COLUMNS


@dataclass(frozen=True)
class CleanRules:
    """Thresholds of the four cleaning steps, all bounds inclusive."""

    # Fixed values.
    passenger_outliers: tuple[int, ...] = (0, 7, 8, 9)
    lon_range: tuple[float, float] = (-74.1, -73.7)
    lat_range: tuple[float, float] = (40.5, 41.0)
    duration_range: tuple[int, int] = (60, 7200)
    speed_range: tuple[float, float] = (2, 120)
    peak_hours: tuple[int, ...] = calendar.TRAINING_PEAK_HOURS
    airport_km: tuple[float, float] = trip.AIRPORT_KM

    def passengers_ok(self) -> Column:
        return ~F.col("passenger_count").isin(*self.passenger_outliers)

    def position_ok(self) -> Column:
        return geo.in_box("pickup_longitude", "pickup_latitude", self.lon_range, self.lat_range) & geo.in_box(
            "dropoff_longitude", "dropoff_latitude", self.lon_range, self.lat_range
        )

    def duration_ok(self) -> Column:
        """A trip also needs its pickup time, from which the calendar features come."""
        return F.col("trip_duration").between(*self.duration_range) & F.col("pickup_datetime").isNotNull()

    def speed_ok(self) -> Column:
        """Needs ``distance_km`` and ``avg_speed_kmh``."""
        return (F.col("distance_km") > 0) & F.col("avg_speed_kmh").between(*self.speed_range)


def filter_passengers(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    return df.filter(rules.passengers_ok())


def filter_positions(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    return df.filter(rules.position_ok())


def filter_durations(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    return df.filter(rules.duration_ok())


def add_measures(df: DataFrame) -> DataFrame:
    """Distance and average speed of a completed trip."""
    return add_distance(df).withColumn("avg_speed_kmh", trip.speed_kmh("distance_km", "trip_duration"))


def clean_trips(trips: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Rows that pass every rule, with the derived columns. Narrow: no shuffle."""
    raw = trips.drop(*DERIVED_COLUMNS)
    kept = raw.transform(filter_passengers, rules).transform(filter_positions, rules).transform(filter_durations, rules)
    kept = kept.transform(add_measures).filter(rules.speed_ok())
    featured = add_calendar(kept, rules.peak_hours).withColumns(
        {
            "store_and_fwd_flag_num": trip.flag_to_int(),
            "log_duration": trip.log_label(),
            "airport_trip": trip.airport_trip("distance_km", rules.airport_km),
            "distance_peak": trip.distance_peak(),
        }
    )
    return featured.select(*raw.columns, *DERIVED_COLUMNS)


#: Steps of the funnel; a CSV has a step before them.
STEPS = ["raw", "passenger_count", "bounding_box", "trip_duration", "speed"]
MALFORMED = "malformed"


def steps_passed(rules: CleanRules = CleanRules()) -> Column:
    """How many cleaning steps a row with its measures passes before one drops it."""
    fails = [
        ~F.coalesce(ok, F.lit(False))
        for ok in (rules.passengers_ok(), rules.position_ok(), rules.duration_ok(), rules.speed_ok())
    ]
    return F.when(fails[0], 0).when(fails[1], 1).when(fails[2], 2).when(fails[3], 3).otherwise(4)


def funnel_rows(steps: list[str]) -> list[Column]:
    """A row for each step, from the counts n0, n1, …"""
    return [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(step).alias("step"),
            F.col(f"n{i}").alias("rows"),
            (F.col(f"n{max(i - 1, 0)}") - F.col(f"n{i}")).alias("dropped"),
        )
        for i, step in enumerate(steps)
    ]


def funnel_report(passed: str) -> OneRow:
    """The funnel of rows with their number of steps in the column ``passed``."""
    return OneRow({f"n{i}": F.count_if(F.col(passed) >= i) for i in range(len(STEPS))}, funnel_rows(STEPS))


def cleaning_funnel(trips: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Rows left and rows dropped after each step, from one pass over the trips."""
    return funnel_report("passed").of(add_measures(trips).select(steps_passed(rules).alias("passed")))
