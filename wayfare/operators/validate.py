"""Request validation: every request is either accepted or quarantined with its reasons."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RequestRules:
    """Inclusive ranges and allowed values of a request."""

    # Fixed values.
    lon_range: tuple[float, float] = (-74.1, -73.7)
    lat_range: tuple[float, float] = (40.5, 41.0)
    first_date: str = "2016-01-01"
    last_date: str = "2030-12-31"
    passengers: tuple[int, int] = (1, 6)
    vendors: tuple[int, ...] = (1, 2)
    flags: tuple[str, ...] = ("N", "Y")

    def checks(self) -> dict[str, Column]:
        """Reason -> condition a good request satisfies."""
        day = F.col("pickup_datetime").cast("date")
        return {
            "pickup_latitude": F.col("pickup_latitude").between(*self.lat_range),
            "pickup_longitude": F.col("pickup_longitude").between(*self.lon_range),
            "dropoff_latitude": F.col("dropoff_latitude").between(*self.lat_range),
            "dropoff_longitude": F.col("dropoff_longitude").between(*self.lon_range),
            "pickup_date": day.between(F.lit(self.first_date).cast("date"), F.lit(self.last_date).cast("date")),
            "passenger_count": F.col("passenger_count").between(*self.passengers),
            "vendor_id": F.col("vendor_id").isin(*self.vendors),
            "store_and_fwd_flag": F.col("store_and_fwd_flag").isin(*self.flags),
        }


def validate_requests(requests: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Add ``reasons`` (array, empty when the request is good) and ``accepted``.

    A missing value fails its check. ``accepted`` is a plain conjunction, so
    that rows can be routed without building the reasons of good requests.
    Works on a batch or a stream.
    """
    passed = {reason: F.coalesce(ok, F.lit(False)) for reason, ok in rules.checks().items()}
    failed = [F.when(~ok, F.lit(reason)) for reason, ok in passed.items()]
    return requests.withColumns(
        {"reasons": F.array_compact(F.array(*failed)), "accepted": reduce(and_, passed.values())}
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("accepted")).drop("reasons", "accepted")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.filter(~F.col("accepted")).drop("accepted")


def rejection_counts(validated: DataFrame) -> DataFrame:
    """How often each reason occurred."""
    return (
        validated.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("requests"))
        .orderBy("reason")
    )
