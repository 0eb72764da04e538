"""The six demonstration trips with the distance of their own coordinates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wayfare.schema import REQUEST_SCHEMA

# Pickup time, pickup lat, lon, drop-off lat, lon, vendor, passengers, flag, distance in km.
DEMO = [
    ("06:30", 40.7614, -73.9776, 40.7505, -73.9934, 1, 1, "N", 1.8000),
    ("17:45", 40.7580, -73.9855, 40.7282, -73.9942, 2, 2, "N", 3.3937),
    ("14:20", 40.7614, -73.9776, 40.6413, -73.7781, 1, 3, "N", 21.4750),
    ("23:15", 40.7282, -73.9942, 40.6892, -73.9442, 2, 1, "Y", 6.0471),
    ("12:00", 40.7580, -73.9855, 40.7614, -73.9776, 1, 4, "N", 0.7653),
    ("14:30", 40.7589, -73.9851, 40.7614, -73.9776, 1, 1, "N", 0.6901),
]


def demo_requests(spark: SparkSession) -> DataFrame:
    rows = [
        (
            f"demo{i}",
            vendor,
            datetime.fromisoformat(f"2016-06-15T{clock}:00"),
            passengers,
            lon1,
            lat1,
            lon2,
            lat2,
            flag,
        )
        for i, (clock, lat1, lon1, lat2, lon2, vendor, passengers, flag, _) in enumerate(DEMO)
    ]
    return spark.createDataFrame(rows, REQUEST_SCHEMA)
