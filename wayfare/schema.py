"""Declared schemas and the feature groups used by models and reports."""

from __future__ import annotations

from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("trip_duration", T.IntegerType()),
    ]
)

# A request is a trip before it happens: no drop-off time, no duration.
REQUEST_SCHEMA = T.StructType(
    [f for f in TRIP_SCHEMA.fields if f.name not in ("dropoff_datetime", "trip_duration")]
)

DERIVED_FIELDS = [
    T.StructField("store_and_fwd_flag_num", T.IntegerType()),
    T.StructField("log_duration", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("pickup_hour", T.IntegerType()),
    T.StructField("pickup_weekday", T.IntegerType()),
    T.StructField("pickup_month", T.IntegerType()),
    T.StructField("is_peak", T.IntegerType()),
    T.StructField("airport_trip", T.IntegerType()),
    T.StructField("distance_peak", T.DoubleType()),
]

CLEAN_SCHEMA = T.StructType(TRIP_SCHEMA.fields + DERIVED_FIELDS)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()
REQUEST_COLUMNS = REQUEST_SCHEMA.fieldNames()
DERIVED_COLUMNS = [f.name for f in DERIVED_FIELDS]
CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()
# What a request gets before it is scored: all but what needs the duration.
SERVING_COLUMNS = [c for c in DERIVED_COLUMNS if c not in ("log_duration", "avg_speed_kmh")]

LABEL = "log_duration"

# Integer columns that may hold NULLs.
NULLABLE_COUNTS = ("passenger_count", "store_and_fwd_flag_num")

NUMERIC_COLUMNS = [
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "trip_duration",
]
CATEGORY_COLUMNS = [
    "vendor_id",
    "store_and_fwd_flag",
    "store_and_fwd_flag_num",
    "passenger_count",
    "pickup_hour",
    "pickup_weekday",
    "pickup_month",
    "is_peak",
]
CORRELATION_COLUMNS = [
    "distance_km",
    "passenger_count",
    "pickup_hour",
    "pickup_weekday",
    "pickup_month",
    "log_duration",
]

# Model feature sets. ``vendor_idx`` and ``cluster_idx`` are made by indexing stages.
BASE_7 = (
    "distance_km",
    "pickup_hour",
    "passenger_count",
    "is_peak",
    "airport_trip",
    "store_and_fwd_flag_num",
    "vendor_idx",
)
BASE_9 = (
    "distance_km",
    "pickup_hour",
    "passenger_count",
    "is_peak",
    "airport_trip",
    "store_and_fwd_flag_num",
    "pickup_weekday",
    "pickup_month",
    "vendor_idx",
)
INTERACTION_10 = BASE_9 + ("distance_peak",)
CLUSTER_10 = BASE_9 + ("cluster_idx",)
POSITION_2 = ("pickup_longitude", "pickup_latitude")
