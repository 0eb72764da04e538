"""Trip scans: CSV, Parquet, and the projection of ``events`` onto the trip schema."""

from __future__ import annotations

import re
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schema import EVENT_SCHEMA, REQUEST_COLUMNS, REQUEST_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA


# Wall-clock times down to the microsecond; the fraction may be absent.
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


#: Holds the line of a row with a cell that does not parse.
CORRUPT = "_corrupt_record"


#: A header that is not the one a reader was made for is an error.
READ_OPTIONS = CSV_OPTIONS | {"enforceSchema": "false"}
#: Headers read at once.
HEADERS_AT_ONCE = 16


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV table by their header; the parts of a folder may differ in their columns and the order of these.
    Only the first line of each file is read. Files without any line are left out."""
    # Listed paths come as addresses: escaped, and without a meaning for the signs of a pattern.
    files = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in sorted(spark.read.text(path).inputFiles())]
    header = inheritable_thread_target(spark)(lambda f: tuple(spark.read.options(**CSV_OPTIONS).csv(f).columns))
    with ThreadPool(max(1, min(HEADERS_AT_ONCE, len(files)))) as pool:
        headers = pool.map(header, files, chunksize=1)
    found: dict[tuple[str, ...], list[str]] = {}
    for columns, file in zip(headers, files, strict=True):
        if columns:
            found.setdefault(columns, []).append(file)
    if not found:
        raise ValueError(f"{path} has no header")
    return found


def by_name(header: tuple[str, ...], schema: T.StructType, path: str) -> T.StructType:
    """The schema in the order of a header; columns it does not declare are text."""
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = {f.name: f for f in schema}
    return T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])


def read_by_name(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """All files of a CSV table, columns by name: a reader for each header that occurs. A column named in
    ``columnNameOfCorruptRecord`` comes last."""
    corrupt = options.get("columnNameOfCorruptRecord")
    parts = []
    for header, files in files_by_header(spark, path).items():
        found = by_name(header, schema, files[0])
        found = found.add(corrupt, T.StringType()) if corrupt else found
        read = spark.read.schema(found).options(**READ_OPTIONS, **options).csv(files)
        parts.append(read.select(*schema.fieldNames(), *([corrupt] if corrupt else [])))
    return reduce(DataFrame.union, parts)


def parse_trips_csv(spark: SparkSession, path: str, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """All rows of a CSV with a header, columns by name, with the line of a malformed row in ``_corrupt_record``.

    Whether a row is malformed shows only when all its columns are read: write the result, then use
    ``well_formed`` and ``malformed`` on what was written.
    """
    return read_by_name(spark, path, schema, columnNameOfCorruptRecord=CORRUPT)


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(parsed: DataFrame) -> DataFrame:
    """The lines that do not parse, as they stand in the file."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def read_trips_csv(
    spark: SparkSession, path: str, schema: T.StructType = TRIP_SCHEMA, infer: bool = False
) -> DataFrame:
    """CSV with a header, columns by name; a cell that does not parse is an error (see ``parse_trips_csv``).

    ``infer=True`` finds the types in one more pass over the file and then reads
    timestamps as wall-clock time, whatever the session zone."""
    if not infer:
        return read_by_name(spark, path, schema, mode="FAILFAST")
    parts = []
    for files in files_by_header(spark, path).values():
        found = spark.read.options(**CSV_OPTIONS).option("inferSchema", True).csv(files).schema
        clock = T.TimestampNTZType()
        types = [T.StructField(f.name, clock if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in found]
        parts.append(spark.read.schema(T.StructType(types)).options(**READ_OPTIONS).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_trips_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A declared schema spares the footer-reading job that inference would run.
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A glob with one alternative: the table may be one file or a folder of parts.
    return reader.parquet(f"{sf_dir}/events.{{parquet}}")


def stream_requests(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Requests as Parquet files arriving in a folder."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


# Exponent literals are doubles; a plain 0.24 would be a decimal.
EVENT_PARTS = [
    "event_id",
    "ts",
    "user_id",
    "value",
    "-7405e-2 + CAST((event_id * 7919) % 1000 AS DOUBLE) * 3e-4 AS plon",
    "4060e-2 + CAST((event_id * 6271) % 1000 AS DOUBLE) * 3e-4 AS plat",
    "CAST((event_id * 3571) % 1000 AS DOUBLE) - 500e0 AS dx",
    "CAST((event_id * 4583) % 1000 AS DOUBLE) - 500e0 AS dy",
]
# What cleaning and validation test, as the one element of an array.
TESTED_PARTS = """inline(array(struct(
    CAST(CASE WHEN event_id % 50 = 0 THEN 0
              WHEN event_id % 97 = 0 THEN 7 + event_id % 3
              WHEN event_id % 227 = 0 THEN NULL
              ELSE 1 + event_id % 6 END AS INT) AS passenger_count,
    CASE WHEN event_id % 113 = 0 THEN plon + 2e0
         WHEN event_id % 223 = 0 THEN DOUBLE('NaN')
         ELSE plon END AS pickup_longitude,
    plat AS pickup_latitude,
    CASE WHEN event_id % 149 = 0 THEN plon
         WHEN event_id % 83 = 0 THEN plon + IF(plon < -739e-1, 24e-2, -24e-2)
         ELSE plon + dx * 2e-4 END AS dropoff_longitude,
    CASE WHEN event_id % 149 = 0 OR event_id % 83 = 0 THEN plat
         ELSE plat + dy * 2e-4 END AS dropoff_latitude,
    CAST(CASE WHEN event_id % 131 = 0 THEN 1
              WHEN event_id % 137 = 0 THEN 100000
              WHEN event_id % 167 = 0 THEN 61
              WHEN event_id % 173 = 0 THEN 7000
              WHEN event_id % 83 = 0 THEN FLOOR(1500e0 + value * 8e0)
              ELSE FLOOR(120e0 + (ABS(dx) + ABS(dy)) * 2e0 + value * 4e0) END AS INT) AS trip_duration)))"""
TRIP_PARTS = [
    "CONCAT('id', CAST(event_id AS STRING)) AS id",
    "CAST(1 + user_id % 2 AS INT) AS vendor_id",
    "ts + make_dt_interval(CAST((event_id % 6) * 30 AS INT)) AS pickup_datetime",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "CASE WHEN event_id % 211 = 0 THEN NULL "
    "WHEN event_id % 180 = 0 OR event_id % 181 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
    "trip_duration",
]
DROPOFF_TIME = "pickup_datetime + make_dt_interval(0, 0, 0, trip_duration)"


def trips_from_events(events: DataFrame) -> DataFrame:
    """Project events onto the trip schema by integer arithmetic on the event id.

    Works on a batch or a stream. Only ``event_id, ts, user_id, value`` are read.
    Positions, passengers and duration are what filters test; yielding them from
    a one-element generator makes them finished values, where a plain projection
    would be rewritten into every comparison above it. The other columns stay
    plain projections and can be pruned. SQL text keeps the many small
    expressions to a few calls into the JVM.
    """
    return (
        events.selectExpr(*EVENT_PARTS)
        .selectExpr("event_id", "ts", "user_id", TESTED_PARTS)
        .selectExpr(*TRIP_PARTS)
        .withColumn("dropoff_datetime", F.expr(DROPOFF_TIME))
        .select(*TRIP_COLUMNS)
    )


def read_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips derived from the events table of a data folder."""
    return trips_from_events(read_events(spark, sf_dir))


def requests_from_trips(trips: DataFrame) -> DataFrame:
    """What is known before a trip starts: no drop-off time, no duration."""
    return trips.select(*REQUEST_COLUMNS)
