"""The registered queries in SQL, for an engine that shares no code with Spark.

Every statement starts from the ``events`` view. Doubles are rounded to six
places on both sides; adding zero turns a rounded -0.0 into 0.0.
"""

from __future__ import annotations

from itertools import combinations

from wayfare import schema as S

# Rows that come from a fitted model differ in the last digits by the solver.
FITTED_PLACES = 3

BOX_LON = "BETWEEN -741e-1 AND -737e-1"
BOX_LAT = "BETWEEN 405e-1 AND 410e-1"


def r(expression: str, name: str | None = None, places: int = 6) -> str:
    rounded = f"round(CAST({expression} AS DOUBLE), {places}) + 0e0"
    return f"{rounded} AS {name}" if name else rounded


def whole(column: str) -> str:
    """An integer column that holds NULLs, in the form the comparison expects."""
    return f"CAST({column} AS DOUBLE) AS {column}"


def rcols(*names: str, places: int = 6) -> str:
    return ", ".join(r(n, n, places) for n in names)


TRIPS = """
e AS (
  SELECT event_id, ts, value, user_id,
    CAST((event_id * 7919) % 1000 AS DOUBLE) AS a, CAST((event_id * 6271) % 1000 AS DOUBLE) AS b,
    CAST((event_id * 3571) % 1000 AS DOUBLE) AS c, CAST((event_id * 4583) % 1000 AS DOUBLE) AS g
  FROM events),
x AS (SELECT *, -7405e-2 + a * 3e-4 AS plon, 4060e-2 + b * 3e-4 AS plat FROM e),
y AS (
  SELECT *,
    CASE WHEN event_id % 149 = 0 THEN plon
         WHEN event_id % 83 = 0 AND plon < -739e-1 THEN plon + 24e-2
         WHEN event_id % 83 = 0 THEN plon - 24e-2
         ELSE plon + (c - 500e0) * 2e-4 END AS dlon,
    CASE WHEN event_id % 149 = 0 OR event_id % 83 = 0 THEN plat
         ELSE plat + (g - 500e0) * 2e-4 END AS dlat
  FROM x),
z AS (
  SELECT CONCAT('id', CAST(event_id AS STRING)) AS id,
    CAST(1 + user_id % 2 AS INT) AS vendor_id,
    ts + to_days(CAST((event_id % 6) * 30 AS INT)) AS pickup_datetime,
    CAST(CASE WHEN event_id % 50 = 0 THEN 0
              WHEN event_id % 97 = 0 THEN 7 + event_id % 3
              WHEN event_id % 227 = 0 THEN NULL
              ELSE 1 + event_id % 6 END AS INT) AS passenger_count,
    CASE WHEN event_id % 113 = 0 THEN plon + 2e0
         WHEN event_id % 223 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE plon END AS pickup_longitude,
    plat AS pickup_latitude, dlon AS dropoff_longitude, dlat AS dropoff_latitude,
    CASE WHEN event_id % 211 = 0 THEN NULL
         WHEN event_id % 180 = 0 OR event_id % 181 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(CASE WHEN event_id % 131 = 0 THEN 1
              WHEN event_id % 137 = 0 THEN 100000
              WHEN event_id % 167 = 0 THEN 61
              WHEN event_id % 173 = 0 THEN 7000
              WHEN event_id % 83 = 0 THEN FLOOR(1500e0 + value * 8e0)
              ELSE FLOOR(120e0 + (ABS(c - 500e0) + ABS(g - 500e0)) * 2e0 + value * 4e0)
         END AS INT) AS trip_duration
  FROM y),
trips AS (
  SELECT id, vendor_id, pickup_datetime, pickup_datetime + to_seconds(trip_duration) AS dropoff_datetime,
    passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
    store_and_fwd_flag, trip_duration
  FROM z)"""

HALF_CHORD = (
    "pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2) + cos(radians(pickup_latitude)) * "
    "cos(radians(dropoff_latitude)) * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2)"
)


def distance_of(source: str, where: str = "TRUE") -> str:
    """Rows of ``source`` with the great-circle distance."""
    return (
        "SELECT * EXCLUDE (half_chord), "
        "2e0 * atan2(sqrt(half_chord), sqrt(greatest(1e0 - half_chord, 0e0))) * 6371e0 AS distance_km "
        f"FROM (SELECT *, {HALF_CHORD} AS half_chord FROM {source} WHERE {where})"
    )


PASSENGERS_OK = "passenger_count NOT IN (0, 7, 8, 9)"
POSITION_OK = (
    f"pickup_longitude {BOX_LON} AND pickup_latitude {BOX_LAT} "
    f"AND dropoff_longitude {BOX_LON} AND dropoff_latitude {BOX_LAT}"
)
DURATION_OK = "trip_duration BETWEEN 60 AND 7200"
SPEED_OK = "distance_km > 0 AND avg_speed_kmh BETWEEN 2 AND 120"

CALENDAR = """
    CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_weekday,
    CAST(month(pickup_datetime) AS INT) AS pickup_month,
    CAST(hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19) AS INT) AS is_peak"""

CLEAN = f"""{TRIPS},
placed AS (SELECT * FROM trips WHERE {PASSENGERS_OK} AND {POSITION_OK}),
measured AS ({distance_of("placed", DURATION_OK)}),
sped AS (SELECT *, distance_km / (trip_duration / 3600e0) AS avg_speed_kmh FROM measured),
kept AS (SELECT *, {CALENDAR} FROM sped WHERE {SPEED_OK}),
clean AS (
  SELECT id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
    pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration,
    CAST(store_and_fwd_flag = 'Y' AS INT) AS store_and_fwd_flag_num,
    ln(1e0 + trip_duration) AS log_duration, distance_km, avg_speed_kmh,
    pickup_hour, pickup_weekday, pickup_month, is_peak,
    CAST(distance_km BETWEEN 18 AND 23 AS INT) AS airport_trip,
    distance_km * is_peak AS distance_peak
  FROM kept)"""


def trips(select: str) -> str:
    return f"WITH {TRIPS}\n{select}"


def clean(select: str, more: str = "") -> str:
    return f"WITH RECURSIVE {CLEAN}{more}\n{select}"


# ---------------------------------------------------------------- tables

POSITIONS = rcols("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
TRIP_SELECT = (
    f"id, vendor_id, pickup_datetime, dropoff_datetime, {whole('passenger_count')}, {POSITIONS}, "
    "store_and_fwd_flag, trip_duration"
)
CLEAN_SELECT = (
    f"{TRIP_SELECT}, {whole('store_and_fwd_flag_num')}, {rcols('log_duration', 'distance_km', 'avg_speed_kmh')}, "
    f"pickup_hour, pickup_weekday, pickup_month, is_peak, airport_trip, {r('distance_peak', 'distance_peak')}"
)

SCHEMA_LISTING = trips(
    " UNION ALL ".join(
        f"""SELECT CAST({i + 1} AS INT) AS position, '{f.name}' AS "column", '{f.dataType.simpleString()}' AS type, """
        'TRUE AS nullable, '
        f'count({f.name}) AS "values" FROM trips'
        for i, f in enumerate(S.TRIP_SCHEMA.fields)
    )
)

FLOATS = {"pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"}


def _missing(name: str) -> str:
    return f"{name} IS NULL OR isnan({name})" if name in FLOATS else f"{name} IS NULL"


MISSING = trips(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({_missing(c)}) AS missing, count(*) AS rows, """
        f"{r(f'count(*) FILTER ({_missing(c)}) / CAST(count(*) AS DOUBLE)', 'fraction')} FROM trips"
        for c in S.TRIP_COLUMNS
    )
)


def _describe(c: str) -> str:
    # A NaN makes mean and spread NaN; DuckDB's stddev would raise on it.
    if c in FLOATS:
        spread = f"CASE WHEN count(*) FILTER (isnan({c})) > 0 THEN CAST('NaN' AS DOUBLE) ELSE stddev_samp({c}) FILTER (NOT isnan({c})) END"
    else:
        spread = f"stddev_samp({c})"
    return (
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(spread, 'stddev')}, """
        f"{r(f'min({c})', 'min')}, {r(f'max({c})', 'max')} FROM trips"
    )


DESCRIBE = trips(" UNION ALL ".join(_describe(c) for c in ["vendor_id", *S.NUMERIC_COLUMNS]))
DESCRIBE_STRINGS = trips(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, min({c}) AS min, max({c}) AS max FROM trips"""
        for c in ("id", "store_and_fwd_flag")
    )
)


def _value_summary(column: str, source: str, places: bool) -> str:
    def v(e: str, name: str) -> str:
        return r(e, name) if places else f"{e} AS {name}"

    return clean(
        f"SELECT count({column}) AS count, {v(f'min({column})', 'min')}, "
        f"{v(f'quantile_disc({column}, 0.25)', 'p25')}, {v(f'quantile_disc({column}, 0.5)', 'p50')}, "
        f"{v(f'quantile_disc({column}, 0.75)', 'p75')}, {v(f'max({column})', 'max')}, "
        f"{r(f'avg({column})', 'mean')}, {r(f'stddev_samp({column})', 'stddev')} FROM {source}"
    )


def _frequency(column: str, source: str) -> str:
    key = whole(column) if column in S.NULLABLE_COUNTS else column
    return clean(f"SELECT {key}, count(*) AS count FROM {source} GROUP BY {column}")


FREQUENCY_TABLES = clean(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS STRING) AS value, count(*) AS count FROM clean GROUP BY {c}"""
        for c in S.CATEGORY_COLUMNS
    )
)


def _share(column: str, source: str) -> str:
    return (
        f"SELECT {column}, count(*) AS count, {r('count(*) * 100e0 / sum(count(*)) OVER ()', 'percent')} "
        f"FROM {source} GROUP BY {column}"
    )


FUNNEL = f"""WITH {TRIPS},
d AS ({distance_of("trips")}),
s AS (SELECT *, distance_km / (trip_duration / 3600e0) AS avg_speed_kmh FROM d),
n AS (SELECT count(*) AS n0,
  count(*) FILTER ({PASSENGERS_OK}) AS n1,
  count(*) FILTER ({PASSENGERS_OK} AND {POSITION_OK}) AS n2,
  count(*) FILTER ({PASSENGERS_OK} AND {POSITION_OK} AND {DURATION_OK}) AS n3,
  count(*) FILTER ({PASSENGERS_OK} AND {POSITION_OK} AND {DURATION_OK} AND {SPEED_OK}) AS n4 FROM s)
SELECT CAST(0 AS INT) AS position, 'raw' AS step, n0 AS rows, CAST(0 AS BIGINT) AS dropped FROM n
UNION ALL SELECT 1, 'passenger_count', n1, n0 - n1 FROM n
UNION ALL SELECT 2, 'bounding_box', n2, n1 - n2 FROM n
UNION ALL SELECT 3, 'trip_duration', n3, n2 - n3 FROM n
UNION ALL SELECT 4, 'speed', n4, n3 - n4 FROM n"""

TIME_PARTS = trips(
    """SELECT id, CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_weekday,
  CAST(month(pickup_datetime) AS INT) AS pickup_month,
  CAST(isodow(pickup_datetime) AS INT) AS iso_weekday,
  CAST(isodow(pickup_datetime) IN (6, 7) AS INT) AS is_weekend,
  CAST(hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19) AS INT) AS is_peak,
  CAST(hour(pickup_datetime) IN (7, 8, 9, 17, 18, 19) AS INT) AS is_peak_factor FROM trips"""
)

# ---------------------------------------------------------------- statistics


def _hour_profile(value: str, source: str, places: int | None, moment_places: int = 6) -> str:
    def v(e: str, name: str) -> str:
        return f"{e} AS {name}" if places is None else r(e, name, places)

    q1, q3 = f"quantile_disc({value}, 0.25)", f"quantile_disc({value}, 0.75)"
    return (
        f"SELECT pickup_hour, count(*) AS count, {v(f'min({value})', 'min')}, {v(q1, 'q1')}, "
        f"{v(f'quantile_disc({value}, 0.5)', 'median')}, {v(q3, 'q3')}, {v(f'max({value})', 'max')}, "
        f"{r(f'avg({value})', 'mean', moment_places)}, {r(f'stddev_samp({value})', 'stddev', moment_places)}, "
        f"{v(f'{q3} - {q1}', 'iqr')} FROM {source} GROUP BY pickup_hour"
    )


HOUR_QUARTILES = clean(
    "SELECT pickup_hour, quantile_disc(trip_duration, 0.25) AS q1, quantile_disc(trip_duration, 0.5) AS median, "
    "quantile_disc(trip_duration, 0.75) AS q3 FROM clean GROUP BY pickup_hour"
)

CORR_MATRIX = clean(
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "column", """
        + ", ".join(r("1" if a == b else f"corr({a}, {b})", b) for b in S.CORRELATION_COLUMNS)
        + " FROM clean"
        for a in S.CORRELATION_COLUMNS
    )
)
CORR_STRONG = clean(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})', 'r')} FROM clean"
        for a, b in combinations(S.CORRELATION_COLUMNS, 2)
    )
    + ") WHERE abs(r) > 3e-1"
)
BINNED = clean(
    f"SELECT floor(distance_km) AS bin, {r('avg(log_duration)', 'mean')}, count(*) AS count "
    "FROM clean WHERE distance_km <= 30 GROUP BY 1"
)


def _histogram(column: str, source: str, bounds: str) -> str:
    """``bounds`` gives one row (lo, hi)."""
    return clean(
        f"SELECT CAST(i AS INT) AS bin, {r('lo + i * width', 'lower')}, {r('lo + (i + 1) * width', 'upper')}, "
        "coalesce(n, 0) AS count FROM range(100) b(i) CROSS JOIN w LEFT JOIN h ON h.bin = i",
        f""",
bounds AS ({bounds}),
w AS (SELECT lo, hi, (hi - lo) / 100e0 AS width FROM bounds),
h AS (SELECT CAST(least(floor(({column} - lo) / width), 99) AS INT) AS bin, count(*) AS n
  FROM {source} CROSS JOIN w WHERE {column} BETWEEN lo AND hi GROUP BY 1)""",
    )


def _grid(source: str, x: str, y: str, x_size: str, y_size: str, where: str) -> str:
    return clean(
        f"SELECT CAST(floor({x} / {x_size}) AS BIGINT) AS cell_x, CAST(floor({y} / {y_size}) AS BIGINT) AS cell_y, "
        f"count(*) AS count FROM {source} WHERE {where} AND NOT isnan({x}) AND NOT isnan({y}) GROUP BY 1, 2"
    )


SEATED = f"(SELECT * FROM trips WHERE {PASSENGERS_OK})"
DENSITY_POSITIONS = trips(
    "SELECT kind, CAST(floor(lon / 1e-2) AS BIGINT) AS cell_x, CAST(floor(lat / 1e-2) AS BIGINT) AS cell_y, "
    "count(*) AS count FROM ("
    f"SELECT 'pickup' AS kind, pickup_longitude AS lon, pickup_latitude AS lat FROM {SEATED} UNION ALL "
    f"SELECT 'dropoff', dropoff_longitude, dropoff_latitude FROM {SEATED}) "
    "WHERE NOT isnan(lon) AND NOT isnan(lat) GROUP BY 1, 2, 3"
)

# ---------------------------------------------------------------- requests and scores

CHECKS = {
    "pickup_latitude": f"pickup_latitude {BOX_LAT}",
    "pickup_longitude": f"pickup_longitude {BOX_LON}",
    "dropoff_latitude": f"dropoff_latitude {BOX_LAT}",
    "dropoff_longitude": f"dropoff_longitude {BOX_LON}",
    "pickup_date": "CAST(pickup_datetime AS DATE) BETWEEN DATE '2016-01-01' AND DATE '2030-12-31'",
    "passenger_count": "passenger_count BETWEEN 1 AND 6",
    "vendor_id": "vendor_id IN (1, 2)",
    "store_and_fwd_flag": "store_and_fwd_flag IN ('N', 'Y')",
}
REASONS = (
    "concat_ws(',', "
    + ", ".join(f"CASE WHEN coalesce({ok}, FALSE) THEN NULL ELSE '{name}' END" for name, ok in CHECKS.items())
    + ")"
)
VALIDATED = f"""{TRIPS},
validated AS (SELECT *, {REASONS} AS reasons FROM trips),
good AS (SELECT * FROM validated WHERE reasons = ''),
placed_requests AS ({distance_of("good")}),
timed AS (SELECT *, {CALENDAR} FROM placed_requests),
featured AS (
  SELECT *, CAST(distance_km BETWEEN 18 AND 23 AS INT) AS airport_trip, distance_km * is_peak AS distance_peak,
    CAST(store_and_fwd_flag = 'Y' AS INT) AS store_and_fwd_flag_num FROM timed)"""

VALIDATION = f"""WITH {VALIDATED}
SELECT id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_text,
  CAST(reasons = '' AS INT) AS accepted, reasons FROM validated"""
QUARANTINE = f"WITH {VALIDATED} SELECT id, reasons FROM validated WHERE reasons <> ''"
REJECTIONS = (
    f"WITH {VALIDATED} SELECT reason, requests FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS reason, count(*) FILTER (NOT coalesce({ok}, FALSE)) AS requests FROM trips"
        for name, ok in CHECKS.items()
    )
    + ") WHERE requests > 0"
)
SERVING = f"""WITH {TRIPS},
d AS ({distance_of("trips")}),
f AS (SELECT *, {CALENDAR} FROM (SELECT * REPLACE (coalesce(distance_km, 0e0) AS distance_km) FROM d))
SELECT id, pickup_hour, pickup_weekday, pickup_month, is_peak, {r('distance_km', 'distance_km')},
  CAST(distance_km BETWEEN 18 AND 23 AS INT) AS airport_trip, {r('distance_km * is_peak', 'distance_peak')},
  CAST(CAST(store_and_fwd_flag = 'Y' AS INT) AS DOUBLE) AS store_and_fwd_flag_num FROM f"""

ADDITIVE = (
    "300e0 + distance_km * 60e0 + CASE WHEN is_peak = 1 THEN 180e0 ELSE 0e0 END "
    "+ CASE WHEN airport_trip = 1 THEN 600e0 ELSE 0e0 END"
)
FACTORS = (
    "(200e0 + distance_km * 40e0) * CASE WHEN pickup_hour IN (7, 8, 9, 17, 18, 19) THEN 14e-1 ELSE 8e-1 END "
    "* (1e0 + (passenger_count - 1) * 3e-2) * CASE WHEN vendor_id = 2 THEN 102e-2 ELSE 1e0 END "
    "* CASE WHEN store_and_fwd_flag = 'Y' THEN 108e-2 ELSE 1e0 END"
)


def outputs(source: str) -> str:
    """Rows of ``source`` with everything that follows from ``duration_seconds``."""
    return (
        "SELECT *, duration_seconds / 60e0 AS duration_minutes, "
        "CASE WHEN duration_seconds > 0 THEN distance_km / (duration_seconds / 3600e0) ELSE 0e0 END AS avg_speed, "
        "ln(1e0 + duration_seconds) AS log_prediction, "
        "CASE WHEN duration_seconds / 60e0 < 10 THEN 'short' WHEN duration_seconds / 60e0 < 30 THEN 'normal' "
        f"ELSE 'long' END AS band FROM {source}"
    )


def scored_columns(places: int = 6) -> str:
    return (
        f"id, pickup_hour, pickup_weekday, pickup_month, is_peak, {r('distance_km', 'distance_km', places)}, "
        f"airport_trip, {r('distance_peak', 'distance_peak', places)}, {whole('store_and_fwd_flag_num')}, "
        f"{rcols('duration_seconds', 'duration_minutes', 'avg_speed', 'log_prediction', places=places)}, band"
    )


SCORED = scored_columns()


def _scored(seconds: str, select: str = SCORED) -> str:
    return f"""WITH {VALIDATED},
t AS (SELECT *, {seconds} AS duration_seconds FROM featured),
scored AS ({outputs("t")})
SELECT {select} FROM scored"""


def hash_bits(key: str, block: int) -> str:
    return f"CAST('0x' || substr(md5({key}), {1 + 8 * block}, 8) AS BIGINT)"


NOISE = f"(1e0 + ({hash_bits('id', 2)} / 4294967296e0 * 2e0 - 1e0) * 5e-2)"
NOISY = _scored(f"({FACTORS}) * {NOISE}", f"id, {rcols('duration_seconds', 'duration_minutes')}")


def _fixed(column: str, places: int) -> str:
    return f"format('{{:.{places}f}}', round({column}, {places}))"


REPORT_CELLS = [
    ("Processing Mode", "'Demo Mode'"),
    ("Input Features", f"'{len(S.REQUEST_COLUMNS)} columns'"),
    ("Generated Features", f"'{len(S.SERVING_COLUMNS)} columns'"),
    ("Log Prediction", _fixed("log_prediction", 4)),
    ("Duration (seconds)", _fixed("duration_seconds", 0)),
    ("Duration (minutes)", _fixed("duration_minutes", 1)),
    ("Distance (km)", _fixed("distance_km", 2)),
    ("Average Speed (km/h)", _fixed("avg_speed", 1)),
    ("Peak Hour Factor", "CASE WHEN is_peak = 1 THEN 'Yes' ELSE 'No' END"),
    ("Airport Trip Factor", "CASE WHEN airport_trip = 1 THEN 'Yes' ELSE 'No' END"),
]
REPORT = f"""WITH {VALIDATED},
t AS (SELECT *, {ADDITIVE} AS duration_seconds FROM featured),
scored AS ({outputs("t")})
""" + " UNION ALL ".join(
    f"SELECT id, '{metric}' AS metric, {value} AS value FROM scored" for metric, value in REPORT_CELLS
)

# ---------------------------------------------------------------- split, vectors, models

MODEL_FRAME = f""",
frame AS (
  SELECT * REPLACE (coalesce(store_and_fwd_flag_num, 0) AS store_and_fwd_flag_num),
    {hash_bits('id', 0)} % 100 < 70 AS in_training FROM clean),
vendors AS (
  SELECT vendor_id, row_number() OVER (ORDER BY count(*) DESC, CAST(vendor_id AS STRING)) - 1 AS vendor_idx
  FROM frame WHERE in_training GROUP BY vendor_id),
indexed AS (
  SELECT frame.*, CAST(coalesce(vendor_idx, (SELECT count(*) FROM vendors)) AS DOUBLE) AS vendor_idx
  FROM frame LEFT JOIN vendors USING (vendor_id)),
train AS (SELECT * FROM indexed WHERE in_training),
test AS (SELECT * FROM indexed WHERE NOT in_training)"""

SPLIT = clean(
    f"SELECT id, CAST({hash_bits('id', 0)} % 100 < 70 AS INT) AS in_training, "
    f"CAST({hash_bits('id', 1)} % 3 AS INT) AS fold FROM clean"
)
VENDOR_INDEX = clean(
    "SELECT vendor_id, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(vendor_id AS STRING)) - 1 AS INT) "
    "AS vendor_idx, count(*) AS trips FROM clean GROUP BY vendor_id"
)


def _scaled(column: str) -> str:
    return f"(({column} - (SELECT avg({column}) FROM train)) / (SELECT stddev_samp({column}) FROM train))"


SCALED = clean("SELECT id, " + ", ".join(r(_scaled(c), c) for c in S.BASE_9) + " FROM test", MODEL_FRAME)
POLY = clean(
    "SELECT id, "
    + ", ".join(
        r(e, name)
        for e, name in [
            ("x", "x"),
            ("x * x", "xx"),
            ("y", "y"),
            ("x * y", "xy"),
            ("y * y", "yy"),
            ("z", "z"),
            ("x * z", "xz"),
            ("y * z", "yz"),
            ("z * z", "zz"),
        ]
    )
    + f" FROM (SELECT id, {_scaled('distance_km')} AS x, {_scaled('pickup_hour')} AS y, "
    f"{_scaled('passenger_count')} AS z FROM test)",
    MODEL_FRAME,
)


def metric_columns(label: str = "y", prediction: str = "p", places: int = 6) -> str:
    y_sec, p_sec = f"(exp({label}) - 1e0)", f"(exp({prediction}) - 1e0)"
    return (
        f"count(*) AS rows, {r(f'sqrt(avg(pow({label} - {prediction}, 2)))', 'rmse_log', places)}, "
        f"{r(f'sqrt(avg(pow({y_sec} - {p_sec}, 2)))', 'rmse_sec', places)}, "
        f"{r(f'sqrt(avg(pow(ln(1e0 + {p_sec}) - ln(1e0 + {y_sec}), 2)))', 'rmsle', places)}, "
        f"{r(f'avg(abs({y_sec} - {p_sec}))', 'mae_sec', places)}, "
        f"{r(f'1e0 - sum(pow({label} - {prediction}, 2)) / (var_pop({label}) * count(*))', 'r2', places)}"
    )


def _one_feature(slope: str) -> str:
    return clean(
        f"SELECT 'distance' AS model, {r('any_value(slope)', 'slope')}, {r('any_value(intercept)', 'intercept')}, "
        f"{metric_columns()} FROM (SELECT log_duration AS y, intercept + slope * distance_km AS p, slope, intercept "
        "FROM test CROSS JOIN line)",
        f"""{MODEL_FRAME},
slopes AS (SELECT {slope} AS slope, avg(log_duration) AS my, avg(distance_km) AS mx FROM train),
line AS (SELECT slope, my - slope * mx AS intercept FROM slopes)""",
    )


OLS = _one_feature("covar_pop(log_duration, distance_km) / var_pop(distance_km)")
RIDGE = _one_feature(
    "covar_pop(log_duration, distance_km) / (var_pop(distance_km) * (1e0 + 1e-1 / stddev_pop(log_duration)))"
)


def ridge(name: str, features: tuple[str, ...], penalty: str = "1e-1") -> str:
    """Ridge regression in closed form, as CTEs ending in ``<name>_weights``.

    The normal equations (G + penalty / sd(y) · diag(var)) w = cov(x, y) are
    built from covariances and solved by elimination, one pivot per step.
    """
    k = len(features)

    def g(a: str, b: str) -> str:
        base = f"covar_pop({a}, {b})"
        return f"{base} + {penalty} / stddev_pop(log_duration) * var_pop({a})" if a == b else base

    matrix = ", ".join(
        "[" + ", ".join([*(g(a, b) for b in features), f"covar_pop({a}, log_duration)"]) + "]" for a in features
    )
    means = ", ".join(f"avg({f})" for f in features)
    return f""",
{name}_solve AS (
  SELECT 1 AS step, [{matrix}] AS m, [{means}] AS mx, avg(log_duration) AS my FROM train
  UNION ALL
  SELECT step + 1, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 2}), lambda j:
      CASE WHEN i = step THEN m[step][j] / m[step][step]
           ELSE m[i][j] - m[i][step] * m[step][j] / m[step][step] END)), mx, my
  FROM {name}_solve WHERE step <= {k}),
{name}_weights AS (
  SELECT list_transform(range(1, {k + 1}), lambda i: m[i][{k + 1}]) AS w, mx, my
  FROM {name}_solve WHERE step = {k + 1})"""


def prediction(name: str, features: tuple[str, ...]) -> str:
    """Log prediction of a row next to the one row of ``<name>_weights``."""
    w = f"{name}_weights"
    return f"{w}.my + " + " + ".join(f"{w}.w[{i + 1}] * ({f} - {w}.mx[{i + 1}])" for i, f in enumerate(features))


PLAIN = [
    ("Baseline-7", "baseline_7", S.BASE_7),
    ("Baseline", "baseline", S.BASE_9),
    ("+Interaction", "_interaction", S.INTERACTION_10),
]


def _model(title: str, name: str, features: tuple[str, ...]) -> str:
    return clean(
        f"SELECT '{title}' AS model, {metric_columns()} FROM (SELECT log_duration AS y, "
        f"{prediction(name, features)} AS p FROM test CROSS JOIN {name}_weights)",
        MODEL_FRAME + ridge(name, features),
    )


ALL_RIDGES = MODEL_FRAME + "".join(ridge(name, features) for _, name, features in PLAIN)
COMPARISON_BODY = " UNION ALL ".join(
    f"SELECT '{title}' AS model, {metric_columns()} FROM (SELECT log_duration AS y, "
    f"{prediction(name, features)} AS p FROM test CROSS JOIN {name}_weights)"
    for title, name, features in PLAIN
)
PREDICTIONS = clean(
    "SELECT id, "
    + ", ".join(r(f"exp({prediction(name, f)}) - 1e0", f"{name}_seconds", FITTED_PLACES) for _, name, f in PLAIN)
    + " FROM test "
    + " ".join(f"CROSS JOIN {name}_weights" for _, name, _ in PLAIN),
    ALL_RIDGES,
)

BASELINE = MODEL_FRAME + ridge("baseline", S.BASE_9)
TESTED = f"""{BASELINE},
tested AS (SELECT *, {prediction('baseline', S.BASE_9)} AS p FROM test CROSS JOIN baseline_weights)"""
MODEL_SCORED = f"""{TESTED},{VALIDATED[len(TRIPS) + 1:]},
filled AS (
  SELECT featured.*, coalesce(CAST(vendor_idx AS DOUBLE), (SELECT count(*) FROM vendors)) AS vendor_idx
  FROM featured LEFT JOIN vendors USING (vendor_id)),
t AS (SELECT * EXCLUDE (w, mx, my), exp({prediction('baseline', S.BASE_9)}) - 1e0 AS duration_seconds
  FROM filled CROSS JOIN baseline_weights),
scored AS ({outputs("t")})"""

REPORT_MODEL = clean(
    " UNION ALL ".join(
        f"SELECT id, '{metric}' AS metric, {value.replace('Demo Mode', 'Live Model')} AS value FROM scored"
        for metric, value in REPORT_CELLS
    ),
    MODEL_SCORED,
)
HOUR_INDEX = clean(
    "SELECT pickup_hour, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(pickup_hour AS STRING)) - 1 AS INT) "
    "AS hour_idx, count(*) AS trips FROM clean GROUP BY pickup_hour"
)

# Sweeps of coordinate descent; the last ones change nothing that is shown.
SWEEPS = 100


def elastic_net(points: str, features: tuple[str, ...] = S.BASE_9) -> str:
    """Elastic-net fits by coordinate descent on correlations, as CTEs ending in ``net_weights``.

    ``points`` are rows (penalty, alpha). There is a fit for every point on all training rows (fold -1) and
    on those outside each fold. Penalties are in units of the label's spread.
    """
    k = len(features)
    matrix = ", ".join("[" + ", ".join("1e0" if a == b else f"corr({a}, {b})" for b in features) + "]" for a in features)
    parts = ", ".join(
        f"[{', '.join(e.format(f) for f in features)}] AS {name}"
        for e, name in (("corr({}, log_duration)", "c"), ("stddev_pop({})", "sx"), ("avg({})", "mx"))
    )
    return f""",
net_train AS (SELECT *, {hash_bits('id', 1)} % 3 AS fold FROM train),
net_moments AS (
  SELECT f, [{matrix}] AS g, {parts}, stddev_pop(log_duration) AS sy, avg(log_duration) AS my
  FROM net_train JOIN (SELECT unnest([-1, 0, 1, 2]) AS f) ON fold <> f GROUP BY f),
net_steps AS (
  SELECT f, penalty, alpha, 0 AS step, list_transform(range(1, {k + 1}), lambda i: 0e0) AS w
  FROM net_moments CROSS JOIN ({points}) AS p(penalty, alpha)
  UNION ALL
  SELECT f, penalty, alpha, step + 1, list_transform(range(1, {k + 1}), lambda i: CASE WHEN i = turn
      THEN sign(z) * greatest(abs(z) - penalty * alpha / sy, 0) / (1 + penalty * (1 - alpha) / sy) ELSE w[i] END)
  FROM (SELECT s.*, sy, step % {k} + 1 AS turn,
      c[step % {k} + 1] - list_dot_product(g[step % {k} + 1], w) + w[step % {k} + 1] AS z
    FROM net_steps s JOIN net_moments USING (f) WHERE step < {SWEEPS * k})),
net_weights AS (
  SELECT f, penalty, alpha, my, mx, list_transform(range(1, {k + 1}), lambda i: w[i] * sy / sx[i]) AS b
  FROM net_steps JOIN net_moments USING (f) WHERE step = {SWEEPS * k})"""


ELASTIC_NET = clean(
    f"SELECT unnest([{', '.join(repr(f) for f in S.BASE_9)}, '(intercept)']) AS feature, "
    f"unnest(list_transform(list_append(b, my - list_dot_product(b, mx)), lambda v: {r('v', None, FITTED_PLACES)})) "
    "AS coefficient FROM net_weights WHERE f = -1",
    MODEL_FRAME + elastic_net("VALUES (5e-2, 3e-1)"),
)
GRID = ", ".join(f"({p}e-2, {a}e-1)" for p in (1, 5, 10) for a in (0, 3, 7))
GRID_ERRORS = MODEL_FRAME + elastic_net(f"VALUES {GRID}") + f""",
net_errors AS (
  SELECT penalty, alpha, f, sqrt(avg(power(log_duration - my - list_dot_product(b, list_transform(range(1, {len(S.BASE_9) + 1}),
      lambda i: x[i] - mx[i])), 2))) AS rmse
  FROM (SELECT fold, log_duration, [{', '.join(f'CAST({f} AS DOUBLE)' for f in S.BASE_9)}] AS x FROM net_train)
  JOIN net_weights ON fold = f GROUP BY penalty, alpha, f),
net_scores AS (SELECT penalty, alpha, avg(rmse) AS mean_rmse FROM net_errors GROUP BY penalty, alpha)"""
GRID_SCORES = clean(
    f"SELECT penalty AS reg_param, alpha AS elastic_net, {r('mean_rmse', 'mean_rmse', FITTED_PLACES)} FROM net_scores",
    GRID_ERRORS,
)
BEST_POINT = clean(
    "SELECT penalty AS reg_param, alpha AS elastic_net FROM net_scores ORDER BY mean_rmse LIMIT 1", GRID_ERRORS
)

# Whole micro-degrees, counted from the date line and the south pole.
MICRO_X, MICRO_Y = (
    f"(CAST(floor({c} * 1000000e0 + 5e-1) AS BIGINT) + {o})" for c, o in (("pickup_longitude", 180000000), ("pickup_latitude", 90000000))
)
SQUARES = "list_transform(range(1, len(cx) + 1), lambda j: (x - cx[j]) * (x - cx[j]) + (y - cy[j]) * (y - cy[j]))"
NEAREST = "list_position(d, list_min(d))"
# Seeds from the fullest cells, then ten rounds of means in whole numbers.
CENTRES = MODEL_FRAME + f""",
points AS (SELECT {MICRO_X} AS x, {MICRO_Y} AS y FROM train),
cells AS (
  SELECT x // 10000 AS cx, y // 10000 AS cy, count(*) AS n FROM points GROUP BY ALL ORDER BY n DESC, cx, cy LIMIT 10),
lloyd AS (
  SELECT 0 AS step, list(cx * 10000 + 5000 ORDER BY n DESC, cx, cy) AS cx, list(cy * 10000 + 5000 ORDER BY n DESC, cx, cy) AS cy
  FROM cells
  UNION ALL
  SELECT step + 1, list_transform(range(1, len(cx) + 1), lambda i: coalesce(m[i][1], cx[i])),
    list_transform(range(1, len(cy) + 1), lambda i: coalesce(m[i][2], cy[i]))
  FROM (
    SELECT step, cx, cy, map_from_entries(list(ROW(i, [CAST(sx // n AS BIGINT), CAST(sy // n AS BIGINT)]))) AS m
    FROM (
      SELECT step, cx, cy, {NEAREST} AS i, sum(x) AS sx, sum(y) AS sy, count(*) AS n
      FROM (SELECT step, cx, cy, x, y, {SQUARES} AS d FROM lloyd CROSS JOIN points WHERE step < 10)
      GROUP BY ALL)
    GROUP BY ALL)),
centres AS (SELECT cx, cy FROM lloyd WHERE step = 10)"""


def _clustered(rows: str) -> str:
    return (
        f"SELECT * EXCLUDE (cx, cy, d, x, y), {NEAREST} - 1 AS pickup_cluster FROM (SELECT *, {SQUARES} AS d "
        f"FROM (SELECT *, {MICRO_X} AS x, {MICRO_Y} AS y FROM {rows}) CROSS JOIN centres)"
    )


PICKUP_CLUSTERS = clean(
    "SELECT CAST(pickup_cluster AS INT) AS pickup_cluster, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(pickup_cluster AS STRING)) - 1 AS INT) "
    f"AS cluster_idx, count(*) AS trips, {r('avg(pickup_longitude)', 'mean_longitude')}, {r('avg(pickup_latitude)', 'mean_latitude')} "
    f"FROM ({_clustered('train')}) GROUP BY pickup_cluster",
    CENTRES,
)

CLUSTER_TERMS = [
    f"z[{j}]" if i is None else f"z[{i}] * z[{j}]"
    for j in range(1, len(S.CLUSTER_10) + 1)
    for i in (None, *range(1, j + 1))
]
CLUSTER_SWEEPS = 40


def _optimized(points: list[tuple[str, str]]) -> str:
    """Scores of the grid for degree-2 terms with clusters, as CTEs ending in ``opt_errors``.

    Set -1 is all training rows, held against the test rows; set f is the training rows outside fold f, held against that
    fold. Indexes and scales are those of the set's own rows. Ridge points are solved by elimination, the others by
    coordinate descent, both on correlations.
    """
    n, k = len(S.CLUSTER_10), len(CLUSTER_TERMS)
    plain = ", ".join(f"CAST({f} AS DOUBLE)" for f in S.BASE_9 if f != "vendor_idx")
    order = ["vendor" if f == "vendor_idx" else "cluster" if f == "cluster_idx" else f for f in S.CLUSTER_10]
    assert order[-2:] == ["vendor", "cluster"]
    corr = ", ".join(f"coalesce(nullif(corr(v[{a}], v[{b}]), 'NaN'), 0e0) AS g_{a}_{b}" for a in range(1, k + 1) for b in range(a + 1, k + 1))
    matrix = ", ".join(
        "[" + ", ".join("1e0" if a == b else f"g_{min(a, b)}_{max(a, b)}" for b in range(1, k + 1)) + "]" for a in range(1, k + 1)
    )
    parts = ", ".join(
        f"[{', '.join(e.format(f'v[{i}]') for i in range(1, k + 1))}] AS {name}"
        for e, name in (("coalesce(nullif(corr({}, y), 'NaN'), 0e0)", "c"), ("stddev_pop({})", "sx"), ("avg({})", "mx"))
    )
    ridges = ", ".join(f"({p})" for p, a in points if float(a) == 0)
    nets = ", ".join(f"({p}, {a})" for p, a in points if float(a))
    turn = f"step % {k} + 1"
    return f""",
folded AS (SELECT *, {hash_bits('id', 1)} % 3 AS fold FROM ({_clustered('train')})),
sets AS (
  SELECT part, fold = part AS held, * EXCLUDE (fold, part) FROM folded CROSS JOIN (SELECT unnest([-1, 0, 1, 2]) AS part)
  UNION ALL SELECT -1, TRUE, * FROM ({_clustered('test')})),
opt_vendors AS (
  SELECT part, vendor_id, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, CAST(vendor_id AS STRING)) - 1 AS i
  FROM sets WHERE NOT held GROUP BY part, vendor_id),
opt_clusters AS (
  SELECT part, pickup_cluster, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, CAST(pickup_cluster AS STRING)) - 1 AS i
  FROM sets WHERE NOT held GROUP BY part, pickup_cluster),
opt_rows AS MATERIALIZED (
  SELECT part, held, log_duration AS y, [{plain},
    CAST(coalesce(opt_vendors.i, (SELECT count(*) FROM opt_vendors w WHERE w.part = sets.part)) AS DOUBLE),
    CAST(coalesce(opt_clusters.i, (SELECT count(*) FROM opt_clusters w WHERE w.part = sets.part)) AS DOUBLE)] AS x
  FROM sets LEFT JOIN opt_vendors USING (part, vendor_id) LEFT JOIN opt_clusters USING (part, pickup_cluster)),
opt_scales AS (
  SELECT part, [{', '.join(f'avg(x[{i}])' for i in range(1, n + 1))}] AS mu, [{', '.join(f'stddev_samp(x[{i}])' for i in range(1, n + 1))}] AS sd
  FROM opt_rows WHERE NOT held GROUP BY part),
opt_terms AS MATERIALIZED (
  SELECT part, held, y, [{', '.join(CLUSTER_TERMS)}] AS v
  FROM (
    SELECT part, held, y, list_transform(range(1, {n + 1}), lambda i: CASE WHEN sd[i] > 0 THEN (x[i] - mu[i]) / sd[i] ELSE 0e0 END) AS z
    FROM opt_rows JOIN opt_scales USING (part))),
opt_corr AS (
  SELECT part, {corr}, {parts}, stddev_pop(y) AS sy, avg(y) AS my FROM opt_terms WHERE NOT held GROUP BY part),
opt_moments AS MATERIALIZED (SELECT part, [{matrix}] AS g, c, sx, mx, sy, my FROM opt_corr),
opt_solve AS (
  SELECT part, penalty, 1 AS step, list_transform(range(1, {k + 1}), lambda i: list_append(
      list_transform(range(1, {k + 1}), lambda j: g[i][j] + CASE WHEN i = j THEN penalty / sy ELSE 0e0 END), c[i])) AS m
  FROM opt_moments CROSS JOIN (VALUES {ridges}) AS p(penalty)
  UNION ALL
  SELECT part, penalty, step + 1, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 2}), lambda j:
      CASE WHEN i = step THEN m[step][j] / m[step][step] ELSE m[i][j] - m[i][step] * m[step][j] / m[step][step] END))
  FROM opt_solve WHERE step <= {k}),
opt_steps AS (
  SELECT part, penalty, alpha, 0 AS step, list_transform(range(1, {k + 1}), lambda i: 0e0) AS w
  FROM opt_moments CROSS JOIN (VALUES {nets}) AS p(penalty, alpha)
  UNION ALL
  SELECT part, penalty, alpha, step + 1, list_transform(range(1, {k + 1}), lambda i: CASE WHEN i = turn
      THEN sign(z) * greatest(abs(z) - penalty * alpha / sy, 0) / (1 + penalty * (1 - alpha) / sy) ELSE w[i] END)
  FROM (SELECT s.*, sy, {turn} AS turn, c[{turn}] - list_dot_product(g[{turn}], w) + w[{turn}] AS z
    FROM opt_steps s JOIN opt_moments USING (part) WHERE step < {CLUSTER_SWEEPS * k})),
opt_weights AS (
  SELECT part, penalty, alpha, my, mx,
    list_transform(range(1, {k + 1}), lambda i: CASE WHEN sx[i] > 0 THEN w[i] * sy / sx[i] ELSE 0e0 END) AS b
  FROM (
    SELECT part, penalty, 0e0 AS alpha, list_transform(range(1, {k + 1}), lambda i: m[i][{k + 1}]) AS w FROM opt_solve WHERE step = {k + 1}
    UNION ALL SELECT part, penalty, alpha, w FROM opt_steps WHERE step = {CLUSTER_SWEEPS * k})
  JOIN opt_moments USING (part)),
opt_tested AS (
  SELECT part, penalty, alpha, y, my + list_dot_product(b, v) - list_dot_product(b, mx) AS p
  FROM opt_terms JOIN opt_weights USING (part) WHERE held),
opt_scores AS (
  SELECT penalty, alpha, avg(rmse) AS mean_rmse
  FROM (SELECT penalty, alpha, part, sqrt(avg(power(y - p, 2))) AS rmse FROM opt_tested WHERE part >= 0 GROUP BY ALL) GROUP BY ALL),
opt_best AS (SELECT penalty, alpha FROM opt_scores ORDER BY mean_rmse, penalty, alpha LIMIT 1),
opt_chosen AS (SELECT t.* FROM opt_tested t JOIN opt_best USING (penalty, alpha) WHERE part = -1)"""


OPTIMIZED = CENTRES + _optimized([(f"{p}e-2", f"{a}e-1") for p in (1, 5, 10) for a in (0, 3, 7)])
CLUSTER_GRID = clean(
    f"SELECT penalty AS reg_param, alpha AS elastic_net, {r('mean_rmse', 'mean_rmse', FITTED_PLACES)} FROM opt_scores", OPTIMIZED
)
CHOSEN_BODY = f"SELECT 'Optimized' AS model, {metric_columns(places=FITTED_PLACES)} FROM opt_chosen"
OPTIMIZED_ROW = clean(f"SELECT * FROM ({CHOSEN_BODY}) CROSS JOIN (SELECT penalty AS reg_param, alpha AS elastic_net FROM opt_best)", OPTIMIZED)
COMPARED_BODY = " UNION ALL ".join(
    f"SELECT '{title}' AS model, {metric_columns(places=FITTED_PLACES)} FROM (SELECT log_duration AS y, "
    f"{prediction(name, features)} AS p FROM test CROSS JOIN {name}_weights)"
    for title, name, features in PLAIN[1:]
) + f" UNION ALL {CHOSEN_BODY}"
COMPARED = OPTIMIZED + "".join(ridge(name, features) for _, name, features in PLAIN[1:])

LOST = "CASE WHEN CAST(substr(id, 3) AS BIGINT) % 50 <> 1 THEN id ELSE '' END"
NULL_IDS = clean(
    f"SELECT CAST({hash_bits(LOST, 0)} % 100 < 70 AS INT) AS in_training, CAST({hash_bits(LOST, 1)} % 3 AS INT) AS fold, "
    "count(*) AS rows FROM clean GROUP BY 1, 2"
)
BROKEN = "CAST(substr(id, 3) AS BIGINT) % 61 = 0 OR CAST(substr(id, 3) AS BIGINT) % 67 = 0"

CSV_FUNNEL = f"""WITH {TRIPS},
d AS ({distance_of("(SELECT *, NOT (" + BROKEN + ") AS parsed FROM trips)")}),
s AS (SELECT *, distance_km / (trip_duration / 3600e0) AS avg_speed_kmh FROM d),
n AS (SELECT count(*) AS n0, count(*) FILTER (parsed) AS n1,
  count(*) FILTER (parsed AND {PASSENGERS_OK}) AS n2,
  count(*) FILTER (parsed AND {PASSENGERS_OK} AND {POSITION_OK}) AS n3,
  count(*) FILTER (parsed AND {PASSENGERS_OK} AND {POSITION_OK} AND {DURATION_OK}) AS n4,
  count(*) FILTER (parsed AND {PASSENGERS_OK} AND {POSITION_OK} AND {DURATION_OK} AND {SPEED_OK}) AS n5 FROM s)
SELECT CAST(0 AS INT) AS position, 'raw' AS step, n0 AS rows, CAST(0 AS BIGINT) AS dropped FROM n
UNION ALL SELECT 1, 'malformed', n1, n0 - n1 FROM n
UNION ALL SELECT 2, 'passenger_count', n2, n1 - n2 FROM n
UNION ALL SELECT 3, 'bounding_box', n3, n2 - n3 FROM n
UNION ALL SELECT 4, 'trip_duration', n4, n3 - n4 FROM n
UNION ALL SELECT 5, 'speed', n5, n4 - n5 FROM n"""
SOON = "CAST(substr(id, 3) AS BIGINT) % 3 = 1 AND CAST(substr(id, 3) AS BIGINT) % 71 = 0"

RULE_TESTED = clean("", f""",
ruled AS (SELECT *, log_duration AS y, ln(1e0 + ({ADDITIVE})) AS p FROM clean)""")

ORACLE_SQL: dict[str, str] = {
    "trips_raw": trips(f"SELECT {TRIP_SELECT} FROM trips"),
    "schema_listing": SCHEMA_LISTING,
    "table_shape": trips("SELECT count(*) AS rows, CAST(11 AS INT) AS columns FROM trips"),
    "preview_first_n": trips(f"SELECT {TRIP_SELECT} FROM trips ORDER BY id LIMIT 20"),
    "missing_profile": MISSING,
    "numeric_describe": DESCRIBE,
    "string_describe": DESCRIBE_STRINGS,
    "duration_summary": _value_summary("trip_duration", "placed", False),
    "log_duration_summary": _value_summary("log_duration", "clean", True),
    "freq_vendor": _frequency("vendor_id", "trips"),
    "freq_flag": _frequency("store_and_fwd_flag", "trips"),
    "freq_flag_num": _frequency("store_and_fwd_flag_num", "clean"),
    "freq_passenger": _frequency("passenger_count", "trips"),
    "freq_hour": _frequency("pickup_hour", "clean"),
    "freq_weekday": _frequency("pickup_weekday", "clean"),
    "freq_month": _frequency("pickup_month", "clean"),
    "freq_peak": _frequency("is_peak", "clean"),
    "frequency_tables": FREQUENCY_TABLES,
    "vendor_share": trips(_share("vendor_id", "trips")),
    "vendor_avg_duration": trips(
        f"SELECT vendor_id, {r('avg(trip_duration)', 'avg_duration')} FROM trips GROUP BY vendor_id"
    ),
    "coordinates": trips(
        f"SELECT id, {r('pickup_longitude', 'lon')}, {r('pickup_latitude', 'lat')}, "
        f"{r('dropoff_longitude', 'lon2')}, {r('dropoff_latitude', 'lat2')} FROM trips WHERE {PASSENGERS_OK}"
    ),
    "cleaning_funnel": FUNNEL,
    "clean_trips": clean(f"SELECT {CLEAN_SELECT} FROM clean"),
    "time_parts": TIME_PARTS,
    "is_weekend_share": clean(
        _share("is_weekend", "(SELECT CAST(isodow(pickup_datetime) IN (6, 7) AS INT) AS is_weekend FROM clean)")
    ),
    "hour_duration_profile": clean(_hour_profile("trip_duration", "clean", None)),
    "hour_duration_profile_sketch": clean(_hour_profile("trip_duration", "clean", None)),
    "hour_quartiles": HOUR_QUARTILES,
    "corr_matrix": CORR_MATRIX,
    "corr_strong_pairs": CORR_STRONG,
    "binned_log_duration": BINNED,
    "hist_duration": _histogram("trip_duration", "placed", "SELECT 0e0 AS lo, 3600e0 AS hi"),
    "hist_log_duration": _histogram(
        "log_duration", "clean", "SELECT min(log_duration) AS lo, max(log_duration) AS hi FROM clean"
    ),
    "density_positions": DENSITY_POSITIONS,
    "density_pickup": _grid(
        SEATED, "pickup_longitude", "pickup_latitude", "1e-2", "1e-2",
        f"pickup_longitude {BOX_LON} AND pickup_latitude {BOX_LAT}",
    ),
    "density_dropoff": _grid(
        SEATED, "dropoff_longitude", "dropoff_latitude", "1e-2", "1e-2",
        f"dropoff_longitude {BOX_LON} AND dropoff_latitude {BOX_LAT}",
    ),
    "density_distance_duration": _grid(
        "clean", "distance_km", "trip_duration", "1e0", "60e0", "trip_duration BETWEEN 0 AND 7200"
    ),
    "clean_sink_roundtrip": clean(f"SELECT {CLEAN_SELECT} FROM clean"),
    "clean_csv_roundtrip": clean(f"SELECT {CLEAN_SELECT} FROM clean"),
    "csv_scan_malformed": trips(
        f"SELECT {TRIP_SELECT}, (SELECT count(*) FROM trips WHERE {BROKEN}) AS rejected FROM trips WHERE NOT ({BROKEN})"
    ),
    "csv_funnel": CSV_FUNNEL,
    "clean_month_rerun": clean(f"SELECT {CLEAN_SELECT} FROM clean"),
    "density_zoom": clean(
        "SELECT CAST(level AS INT) AS level, x >> level AS cell_x, y >> level AS cell_y, count(*) AS count "
        f"FROM (SELECT {MICRO_X} // 1000 AS x, {MICRO_Y} // 1000 AS y FROM clean) CROSS JOIN (SELECT unnest(range(8)) AS level) "
        "GROUP BY ALL"
    ),
    "merged_hour_quartiles": clean(
        "SELECT pickup_hour, count(trip_duration) AS n, TRUE AS q1_within, TRUE AS median_within, TRUE AS q3_within "
        "FROM clean GROUP BY pickup_hour"
    ),
    "stream_serving": f"""WITH {VALIDATED},
t AS (SELECT *, {ADDITIVE} AS duration_seconds FROM featured),
scored AS ({outputs("t")})
SELECT id, '' AS reasons, {r('duration_seconds', 'duration_seconds')} FROM scored
UNION ALL SELECT id, reasons, NULL FROM validated WHERE reasons <> ''""",
    "csv_mixed_headers": trips(
        f"SELECT {TRIP_SELECT}, (SELECT count(*) FROM trips WHERE {SOON}) AS rejected FROM trips WHERE NOT ({SOON})"
    ),
    "nullable_group_profile": trips(
        _hour_profile(
            "seats",
            "(SELECT CAST(hour(pickup_datetime) AS INT) AS pickup_hour, passenger_count AS seats FROM trips)",
            None,
        )
    ),
    "split_with_null_ids": NULL_IDS,
    "hour_index": HOUR_INDEX,
    "elastic_net_base9": ELASTIC_NET,
    "grid_scores_base9": GRID_SCORES,
    "best_grid_point": BEST_POINT,
    "score_report_model": REPORT_MODEL,
    "csv_scan": trips(f"SELECT {TRIP_SELECT} FROM trips"),
    "csv_scan_inferred": trips(f"SELECT {TRIP_SELECT} FROM trips"),
    "request_validation": VALIDATION,
    "rejection_reasons": REJECTIONS,
    "quarantine": QUARANTINE,
    "serving_features": SERVING,
    "score_rules_factors": _scored(FACTORS),
    "score_rules_additive": _scored(ADDITIVE),
    "noisy_score": NOISY,
    "score_report_long": REPORT,
    "score_fallback": _scored(ADDITIVE, f"{SCORED}, 'rules' AS scorer"),
    "stream_score_rules": _scored(ADDITIVE),
    "stream_quarantine": QUARANTINE,
    "train_test_split": SPLIT,
    "vendor_index": VENDOR_INDEX,
    "scaled_features": SCALED,
    "poly_features": POLY,
    "ols_distance": OLS,
    "ridge_distance": RIDGE,
    "rule_metrics": f"{RULE_TESTED} SELECT 'additive' AS model, {metric_columns()} FROM ruled",
    "residuals_by_hour": RULE_TESTED
    + ", left_over AS (SELECT pickup_hour, (exp(y) - 1e0) - (exp(p) - 1e0) AS residual_sec FROM ruled) "
    + _hour_profile("residual_sec", "left_over", 6),
    "model_base7": _model(*PLAIN[0]),
    "model_base9": _model(*PLAIN[1]),
    "model_interaction": _model(*PLAIN[2]),
    "model_predictions": PREDICTIONS,
    "plain_model_comparison": clean(COMPARISON_BODY, ALL_RIDGES),
    "best_plain_model": clean(f"SELECT * FROM ({COMPARISON_BODY}) ORDER BY rmsle, model LIMIT 1", ALL_RIDGES),
    "pickup_clusters": PICKUP_CLUSTERS,
    "grid_scores": CLUSTER_GRID,
    "model_optimized": OPTIMIZED_ROW,
    "model_comparison": clean(COMPARED_BODY, COMPARED),
    "best_model": clean(f"SELECT * FROM ({COMPARED_BODY}) ORDER BY rmsle, model LIMIT 1", COMPARED),
    "model_residuals_by_hour": clean(
        _hour_profile("residual_sec", "left_over", FITTED_PLACES, FITTED_PLACES),
        TESTED
        + ", left_over AS (SELECT pickup_hour, (exp(log_duration) - 1e0) - (exp(p) - 1e0) AS residual_sec FROM tested)",
    ),
    "model_roundtrip_score": clean(f"SELECT {scored_columns(FITTED_PLACES)}, 'model' AS scorer FROM scored", MODEL_SCORED),
    "stream_score_model": clean(f"SELECT {scored_columns(FITTED_PLACES)}, 'model' AS scorer FROM scored", MODEL_SCORED),
    "prediction_interval": clean(
        f"SELECT id, {r('duration_seconds', 'duration_seconds', FITTED_PLACES)}, "
        f"{r('exp(log_prediction - half) - 1e0', 'seconds_low', FITTED_PLACES)}, "
        f"{r('exp(log_prediction + half) - 1e0', 'seconds_high', FITTED_PLACES)} "
        "FROM scored CROSS JOIN (SELECT 196e-2 * sqrt(avg(pow(log_duration - p, 2))) AS half FROM tested)",
        MODEL_SCORED,
    ),
}
