from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.demo import DEMO, demo_requests
from wayfare.functions import calendar, geo, trip
from wayfare.functions.hashing import hash_bucket, hash_uniform
from wayfare.operators import score
from wayfare.operators.features import add_serving_features


def distances(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    return [r[0] for r in df.select(geo.haversine_km("a", "b", "c", "d")).collect()]


def test_haversine_values(spark):
    there = distances(spark, [(p[1], p[2], p[3], p[4]) for p in DEMO])
    back = distances(spark, [(p[3], p[4], p[1], p[2]) for p in DEMO])
    assert [round(x, 4) for x in there] == [p[8] for p in DEMO]
    assert there == pytest.approx(back, rel=1e-12)


def test_haversine_edges(spark):
    same, pole, antipode, missing = distances(
        spark, [(40.7, -73.9, 40.7, -73.9), (90.0, 0.0, -90.0, 0.0), (0.0, 0.0, 0.0, 180.0), (40.7, None, 40.7, -73.9)]
    )
    assert same == 0.0
    assert pole == pytest.approx(math.pi * 6371.0)
    assert antipode == pytest.approx(math.pi * 6371.0)
    assert missing is None


def test_serving_features_of_the_demo_trips(spark):
    rows = add_serving_features(demo_requests(spark)).orderBy("id").collect()
    assert [r.pickup_hour for r in rows] == [6, 17, 14, 23, 12, 14]
    assert {r.pickup_weekday for r in rows} == {4}  # a Wednesday, 1 = Sunday
    assert {r.pickup_month for r in rows} == {6}
    assert [r.is_peak for r in rows] == [0, 1, 0, 0, 0, 0]
    assert [r.airport_trip for r in rows] == [0, 0, 1, 0, 0, 0]
    assert [r.store_and_fwd_flag_num for r in rows] == [0, 0, 0, 1, 0, 0]
    assert rows[1].distance_peak == pytest.approx(rows[1].distance_km)
    assert rows[0].distance_peak == 0.0


def test_missing_coordinate_gives_null_or_zero(spark):
    df = demo_requests(spark).limit(1).withColumn("pickup_latitude", F.lit(None).cast("double"))
    assert add_serving_features(df).first().distance_km is None
    assert add_serving_features(df, null_distance_as_zero=True).first().distance_km == 0.0


def test_calendar_parts(spark):
    days = [datetime(2016, 6, 12), datetime(2016, 6, 13), datetime(2016, 6, 18)]  # Sunday, Monday, Saturday
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    rows = df.select(calendar.pickup_weekday("t"), calendar.iso_weekday("t"), calendar.is_weekend("t")).collect()
    assert [tuple(r) for r in rows] == [(1, 7, 1), (2, 1, 0), (7, 6, 1)]


def test_pickup_timestamp_combines_and_rejects(spark):
    df = spark.createDataFrame([("2016-03-13", "02:30:00"), ("2016-13-01", "10:00:00"), (None, "10:00:00")], "d string, t string")
    got = [r[0] for r in df.select(calendar.pickup_timestamp("d", "t")).collect()]
    assert got == [datetime(2016, 3, 13, 2, 30), None, None]


def test_wall_clock_text_ignores_the_session_zone(spark):
    """02:30 on this day does not exist in New York."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(datetime(2016, 3, 13, 2, 30, 5),)], "t timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(
            calendar.timestamp_text("t"),
            calendar.pickup_hour("t"),
            calendar.pickup_timestamp(calendar.date_text("t"), calendar.time_text("t")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("2016-03-13 02:30:05", 2, datetime(2016, 3, 13, 2, 30, 5))


def test_speed_of_a_zero_duration(spark):
    df = spark.createDataFrame([(3.0, 0), (3.0, 3600)], "km double, s int")
    rows = df.select(trip.speed_kmh("km", "s"), trip.speed_kmh_or_zero("km", "s")).collect()
    assert [tuple(r) for r in rows] == [(None, 0.0), (3.0, 3.0)]


def test_bands(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (29.99,), (30.0,), (None,)], "m double")
    assert [r[0] for r in df.select(trip.duration_band("m")).collect()] == ["short", "normal", "normal", "long", None]


def test_label_round_trip(spark):
    df = spark.range(60, 7201, 60).select(F.col("id").alias("s"))
    back = df.select((trip.seconds_from_log(trip.log_label("s")) - F.col("s")).alias("e")).agg(F.max(F.abs("e"))).first()
    assert back[0] < 1e-9


def test_factor_scorer_by_hand(spark):
    rows = score.score_factors(add_serving_features(demo_requests(spark))).orderBy("id").collect()
    for row, (clock, *_, vendor, passengers, flag, _) in zip(rows, DEMO, strict=True):
        hour = int(clock[:2])
        want = (200 + 40 * row.distance_km) * (1.4 if hour in (7, 8, 9, 17, 18, 19) else 0.8)
        want *= 1 + (passengers - 1) * 0.03
        want *= 1.02 if vendor == 2 else 1.0
        want *= 1.08 if flag == "Y" else 1.0
        assert row.duration_seconds == pytest.approx(want, rel=1e-12)
        assert row.duration_minutes == pytest.approx(want / 60)
        assert row.avg_speed == pytest.approx(row.distance_km / (want / 3600))
        assert row.log_prediction == pytest.approx(math.log1p(want))


def test_additive_scorer_by_hand(spark):
    rows = score.score_additive(add_serving_features(demo_requests(spark))).orderBy("id").collect()
    for row in rows:
        want = 300 + 60 * row.distance_km + 180 * row.is_peak + 600 * row.airport_trip
        assert row.duration_seconds == pytest.approx(want, rel=1e-12)


def test_report_has_ten_lines_per_trip(spark):
    scored = score.score_or_fall_back(add_serving_features(demo_requests(spark)), None)
    report = {(r.id, r.metric): r.value for r in score.score_report(scored).collect()}
    assert len(report) == 10 * len(DEMO)
    assert report["demo2", "Distance (km)"] == "21.48"  # 21.4750 km rounded to 2 places
    assert report["demo2", "Airport Trip Factor"] == "Yes"
    assert report["demo1", "Peak Hour Factor"] == "Yes"
    assert report["demo1", "Processing Mode"] == "Demo Mode" and report["demo1", "Input Features"] == "9 columns"
    live = score.score_report(scored.withColumn("scorer", F.lit("model"))).filter("metric = 'Processing Mode'")
    assert {r.value for r in live.collect()} == {"Live Model"}


def test_noise_is_bounded_and_repeatable(trips):
    df = trips.select("id", score.noise_factor(scale=0.05).alias("f"))
    low, high, mean = df.agg(F.min("f"), F.max("f"), F.avg("f")).first()
    assert 0.95 <= low < 0.955 and 1.045 < high < 1.05
    assert mean == pytest.approx(1.0, abs=0.01)
    again = trips.repartition(5).select("id", score.noise_factor(scale=0.05).alias("f"))
    assert sorted(df.collect()) == sorted(again.collect())


def test_hash_functions_spread(trips):
    buckets = trips.groupBy(hash_bucket("id", 10).alias("b")).count().collect()
    assert len(buckets) == 10 and min(r["count"] for r in buckets) > 50
    low, high = trips.select(hash_uniform("id").alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= low and high < 1
