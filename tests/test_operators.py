from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tests.demo import demo_requests
from wayfare import schema as S
from wayfare.operators import clean, metrics, profile, split, stats, validate
from wayfare.operators import models as M
from wayfare.plans import explore

# Rows left after each cleaning step, by scale factor.
FUNNEL = {
    "sf0.001": [1000, 966, 911, 897, 886],
    "sf0.01": [10000, 9655, 9111, 8968, 8846],
    "sf0.1": [100000, 96562, 91152, 89797, 88579],
}


@pytest.mark.parametrize("scale", FUNNEL)
def test_funnel_counts(spark, scale):
    from wayfare.sources.trips import read_trips

    rows = clean.cleaning_funnel(read_trips(spark, f"/root/testdata/{scale}")).orderBy("position").collect()
    left = [r.rows for r in rows]
    assert left == FUNNEL[scale]
    assert [r.dropped for r in rows] == [0] + [a - b for a, b in zip(left, left[1:])]


def test_funnel_agrees_with_the_filters(trips, cleaned):
    steps = [trips, clean.filter_passengers(trips)]
    steps.append(clean.filter_positions(steps[-1]))
    steps.append(clean.filter_durations(steps[-1]))
    counts = [s.count() for s in steps] + [cleaned.count()]
    assert counts == FUNNEL["sf0.001"]


def test_clean_schema_and_rules(cleaned):
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in S.CLEAN_SCHEMA]
    bad = cleaned.filter(
        F.col("passenger_count").isin(0, 7, 8, 9)
        | F.col("passenger_count").isNull()
        | ~F.col("trip_duration").between(60, 7200)
        | ~F.col("avg_speed_kmh").between(2, 120)
        | (F.col("distance_km") <= 0)
    )
    assert bad.count() == 0


def test_clean_is_idempotent(cleaned):
    twice = clean.clean_trips(cleaned)
    assert twice.columns == cleaned.columns
    assert sorted(map(str, twice.collect())) == sorted(map(str, cleaned.collect()))


def test_cleaning_rules_are_parameters(trips):
    strict = clean.CleanRules(duration_range=(300, 600), airport_km=(5, 10), peak_hours=(12,))
    rows = clean.clean_trips(trips, strict).select("trip_duration", "airport_trip", "distance_km", "pickup_hour", "is_peak").collect()
    assert rows and all(300 <= r.trip_duration <= 600 for r in rows)
    assert all(r.airport_trip == (5 <= r.distance_km <= 10) for r in rows)
    assert all(r.is_peak == (r.pickup_hour == 12) for r in rows)


def test_missing_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (3, None)], "a int, b double")
    got = {r.column: (r.missing, r.rows) for r in profile.missing_profile(df).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}


def test_profile_of_an_empty_table(trips):
    empty = trips.limit(0)
    assert [r.rows for r in profile.table_shape(empty).collect()] == [0]
    assert all(r.fraction is None for r in profile.missing_profile(empty).collect())
    assert stats.histogram_range(empty, "trip_duration", 10).agg(F.sum("count")).first()[0] == 0


def test_exact_profile_against_numpy(cleaned):
    got = {r.pickup_hour: r for r in stats.exact_group_profile(cleaned, "pickup_hour", "trip_duration").collect()}
    pdf = cleaned.select("pickup_hour", "trip_duration").toPandas()
    for hour, group in pdf.groupby("pickup_hour")["trip_duration"]:
        row, values = got[hour], group.to_numpy()
        quartiles = np.quantile(values, [0.25, 0.5, 0.75], method="inverted_cdf")
        assert (row.q1, row.median, row.q3) == tuple(quartiles)
        assert (row["count"], row.min, row.max, row.iqr) == (len(values), values.min(), values.max(), quartiles[2] - quartiles[0])
        assert row.mean == pytest.approx(values.mean()) and row.stddev == pytest.approx(values.std(ddof=1))


def test_exact_profile_with_one_hot_group(spark):
    """A group with most of the rows gives the same numbers as brute force."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 9, 8).otherwise(F.col("id") % 24).cast("int").alias("h"),
        (60 + F.col("id") * 7919 % 7141).cast("int").alias("d"),
    )
    got = {r.h: (r.q1, r.median, r.q3) for r in stats.exact_group_quartiles(df, "h", "d").collect()}
    pdf = df.toPandas()
    for hour, values in pdf.groupby("h")["d"]:
        assert got[hour] == tuple(np.quantile(values, [0.25, 0.5, 0.75], method="inverted_cdf"))


def test_exact_profile_of_single_rows(spark):
    df = spark.createDataFrame([(1, 100), (2, 200)], "h int, d int")
    rows = stats.exact_group_profile(df, "h", "d").collect()
    assert [(r.median, r.mean, r.stddev) for r in rows] == [(100, 100.0, None), (200, 200.0, None)]


def test_frequency_tables_agree_with_single_ones(cleaned):
    together = {(r.column, r.value): r["count"] for r in stats.frequency_tables(cleaned, S.CATEGORY_COLUMNS).collect()}
    for column in S.CATEGORY_COLUMNS:
        for r in stats.frequency(cleaned, column).collect():
            key = None if r[column] is None else str(r[column])
            assert together.pop((column, key)) == r["count"]
    assert not together


def test_shares_add_up(trips):
    assert sum(r.percent for r in stats.share(trips, "vendor_id").collect()) == pytest.approx(100.0)


def test_correlation_matches_spark_ml(cleaned):
    vectors = M.assembler(S.CORRELATION_COLUMNS, "v").transform(cleaned)
    want = Correlation.corr(vectors, "v").head()[0].toArray()
    got = [[r[c] for c in S.CORRELATION_COLUMNS] for r in stats.correlation_matrix(cleaned, S.CORRELATION_COLUMNS).collect()]
    assert np.allclose(got, want, atol=1e-12)
    strong = stats.strong_pairs(stats.correlation_pairs(cleaned, S.CORRELATION_COLUMNS)).collect()
    assert ("distance_km", "log_duration") in {(r.col_a, r.col_b) for r in strong}
    assert all(abs(r.r) > 0.3 for r in strong)


def test_histograms_against_numpy(cleaned):
    pdf = cleaned.select("trip_duration", "log_duration").toPandas()
    fixed = [r["count"] for r in stats.histogram_fixed(cleaned, "trip_duration", 100, 0, 3600).collect()]
    assert fixed == np.histogram(pdf["trip_duration"], bins=100, range=(0, 3600))[0].tolist()
    ranged = [r["count"] for r in stats.histogram_range(cleaned, "log_duration", 100).collect()]
    assert ranged == np.histogram(pdf["log_duration"], bins=100)[0].tolist()


def test_histogram_of_a_constant(spark):
    df = spark.range(5).select(F.lit(2.0).alias("x"))
    rows = stats.histogram_range(df, "x", 4).collect()
    assert [r["count"] for r in rows] == [5, 0, 0, 0]


def test_histogram_leaves_out_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r["count"] for r in stats.histogram_range(df, "x", 2).collect()] == [1, 1]


def test_density_covers_every_drawable_point(trips):
    grid = stats.coordinate_grid(trips, 0.01)
    drawable = trips.filter(F.col("pickup_longitude").isNotNull() & ~F.isnan("pickup_longitude")).count()
    by_kind = {r.kind: r.n for r in grid.groupBy("kind").agg(F.sum("count").alias("n")).collect()}
    assert by_kind == {"pickup": drawable, "dropoff": trips.count()}


def test_bins_are_whole_kilometres(cleaned):
    rows = stats.binned_mean(cleaned, "distance_km", "log_duration", 0.5, 3).collect()
    assert [r.bin for r in rows] == sorted({r.bin for r in rows}) and all(r.bin * 2 == int(r.bin * 2) for r in rows)


def test_split_does_not_depend_on_partitioning(cleaned):
    train, test = split.hash_split(cleaned)
    again, _ = split.hash_split(cleaned.repartition(7).select(*reversed(cleaned.columns)))
    ids = {r.id for r in train.select("id").collect()}
    assert ids == {r.id for r in again.select("id").collect()}
    assert ids.isdisjoint({r.id for r in test.select("id").collect()})
    assert len(ids) + test.count() == cleaned.count()
    assert len(ids) / cleaned.count() == pytest.approx(0.7, abs=0.05)


def test_validation_reasons(spark):
    good = demo_requests(spark).limit(1)
    bad = {
        "pickup_latitude": F.lit(41.5),
        "pickup_longitude": F.lit(float("nan")),
        "dropoff_latitude": F.lit(None).cast("double"),
        "dropoff_longitude": F.lit(-75.0),
        "pickup_datetime": F.lit(datetime(2015, 12, 31, 23, 59)).cast("timestamp_ntz"),
        "passenger_count": F.lit(7),
        "vendor_id": F.lit(3),
        "store_and_fwd_flag": F.lit("x"),
    }
    assert validate.validate_requests(good).first().reasons == []
    for column, value in bad.items():
        row = validate.validate_requests(good.withColumn(column, value)).first()
        assert row.reasons == ["pickup_date" if column == "pickup_datetime" else column]
        assert not row.accepted
    everything = validate.validate_requests(good.withColumns(bad)).first()
    assert len(everything.reasons) == 8


def test_every_request_is_accepted_or_quarantined(trips):
    checked = validate.validate_requests(trips)
    kept, rejected = validate.accepted(checked), validate.quarantined(checked)
    assert kept.count() + rejected.count() == trips.count()
    assert rejected.filter(F.size("reasons") == 0).count() == 0


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.uniform(5, 8, 200)
    p = y + rng.normal(0, 0.2, 200)
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist(), strict=True)), "log_duration double, p double")
    row = metrics.regression_metrics(df, {"m": "p"}).first()
    assert row.rmse_log == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row.rmsle == pytest.approx(row.rmse_log)
    assert row.rmse_sec == pytest.approx(np.sqrt(np.mean((np.expm1(y) - np.expm1(p)) ** 2)))
    assert row.mae_sec == pytest.approx(np.mean(np.abs(np.expm1(y) - np.expm1(p))))
    assert row.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_best_model_breaks_ties_by_name(spark):
    table = spark.createDataFrame([("b", 0.2), ("a", 0.2), ("c", 0.3)], "model string, rmsle double")
    assert metrics.best_model(table).first().model == "a"


def test_exact_profile_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (1, 30), *[(1, None)] * 4, (2, None)], "h int, d int")
    exact = [tuple(r) for r in stats.exact_group_profile(df, "h", "d").collect()]
    assert exact == [tuple(r) for r in stats.group_profile(df, "h", "d").collect()]
    assert exact[0] == (1, 7, 10, 10, 20, 30, 30, 20.0, 10.0, 20)
    with pytest.raises(TypeError, match="group_profile"):
        stats.exact_group_quartiles(df.withColumn("d", df["d"].cast("double")), "h", "d")


def test_split_keeps_rows_without_an_id(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    train, test = split.hash_split(df)
    assert train.count() + test.count() == 3


def test_raw_reports_equal_the_reports_one_by_one(spark, trips):
    """Three passes for all of them: the tables are those of the single operators."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = trips.mapInArrow(count, trips.schema)
    found = {name: table.collect() for name, table in explore.raw_reports(counted).items()}
    assert seen.value <= 3 * trips.count()
    rules = clean.CleanRules()
    seated = clean.filter_passengers(trips)
    placed = clean.filter_positions(seated)
    single = {
        "schema": profile.schema_listing(trips),
        "shape": profile.table_shape(trips),
        "preview": profile.preview(trips),
        "missing": profile.missing_profile(trips),
        "describe": profile.describe_numeric(trips, ["vendor_id", *S.NUMERIC_COLUMNS]),
        "describe_strings": profile.describe_strings(trips, ["id", "store_and_fwd_flag"]),
        "flag": stats.frequency(trips, "store_and_fwd_flag"),
        "passengers": stats.frequency(trips, "passenger_count"),
        "vendor_share": stats.share(trips, "vendor_id"),
        "vendor_duration": stats.group_mean(trips, "vendor_id", "trip_duration", "avg_duration"),
        "funnel": clean.cleaning_funnel(trips),
        "positions": stats.coordinate_grid(seated, explore.GRID_DEGREES),
        "positions_zoomed": stats.coordinate_grid(seated, explore.GRID_DEGREES, rules.lon_range, rules.lat_range),
        "duration_summary": profile.value_summary(placed, "trip_duration"),
        "duration_histogram": stats.histogram_fixed(placed, "trip_duration", 100, 0, 3600),
    }
    assert set(found) == set(single)

    def cells(rows):
        return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)

    for name, table in single.items():
        assert [c.name for c in table.schema] == list(found[name][0].__fields__), name
        assert cells(found[name]) == cells(table.collect()), name


def spread_values(spark, kind: str, groups: int = 1):
    """Far more different values in a group than a sketch keeps, in no order."""
    value = F.pmod(F.col("id") * 7919, F.lit(400_009)) * 3 - 500_000
    return spark.range(0, 400_009, 1, 8).select((F.col("id") % groups).alias("h"), value.cast(kind).alias("d"))


@pytest.mark.parametrize("kind", ["int", "double"])
def test_value_summary_is_exact_beyond_the_size_of_a_sketch(spark, kind):
    [row] = profile.value_summary(spread_values(spark, kind), "d").collect()
    ranks = [math.ceil(400_009 * p) - 1 for p in (0.25, 0.5, 0.75)]
    assert [row.p25, row.p50, row.p75] == [3 * k - 500_000 for k in ranks]
    assert (row["count"], row.min, row.max) == (400_009, -500_000, 3 * 400_008 - 500_000)


def test_value_summary_of_odd_tables(spark):
    inf, nan = float("inf"), float("nan")

    def summary(values):
        [row] = profile.value_summary(spark.createDataFrame([(v,) for v in values], "d double"), "d").collect()
        return row["count"], row.p25, row.p50, row.p75

    assert summary([]) == (0, None, None, None)
    assert summary([None, None]) == (0, None, None, None)
    assert summary([5.0, None]) == (1, 5.0, 5.0, 5.0)
    assert summary([-inf, 1.0, 1.0, inf]) == (4, -inf, 1.0, 1.0)
    assert str(summary([1.0, nan, 2.0, nan])) == str((4, 1.0, 2.0, nan))


@pytest.mark.parametrize("kind", ["int", "double"])
def test_group_profile_is_exact_beyond_the_size_of_a_sketch(spark, kind):
    df = spread_values(spark, kind, groups=3)
    rows = df.collect()
    for row in stats.group_profile(df, "h", "d").collect():
        values = sorted(r.d for r in rows if r.h == row.h)
        wanted = [values[math.ceil(len(values) * p) - 1] for p in (0.25, 0.5, 0.75)]
        assert [row.q1, row.median, row.q3, row.iqr] == [*wanted, wanted[2] - wanted[0]]
        assert (row["count"], row.min, row.max) == (len(values), values[0], values[-1])


def test_group_profile_of_odd_groups(spark):
    df = spark.createDataFrame([(None, 3.0), (None, None), (1, None), (2, 7.0), (2, 5.0)], "h int, d double")
    found = [tuple(r) for r in stats.group_profile(df, "h", "d").collect()]
    assert found == [
        (None, 2, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, None, 0.0),
        (1, 1, None, None, None, None, None, None, None, None),
        (2, 2, 5.0, 5.0, 5.0, 7.0, 7.0, 6.0, math.sqrt(2), 2.0),
    ]


def test_group_profile_refuses_bounds_that_miss_a_quartile(spark, monkeypatch):
    monkeypatch.setattr(profile, "MARGIN", -500)
    with pytest.raises(Exception, match="outside the sketched bounds"):
        stats.group_profile(spread_values(spark, "int"), "h", "d").collect()
