from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.demo import demo_requests
from wayfare import schema as S
from wayfare.catalogue.queries import QUERIES
from wayfare.operators import clean, score, stats
from wayfare.plans import explore, serve
from wayfare.sources import scratch, sinks, trips
from wayfare.sources.trips import read_trips_csv, requests_from_trips, stream_events, trips_from_events
from wayfare.streaming import score as stream_score


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def text_rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def clean_path(spark, cleaned):
    path = scratch.run_dir(spark, "test-clean")
    sinks.write_clean(cleaned, path)
    return path


def test_clean_table_round_trip(spark, cleaned, clean_path):
    back = sinks.read_clean(spark, clean_path)
    assert back.schema.simpleString() == cleaned.schema.simpleString()
    assert text_rows(back) == text_rows(cleaned)


def test_month_filter_prunes_directories_and_columns(spark, clean_path):
    df = sinks.read_clean(spark, clean_path).filter("pickup_month = 3").select("distance_km")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(pickup_month" in text
    assert "ReadSchema: struct<distance_km:double>" in text


def test_filters_reach_the_scan(spark, clean_path):
    back = sinks.read_clean(spark, clean_path)
    text = plan(clean.filter_durations(clean.filter_positions(back)).select("id"))
    assert "GreaterThanOrEqual(trip_duration,60)" in text
    assert "GreaterThanOrEqual(pickup_longitude,-74.1)" in text


def test_csv_round_trip_with_and_without_schema(spark, trips):
    path = scratch.run_dir(spark, "test-csv")
    sinks.export_csv(trips, path)
    declared = read_trips_csv(spark, path)
    assert declared.schema == S.TRIP_SCHEMA
    assert text_rows(declared) == text_rows(trips)
    inferred = read_trips_csv(spark, path, infer=True)
    assert inferred.schema["pickup_datetime"].dataType == S.TRIP_SCHEMA["pickup_datetime"].dataType
    assert text_rows(inferred) == text_rows(trips)


def test_csv_without_fractions_of_a_second(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        ",".join(S.TRIP_COLUMNS) + "\nid1,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455\n"
    )
    row = read_trips_csv(spark, str(tmp_path)).first()
    assert str(row.pickup_datetime) == "2016-03-14 17:24:55" and row.trip_duration == 455


def test_reports_of_any_size_are_written_whole(spark):
    path = scratch.run_dir(spark, "test-report")
    sinks.export_csv(spark.range(100_001), path)
    assert spark.read.option("header", True).csv(path).count() == 100_001


def test_csv_columns_are_found_by_their_header(spark, trips):
    path = scratch.run_dir(spark, "test-csv")
    sinks.export_csv(trips.select(*reversed(S.TRIP_COLUMNS)).withColumn("extra", F.lit(1)), path)
    assert text_rows(read_trips_csv(spark, path)) == text_rows(trips)
    with pytest.raises(ValueError, match="trip_duration"):
        read_trips_csv(spark, _written(spark, trips.drop("trip_duration")))


def _written(spark, df) -> str:
    path = scratch.run_dir(spark, "test-csv")
    sinks.export_csv(df, path)
    return path


def test_malformed_lines_are_accounted_for(spark, tmp_path):
    lines = [
        "id1,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455",
        "id2,2,03/14/2016 17:24,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455",
        "id3,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1.0,-73.98,40.76,-73.96,40.77,N,455",
        "id4,2,2016-03-14 17:24:55,2016-03-14 17:32:30,,-73.98,40.76,-73.96,40.77,,455",
    ]
    (tmp_path / "t.csv").write_text("\n".join([",".join(S.TRIP_COLUMNS), *lines]) + "\n")
    good, bad, _ = explore.ingest_csv(spark, str(tmp_path / "t.csv"), scratch.run_dir(spark, "test-trips"))
    assert sorted(r.id for r in good.collect()) == ["id1", "id4"]
    assert sorted(r.line for r in bad.collect()) == lines[1:3]
    with pytest.raises(Exception, match="MALFORMED"):
        read_trips_csv(spark, str(tmp_path / "t.csv")).collect()


def test_scratch_lies_in_a_shared_folder(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert scratch.scratch_root(Session(spark_checkpoint_dir="/shared/x/")) == "/shared/x"
    unset = Session()
    unset.conf["spark.sql.warehouse.dir"] = "hdfs://store/warehouse"
    assert scratch.scratch_root(unset) == "hdfs://store/warehouse/_scratch"
    assert scratch.run_dir(spark, "a") != scratch.run_dir(spark, "a")


def test_stream_equals_batch(spark, sf_dir, trips):
    stream = requests_from_trips(trips_from_events(stream_events(spark, sf_dir)))
    out, bad = scratch.run_dir(spark, "test-out"), scratch.run_dir(spark, "test-bad")
    stream_score.start_scoring(stream, out, scratch.run_dir(spark, "test-log")).awaitTermination()
    stream_score.start_quarantine(stream, bad, scratch.run_dir(spark, "test-log")).awaitTermination()
    requests = requests_from_trips(trips)
    assert text_rows(spark.read.parquet(out)) == text_rows(serve.score_requests(requests))
    assert text_rows(spark.read.parquet(bad)) == text_rows(serve.rejected_requests(requests))


def test_stream_takes_files_as_they_come_and_restarts(spark, sf_dir, tmp_path):
    """Two runs with one checkpoint: the second scores only the new file."""
    source = tmp_path / "events.parquet"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    log, out = scratch.run_dir(spark, "test-log"), scratch.run_dir(spark, "test-out")

    def run():
        stream = requests_from_trips(trips_from_events(stream_events(spark, str(tmp_path), files_per_trigger=1)))
        stream_score.start_scoring(stream, out, log).awaitTermination()
        return spark.read.parquet(out).count()

    events.filter("event_id < 400").coalesce(1).write.mode("append").parquet(str(source))
    first = run()
    assert run() == first
    events.filter("event_id >= 400").coalesce(1).write.mode("append").parquet(str(source))
    assert run() == serve.score_requests(requests_from_trips(trips_from_events(events))).count() > first


def test_form_requests_with_date_and_time_apart(spark):
    whole = demo_requests(spark)
    apart = whole.select(
        "*",
        F.date_format("pickup_datetime", "yyyy-MM-dd").alias("pickup_date"),
        F.date_format("pickup_datetime", "HH:mm:ss").alias("pickup_time"),
    ).drop("pickup_datetime")
    combined = serve.combine_pickup(apart)
    assert text_rows(combined.select(*S.REQUEST_COLUMNS)) == text_rows(whole.select(*S.REQUEST_COLUMNS))
    assert serve.score_requests(combined).select(*score.SCORED_COLUMNS).count() == whole.count()


def test_explore_job_writes_everything(spark, trips):
    table, report = scratch.run_dir(spark, "test-clean"), scratch.run_dir(spark, "test-reports")
    reports = explore.explore(spark, trips, table, report)
    assert sinks.read_clean(spark, table).count() == 886
    hours = spark.read.option("header", True).csv(f"{report}/hour_profile")
    assert hours.count() == 24
    assert set(reports) >= {"funnel", "correlation", "hour_profile", "positions_zoomed"}


def native(df) -> str:
    """The plan, if it has no Python worker and no product of two tables."""
    text = plan(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    return text


@pytest.mark.parametrize("name", QUERIES)
def test_plans_stay_native(spark, sf_dir, name):
    text = native(QUERIES[name](spark, sf_dir))
    assert "props" not in text.split("ReadSchema")[-1].split("\n")[0]


def test_stream_plans_stay_native(spark, sf_dir):
    stream = requests_from_trips(trips_from_events(stream_events(spark, sf_dir)))
    for df in (serve.score_requests(stream), serve.rejected_requests(stream)):
        native(df)


def test_explore_parses_the_csv_once(spark, trips, monkeypatch):
    """Whatever the job runs, only the ingest reads the text; everything after it reads Parquet."""
    path = _written(spark, trips)
    good, bad, _ = explore.ingest_csv(spark, path, scratch.run_dir(spark, "test-trips"))
    for df in [bad, clean.clean_trips(good), *explore.raw_reports(good).values()]:
        assert "Scan csv" not in plan(df)


def test_cleaning_needs_no_shuffle(cleaned):
    assert "Exchange" not in plan(cleaned)


def test_distance_is_computed_once(cleaned):
    """The formula appears in one operator; filters above it read the value."""
    formula = [line for line in plan(cleaned).splitlines() if "ATAN2" in line]
    assert len(formula) == 1 and not formula[0].startswith("Condition")


def _parts(tmp_path, **files: str) -> str:
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_parts_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    path = _parts(tmp_path, one="a,b\n1,0.5\n", two="b,a\n2.5,3\n4.5,x\n", **{"odd [1] {x} 50% y": "z,b,a\n?,6.5,7\n"}, empty="")
    rows = trips.parse_trips_csv(spark, path, schema).collect()
    assert sorted((r.a, r.b) for r in rows if r[trips.CORRUPT] is None) == [(1, 0.5), (3, 2.5), (7, 6.5)]
    assert [r[trips.CORRUPT] for r in rows if r[trips.CORRUPT]] == ["4.5,x"]
    with pytest.raises(Exception, match="(?i)malformed"):
        trips.read_trips_csv(spark, path, schema).collect()
    inferred = trips.read_trips_csv(spark, _parts(tmp_path, two="b,a\n2.5,3\n"), infer=True)
    assert sorted((r.a, r.b) for r in inferred.collect()) == [(1, 0.5), (3, 2.5), (7, 6.5)]
    with pytest.raises(ValueError, match="no column"):
        trips.read_trips_csv(spark, _parts(tmp_path, three="a,c\n1,2\n"), schema)


def test_a_folder_without_a_header_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        trips.read_trips_csv(spark, _parts(tmp_path, empty=""))


def test_serving_writes_each_request_once_after_a_failure(spark, trips, monkeypatch):
    """The first run fails between its two writes; the second one takes the batch again."""
    source = scratch.run_dir(spark, "test-requests")
    requests = requests_from_trips(trips)
    requests.write.parquet(source)
    out, bad, log = (scratch.run_dir(spark, f"test-{name}") for name in ("out", "bad", "log"))

    def run():
        stream = spark.readStream.schema(S.REQUEST_SCHEMA).parquet(source)
        stream_score.start_serving(stream, out, bad, log).awaitTermination()

    def broken(validated):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(serve, "quarantined", broken)
        with pytest.raises(Exception, match="lost"):
            run()
    assert spark.read.parquet(out).count() > 0
    run()
    run()
    for path, want in ((out, serve.score_requests(requests)), (bad, serve.rejected_requests(requests))):
        assert text_rows(spark.read.parquet(path).drop("batch")) == text_rows(want)
    requests.limit(10).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).count() + spark.read.parquet(bad).count() == requests.count() + 10


def test_a_month_is_replaced_alone(spark, cleaned):
    path = scratch.run_dir(spark, "test-clean")
    sinks.write_clean(cleaned, path)
    before = spark.read.parquet(path)
    others = {f for f in before.inputFiles() if "pickup_month=3" not in f}
    for _ in range(2):
        sinks.rewrite_months(cleaned.filter("pickup_month = 3 AND vendor_id = 1"), path, [3])
    after = sinks.read_clean(spark, path)
    assert {f for f in spark.read.parquet(path).inputFiles() if "pickup_month=3" not in f} == others
    assert text_rows(after) == text_rows(cleaned.filter("pickup_month <> 3 OR vendor_id = 1"))
    with pytest.raises(ValueError, match="other months"):
        sinks.rewrite_months(cleaned, path, [3])
    with pytest.raises(ValueError, match="no rows"):
        sinks.rewrite_months(cleaned.filter("pickup_month = 3"), path, [3, 12])
    assert text_rows(sinks.read_clean(spark, path)) == text_rows(after)


def test_a_scope_deletes_its_folders_unless_it_fails(spark, tmp_path):
    with scratch.scope(spark):
        path = scratch.run_dir(spark, "test")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path)
    with pytest.raises(RuntimeError), scratch.scope(spark):
        kept = scratch.run_dir(spark, "test")
        spark.range(3).write.parquet(kept)
        raise RuntimeError
    assert spark.read.parquet(kept).count() == 3
    with scratch.scope(spark):
        scratch.run_dir(spark, "never written")


def test_sketches_merge_to_the_quartiles_of_the_whole(spark):
    rows = spark.range(60000).selectExpr("id % 3 AS g", "id % 7 AS part", "CAST(pow(id % 997, 2) AS INT) AS v")
    merged = stats.merged_quartiles(stats.quantile_sketches(rows, ["g", "part"], "v"), ["g"]).collect()
    for r in merged:
        values = sorted(x.v for x in rows.filter(f"g = {r.g}").collect())
        assert r.n == len(values)
        for q, got in zip((0.25, 0.5, 0.75), (r.q1, r.median, r.q3), strict=True):
            below, upto = sum(v < got for v in values) / r.n, sum(v <= got for v in values) / r.n
            assert below - stats.SKETCH_ERROR <= q <= upto + stats.SKETCH_ERROR
    empty = stats.quantile_sketches(rows.limit(0), ["g", "part"], "v")
    assert stats.merged_quartiles(empty, ["g"]).count() == 0
