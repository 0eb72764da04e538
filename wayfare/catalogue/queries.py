"""Registered queries: (spark, data folder) -> DataFrame, over the whole trips table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schema as S
from wayfare.functions import calendar
from wayfare.operators import clean, features, metrics, profile, score, split, stats, tuning, validate
from wayfare.operators import models as M
from wayfare.plans import explore, serve, train
from wayfare.sources import models as model_store
from wayfare.sources import scratch, sinks, trips
from wayfare.streaming import score as stream_score

Query = Callable[[SparkSession, str], DataFrame]

PLACES = 6
FITTED_PLACES = 3  # rows that come from a fitted model
BINS = 100


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """The comparable form of a result.

    Doubles to fixed places, so that engines that add in another order agree;
    integer columns that may hold NULLs as doubles, because row readers differ
    in how they hold a NULL among integers.
    """

    def cell(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return F.round(value, places).alias(field.name)
        if field.name in S.NULLABLE_COUNTS:
            return value.cast("double").alias(field.name)
        return value

    return df.select(*[cell(f) for f in df.schema.fields])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.read_trips(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_trips(raw(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.requests_from_trips(raw(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = validate.accepted(validate.validate_requests(requests(spark, sf_dir)))
    return features.add_serving_features(good)


def on_raw(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(op(raw(spark, sf_dir)))


def on_clean(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(op(cleaned(spark, sf_dir)))


def on_featured(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(op(featured(spark, sf_dir)))


def placed(df: DataFrame) -> DataFrame:
    """Trips after the passenger and position rules."""
    return df.transform(clean.filter_passengers).transform(clean.filter_positions)


def clean_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.run_dir(spark, "clean")
    sinks.write_clean(cleaned(spark, sf_dir), path)
    return rounded(sinks.read_clean(spark, path))


def clean_month_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose third month was written from half of its trips; that month is run again."""
    path, whole = scratch.run_dir(spark, "clean"), cleaned(spark, sf_dir)
    sinks.write_clean(whole.filter((F.col("pickup_month") != 3) | (_number() % 2 == 0)), path)
    sinks.rewrite_months(whole.filter("pickup_month = 3"), path, [3])
    return rounded(sinks.read_clean(spark, path))


def density_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zoom pyramid as written, a folder for each level, read level by level."""
    path = scratch.run_dir(spark, "zoom")
    stats.density_pyramid(cleaned(spark, sf_dir), *S.POSITION_2).write.partitionBy("level").parquet(path)
    return spark.read.parquet(path).withColumn("level", F.col("level").cast("int"))


def merged_hour_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles by hour, merged from stored sketches by hour and month; are their ranks within the stated error?"""
    path, trips_ = scratch.run_dir(spark, "sketches"), cleaned(spark, sf_dir)
    stats.quantile_sketches(trips_, ["pickup_hour", "pickup_month"], "trip_duration").write.parquet(path)
    merged = stats.merged_quartiles(spark.read.parquet(path), ["pickup_hour"])
    ranked = trips_.select("pickup_hour", "trip_duration").join(F.broadcast(merged), "pickup_hour")  # 24 rows
    checks = []
    for q, name in zip(profile.QUARTILES, ("q1", "median", "q3"), strict=True):
        below, upto = (F.avg((F.col("trip_duration") < F.col(name)).cast("double")), F.avg((F.col("trip_duration") <= F.col(name)).cast("double")))
        checks.append(((below - stats.SKETCH_ERROR <= q) & (upto + stats.SKETCH_ERROR >= q)).alias(f"{name}_within"))
    return ranked.groupBy("pickup_hour", "n").agg(*checks)


def clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.run_dir(spark, "clean-csv")
    sinks.export_csv(cleaned(spark, sf_dir), path)
    return rounded(sinks.read_clean_csv(spark, path))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.run_dir(spark, "trips-csv")
    sinks.export_csv(raw(spark, sf_dir), path)
    return rounded(trips.read_trips_csv(spark, path))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.run_dir(spark, "trips-csv")
    sinks.export_csv(raw(spark, sf_dir), path)
    return rounded(trips.read_trips_csv(spark, path, infer=True).select(*S.TRIP_COLUMNS))


def _number() -> Column:
    return F.substring("id", 3, 20).cast("long")


def _broken_csv(spark: SparkSession, sf_dir: str) -> str:
    """A CSV with broken cells and its columns in another order."""
    exported, broken = scratch.run_dir(spark, "trips-csv"), scratch.run_dir(spark, "trips-broken")
    sinks.export_csv(raw(spark, sf_dir), exported)
    text = spark.read.option("header", True).csv(exported)
    text = text.withColumns(
        {
            "vendor_id": F.when(_number() % 61 == 0, "two").otherwise(F.col("vendor_id")),
            "pickup_datetime": F.when(_number() % 67 == 0, "03/14/2016 17:24").otherwise(F.col("pickup_datetime")),
        }
    )
    text.select(*reversed(text.columns)).write.option("header", True).csv(broken)
    return broken


def csv_scan_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows of a broken CSV, and how many were rejected."""
    found = explore.ingest_csv(spark, _broken_csv(spark, sf_dir), scratch.run_dir(spark, "trips"))
    return rounded(found.trips.withColumn("rejected", F.lit(found.malformed.count())))


def csv_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel of a broken CSV, counted while it is written as a table."""
    return explore.ingest_csv(spark, _broken_csv(spark, sf_dir), scratch.run_dir(spark, "trips")).funnel


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose parts have their columns in three orders, one with a column more, and one broken part."""
    path, trips_ = scratch.run_dir(spark, "trips-mixed"), raw(spark, sf_dir)
    for i in range(3):
        part = trips_.filter(_number() % 3 == i)
        columns = part.columns if i == 0 else part.columns[::-1] if i == 1 else [*part.columns[5:], *part.columns[:5]]
        part = part.select(*columns).select("*", *([F.lit("x").alias("note")] if i == 2 else []))
        broken = F.when(_number() % 71 == 0, "soon").otherwise(F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        part = part.withColumn("pickup_datetime", broken) if i == 1 else part
        sinks.export_csv(part, f"{path}/part={i}")
    found = explore.ingest_csv(spark, f"{path}/*", scratch.run_dir(spark, "trips"))
    return rounded(found.trips.withColumn("rejected", F.lit(found.malformed.count())))


def split_with_null_ids(df: DataFrame) -> DataFrame:
    """Rows of the two sides and the folds, where some trips have lost their id."""
    lost = df.withColumn("id", F.when(_number() % 50 != 1, F.col("id")))
    sides = [side.withColumn("in_training", F.lit(i)) for side, i in zip(split.hash_split(lost), (1, 0), strict=True)]
    return sides[0].union(sides[1]).groupBy("in_training", split.fold_of().alias("fold")).agg(F.count("*").alias("rows"))


def nullable_group_profile(df: DataFrame) -> DataFrame:
    hours = df.select(calendar.pickup_hour("pickup_datetime").alias("pickup_hour"), F.col("passenger_count").alias("seats"))
    return stats.exact_group_profile(hours, "pickup_hour", "seats")


def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with date and time apart, as a form sends them."""
    ts = "pickup_datetime"
    split_time = requests(spark, sf_dir).withColumns(
        {"pickup_date": calendar.date_text(ts), "pickup_time": calendar.time_text(ts)}
    )
    checked = validate.validate_requests(serve.combine_pickup(split_time))
    return checked.select(
        "id",
        calendar.timestamp_text("pickup_datetime").alias("pickup_text"),
        F.col("accepted").cast("int").alias("accepted"),
        F.concat_ws(",", "reasons").alias("reasons"),
    )


def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejection_counts(validate.validate_requests(requests(spark, sf_dir)))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = serve.rejected_requests(requests(spark, sf_dir))
    return rejected.select("id", F.concat_ws(",", "reasons").alias("reasons"))


def time_parts(df: DataFrame) -> DataFrame:
    ts = "pickup_datetime"
    return df.select(
        "id",
        calendar.pickup_hour(ts).alias("pickup_hour"),
        calendar.pickup_weekday(ts).alias("pickup_weekday"),
        calendar.pickup_month(ts).alias("pickup_month"),
        calendar.iso_weekday(ts).alias("iso_weekday"),
        calendar.is_weekend(ts).alias("is_weekend"),
        calendar.is_peak(calendar.pickup_hour(ts)).alias("is_peak"),
        calendar.is_peak(calendar.pickup_hour(ts), calendar.FACTOR_PEAK_HOURS).alias("is_peak_factor"),
    )


def serving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = features.add_serving_features(requests(spark, sf_dir), null_distance_as_zero=True)
    return rounded(
        made.select(
            "id",
            "pickup_hour",
            "pickup_weekday",
            "pickup_month",
            "is_peak",
            "distance_km",
            "airport_trip",
            "distance_peak",
            "store_and_fwd_flag_num",
        )
    )


def weekend_share(df: DataFrame) -> DataFrame:
    return stats.share(df.select(calendar.is_weekend("pickup_datetime").alias("is_weekend")), "is_weekend")


def scored(df: DataFrame) -> DataFrame:
    return df.select(*score.SCORED_COLUMNS)


def stream_score_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the events as a file stream and return what the sink holds."""
    stream = trips.requests_from_trips(trips.trips_from_events(trips.stream_events(spark, sf_dir)))
    out = scratch.run_dir(spark, "stream-out")
    stream_score.start_scoring(stream, out, scratch.run_dir(spark, "stream-log")).awaitTermination()
    return rounded(scored(spark.read.parquet(out)))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = trips.requests_from_trips(trips.trips_from_events(trips.stream_events(spark, sf_dir)))
    out = scratch.run_dir(spark, "stream-out")
    stream_score.start_quarantine(stream, out, scratch.run_dir(spark, "stream-log")).awaitTermination()
    return spark.read.parquet(out).select("id", F.concat_ws(",", "reasons").alias("reasons"))


def stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one query that validates each request once leaves in its two sinks."""
    stream = trips.requests_from_trips(trips.trips_from_events(trips.stream_events(spark, sf_dir)))
    out, rejected = scratch.run_dir(spark, "stream-out"), scratch.run_dir(spark, "stream-rejected")
    stream_score.start_serving(stream, out, rejected, scratch.run_dir(spark, "stream-log")).awaitTermination()
    good = spark.read.parquet(out).select("id", F.lit("").alias("reasons"), "duration_seconds")
    bad = spark.read.parquet(rejected).select("id", F.concat_ws(",", "reasons").alias("reasons"), F.lit(None).cast("double"))
    return rounded(good.union(bad))


def score_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is not there: the additive rule scores and says so."""
    model = model_store.load_model(scratch.run_dir(spark, "no-model"))
    return rounded(serve.score_requests(requests(spark, sf_dir), model))


def train_test_split(df: DataFrame) -> DataFrame:
    return df.select("id", split.in_training().cast("int").alias("in_training"), split.fold_of().alias("fold"))


def split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split.hash_split(M.model_frame(cleaned(spark, sf_dir)))


def vendor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = M.model_frame(cleaned(spark, sf_dir))
    indexed = M.vendor_indexer().fit(df).transform(df)
    return indexed.groupBy("vendor_id", F.col("vendor_idx").cast("int").alias("vendor_idx")).agg(
        F.count("*").alias("trips")
    )


def hour_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 values by frequency: the index that clusters get as well."""
    df = M.model_frame(cleaned(spark, sf_dir))
    indexed = M.indexer({"pickup_hour": "hour_idx"}).fit(df).transform(df)
    return indexed.groupBy("pickup_hour", F.col("hour_idx").cast("int").alias("hour_idx")).agg(F.count("*").alias("trips"))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine base features of the test rows, scaled by the training rows."""
    train_rows, test_rows = split_rows(spark, sf_dir)

    fitted = Pipeline(stages=M.feature_stages(M.BASELINE)).fit(train_rows)
    values = vector_to_array(F.col(f"{M.BASELINE.prefix}_scaled"))
    out = fitted.transform(test_rows).select("id", values.alias("v"))
    return rounded(out.select("id", *[F.col("v")[i].alias(name) for i, name in enumerate(S.BASE_9)]))


POLY_INPUTS = ("distance_km", "pickup_hour", "passenger_count")
POLY_TERMS = ("x", "xx", "y", "xy", "yy", "z", "xz", "yz", "zz")


def poly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree-2 terms of three scaled features."""

    variant = M.Variant("poly", POLY_INPUTS, degree=2)
    train_rows, test_rows = split_rows(spark, sf_dir)
    stages = [*M.feature_stages(variant), M.expansion(variant)]
    fitted = Pipeline(stages=stages).fit(train_rows)
    out = fitted.transform(test_rows).select("id", vector_to_array(F.col("poly_features")).alias("v"))
    return rounded(out.select("id", *[F.col("v")[i].alias(name) for i, name in enumerate(POLY_TERMS)]))


def _one_feature_fit(spark: SparkSession, sf_dir: str, reg_param: float) -> DataFrame:
    """Regression of the log label on distance; coefficients and test metrics in one row."""
    train_rows, test_rows = split_rows(spark, sf_dir)
    vector = M.assembler(["distance_km"], "distance_vector")
    lr = LinearRegression(
        featuresCol="distance_vector", labelCol=S.LABEL, predictionCol="fit", maxIter=50, regParam=reg_param
    )
    fitted = lr.fit(vector.transform(train_rows))
    predicted = fitted.transform(vector.transform(test_rows))
    row = metrics.regression_metrics(predicted, {"distance": "fit"})
    return rounded(
        row.select(
            "model",
            F.lit(float(fitted.coefficients[0])).alias("slope"),
            F.lit(float(fitted.intercept)).alias("intercept"),
            "rows",
            *metrics.METRICS,
        )
    )


def ols_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_feature_fit(spark, sf_dir, 0.0)


def ridge_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_feature_fit(spark, sf_dir, 0.1)


def with_rule_prediction(df: DataFrame) -> DataFrame:
    """Cleaned trips with the additive rule's log prediction."""
    return df.withColumn("prediction", F.log1p(score.additive_seconds()))


def rule_metrics(df: DataFrame) -> DataFrame:
    return metrics.regression_metrics(with_rule_prediction(df), {"additive": "prediction"})


def residuals_by_hour(df: DataFrame) -> DataFrame:
    return stats.group_profile(metrics.residuals(with_rule_prediction(df)), "pickup_hour", "residual_sec")


def variant_metrics(variant: M.Variant) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, predictions = train.fit_and_predict(cleaned(spark, sf_dir), [variant])
        return rounded(metrics.regression_metrics(predictions, {variant.name: variant.prediction}))

    return run


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with the plain variants' predictions in seconds."""
    _, predictions = train.fit_and_predict(cleaned(spark, sf_dir), train.PLAIN_VARIANTS)
    return rounded(
        predictions.select("id", *[F.expm1(v.prediction).alias(f"{v.prefix}_seconds") for v in train.PLAIN_VARIANTS]),
        FITTED_PLACES,
    )


def plain_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three untuned variants, evaluated together."""
    _, predictions = train.fit_and_predict(cleaned(spark, sf_dir), train.PLAIN_VARIANTS)
    return rounded(metrics.regression_metrics(predictions, {v.name: v.prediction for v in train.PLAIN_VARIANTS}))


def best_plain_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_model(plain_comparison(spark, sf_dir))


def model_residuals_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, predictions = train.fit_and_predict(cleaned(spark, sf_dir), [M.BASELINE])
    left = metrics.residuals(predictions, M.BASELINE.prediction)
    return rounded(stats.group_profile(left, "pickup_hour", "residual_sec"), FITTED_PLACES)


def pickup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, _ = split_rows(spark, sf_dir)
    return rounded(M.cluster_table(train_rows, M.fit_clusters(train_rows)))


def _tuned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, tuning.Tuned]:
    train_rows, test_rows = split_rows(spark, sf_dir)
    return train_rows, test_rows, train.tune_optimized(train_rows)


def model_optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test_rows, tuned = _tuned(spark, sf_dir)
    row = metrics.regression_metrics(
        M.predict_variants(test_rows, {M.OPTIMIZED.name: tuned.model}, [M.OPTIMIZED]),
        {M.OPTIMIZED.name: M.OPTIMIZED.prediction},
    )
    return rounded(
        row.withColumns(
            {"reg_param": F.lit(tuned.variant.reg_param), "elastic_net": F.lit(tuned.variant.elastic_net)}
        ),
        FITTED_PLACES,
    )


def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, _, tuned = _tuned(spark, sf_dir)
    return rounded(tuning.score_table(train_rows, tuned), FITTED_PLACES)


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(train.compare(cleaned(spark, sf_dir)).table(), FITTED_PLACES)


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.best_model(train.compare(cleaned(spark, sf_dir)).table()), FITTED_PLACES)


ELASTIC = replace(M.BASELINE, name="Elastic", reg_param=0.05, elastic_net=0.3)


def elastic_net_base9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of an elastic net, on the scale of the features."""
    train_rows, _ = split_rows(spark, sf_dir)
    fitted = M.fit_variants(train_rows, [ELASTIC])[ELASTIC.name]
    scale, line = fitted.stages[-2], fitted.stages[-1]
    slopes = [float(c / s) for c, s in zip(line.coefficients, scale.std, strict=True)]
    level = float(line.intercept - sum(b * m for b, m in zip(slopes, scale.mean, strict=True)))
    rows = [*zip(S.BASE_9, slopes, strict=True), ("(intercept)", level)]
    return rounded(spark.createDataFrame(rows, "feature string, coefficient double"), FITTED_PLACES)


def _tuned_base9(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuning.Tuned]:
    train_rows, _ = split_rows(spark, sf_dir)
    return train_rows, tuning.cross_validate(train_rows, M.BASELINE)


def grid_scores_base9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean held-out error of each grid point, for the model without clusters."""
    return rounded(tuning.score_table(*_tuned_base9(spark, sf_dir)), FITTED_PLACES)


def best_grid_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tuned = _tuned_base9(spark, sf_dir)
    rows = [(tuned.variant.reg_param, tuned.variant.elastic_net)]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double")


def score_report_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail report over model scores."""
    return score.score_report(score.score_or_fall_back(featured(spark, sf_dir), _saved_baseline(spark, sf_dir)))


def _saved_baseline(spark: SparkSession, sf_dir: str):
    train_rows, _ = split_rows(spark, sf_dir)
    fitted = M.fit_variants(train_rows, [M.BASELINE])[M.BASELINE.name]
    path = scratch.run_dir(spark, "model")
    model_store.save_model(fitted, path)
    return model_store.load_model(path)


def model_roundtrip_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save, load, then score the accepted requests."""
    scores = serve.score_requests(requests(spark, sf_dir), _saved_baseline(spark, sf_dir))
    return rounded(scores, FITTED_PLACES)


def stream_score_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded model on a file stream."""
    stream = trips.requests_from_trips(trips.trips_from_events(trips.stream_events(spark, sf_dir)))
    out = scratch.run_dir(spark, "stream-out")
    model = _saved_baseline(spark, sf_dir)
    stream_score.start_scoring(stream, out, scratch.run_dir(spark, "stream-log"), model).awaitTermination()
    return rounded(spark.read.parquet(out).select(*score.SCORED_COLUMNS, "scorer"), FITTED_PLACES)


def prediction_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % bounds around the baseline, from its error on the test rows."""
    train_rows, test_rows = split_rows(spark, sf_dir)
    fitted = M.fit_variants(train_rows, [M.BASELINE])
    tested = M.predict_variants(test_rows, fitted, [M.BASELINE])
    error = metrics.regression_metrics(tested, {M.BASELINE.name: M.BASELINE.prediction}).first()["rmse_log"]
    out = score.prediction_interval(score.score_model(featured(spark, sf_dir), fitted[M.BASELINE.name]), error)
    return rounded(out.select("id", "duration_seconds", "seconds_low", "seconds_high"), FITTED_PLACES)


def noisy_score(df: DataFrame) -> DataFrame:
    return score.score_factors(df, noise_scale=0.05).select("id", "duration_seconds", "duration_minutes")


def hour_duration_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.exact_group_profile(cleaned(spark, sf_dir), "pickup_hour", "trip_duration"))


def frequency_query(column: str) -> Query:
    return on_clean(lambda df: stats.frequency(df, column))


BOX = clean.CleanRules()

QUERIES: dict[str, Query] = {
    "trips_raw": on_raw(lambda df: df),
    "schema_listing": on_raw(profile.schema_listing),
    "table_shape": on_raw(profile.table_shape),
    "preview_first_n": on_raw(profile.preview),
    "missing_profile": on_raw(profile.missing_profile),
    "numeric_describe": on_raw(lambda df: profile.describe_numeric(df, ["vendor_id", *S.NUMERIC_COLUMNS])),
    "string_describe": on_raw(lambda df: profile.describe_strings(df, ["id", "store_and_fwd_flag"])),
    "duration_summary": on_raw(lambda df: profile.value_summary(placed(df), "trip_duration")),
    "log_duration_summary": on_clean(lambda df: profile.value_summary(df, "log_duration")),
    "freq_vendor": on_raw(lambda df: stats.frequency(df, "vendor_id")),
    "freq_flag": on_raw(lambda df: stats.frequency(df, "store_and_fwd_flag")),
    "freq_flag_num": frequency_query("store_and_fwd_flag_num"),
    "freq_passenger": on_raw(lambda df: stats.frequency(df, "passenger_count")),
    "freq_hour": frequency_query("pickup_hour"),
    "freq_weekday": frequency_query("pickup_weekday"),
    "freq_month": frequency_query("pickup_month"),
    "freq_peak": frequency_query("is_peak"),
    "frequency_tables": on_clean(lambda df: stats.frequency_tables(df, S.CATEGORY_COLUMNS)),
    "vendor_share": on_raw(lambda df: stats.share(df, "vendor_id")),
    "vendor_avg_duration": on_raw(lambda df: stats.group_mean(df, "vendor_id", "trip_duration", "avg_duration")),
    "coordinates": on_raw(lambda df: stats.coordinates(clean.filter_passengers(df))),
    "cleaning_funnel": on_raw(clean.cleaning_funnel),
    "clean_trips": on_clean(lambda df: df),
    "time_parts": on_raw(time_parts),
    "is_weekend_share": on_clean(weekend_share),
    "hour_duration_profile": hour_duration_profile,
    "hour_duration_profile_sketch": on_clean(lambda df: stats.group_profile(df, "pickup_hour", "trip_duration")),
    "hour_quartiles": on_clean(lambda df: stats.exact_group_quartiles(df, "pickup_hour", "trip_duration")),
    "corr_matrix": on_clean(lambda df: stats.correlation_matrix(df, S.CORRELATION_COLUMNS)),
    "corr_strong_pairs": on_clean(lambda df: stats.strong_pairs(stats.correlation_pairs(df, S.CORRELATION_COLUMNS))),
    "binned_log_duration": on_clean(lambda df: stats.binned_mean(df, "distance_km", "log_duration")),
    "hist_duration": on_raw(lambda df: stats.histogram_fixed(placed(df), "trip_duration", BINS, 0, 3600)),
    "hist_log_duration": on_clean(lambda df: stats.histogram_range(df, "log_duration", BINS)),
    "density_positions": on_raw(
        lambda df: stats.coordinate_grid(clean.filter_passengers(df), explore.GRID_DEGREES)
    ),
    "density_pickup": on_raw(
        lambda df: stats.density_grid(
            clean.filter_passengers(df), "pickup_longitude", "pickup_latitude", 0.01, 0.01, BOX.lon_range, BOX.lat_range
        )
    ),
    "density_dropoff": on_raw(
        lambda df: stats.density_grid(
            clean.filter_passengers(df), "dropoff_longitude", "dropoff_latitude", 0.01, 0.01, BOX.lon_range, BOX.lat_range
        )
    ),
    "density_distance_duration": on_clean(
        lambda df: stats.density_grid(df, "distance_km", "trip_duration", 1.0, 60.0, y_range=(0, 7200))
    ),
    "clean_sink_roundtrip": clean_sink_roundtrip,
    "clean_csv_roundtrip": clean_csv_roundtrip,
    "clean_month_rerun": clean_month_rerun,
    "density_zoom": density_zoom,
    "merged_hour_quartiles": merged_hour_quartiles,
    "stream_serving": stream_serving,
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_scan_malformed": csv_scan_malformed,
    "csv_funnel": csv_funnel,
    "csv_mixed_headers": csv_mixed_headers,
    "nullable_group_profile": on_raw(nullable_group_profile),
    "split_with_null_ids": on_clean(split_with_null_ids),
    "hour_index": hour_index,
    "elastic_net_base9": elastic_net_base9,
    "grid_scores_base9": grid_scores_base9,
    "best_grid_point": best_grid_point,
    "score_report_model": score_report_model,
    "request_validation": request_validation,
    "rejection_reasons": rejection_reasons,
    "quarantine": quarantine,
    "serving_features": serving_features,
    "score_rules_factors": on_featured(lambda df: scored(score.score_factors(df))),
    "score_rules_additive": on_featured(lambda df: scored(score.score_additive(df))),
    "noisy_score": on_featured(noisy_score),
    "score_report_long": on_featured(lambda df: score.score_report(score.score_or_fall_back(df, None))),
    "score_fallback": score_fallback,
    "stream_score_rules": stream_score_rules,
    "stream_quarantine": stream_quarantine,
    "train_test_split": on_clean(train_test_split),
    "vendor_index": vendor_index,
    "scaled_features": scaled_features,
    "poly_features": poly_features,
    "ols_distance": ols_distance,
    "ridge_distance": ridge_distance,
    "rule_metrics": on_clean(rule_metrics),
    "residuals_by_hour": on_clean(residuals_by_hour),
    "model_base7": variant_metrics(M.BASELINE_7),
    "model_base9": variant_metrics(M.BASELINE),
    "model_interaction": variant_metrics(M.INTERACTION),
    "model_predictions": model_predictions,
    "plain_model_comparison": plain_comparison,
    "best_plain_model": best_plain_model,
    "model_residuals_by_hour": model_residuals_by_hour,
    "pickup_clusters": pickup_clusters,
    "model_optimized": model_optimized,
    "grid_scores": grid_scores,
    "model_comparison": model_comparison,
    "best_model": best_model,
    "model_roundtrip_score": model_roundtrip_score,
    "stream_score_model": stream_score_model,
    "prediction_interval": prediction_interval,
}
