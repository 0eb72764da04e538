"""Rule scorers, model scoring and the scored-trip reports.

Scorers take requests with serving features and work on a batch or a stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.functions import calendar, trip
from wayfare.functions.hashing import hash_uniform

SCORED_COLUMNS = [
    "id",
    "pickup_hour",
    "pickup_weekday",
    "pickup_month",
    "is_peak",
    "distance_km",
    "airport_trip",
    "distance_peak",
    "store_and_fwd_flag_num",
    "duration_seconds",
    "duration_minutes",
    "avg_speed",
    "log_prediction",
    "band",
]


def noise_factor(key: str = "id", scale: float = 0.05, salt: str = "") -> Column:
    """Multiplier in [1 - scale, 1 + scale), the same for a key on every run."""
    return F.lit(1.0) + (hash_uniform(key, block=2, salt=salt) * F.lit(2.0) - F.lit(1.0)) * F.lit(float(scale))


# The rule scorers' numbers, in seconds and as factors.
FACTOR_BASE, FACTOR_PER_KM, FACTOR_PEAK, FACTOR_OFF_PEAK = 200.0, 40.0, 1.4, 0.8
FACTOR_PER_SEAT, FACTOR_VENDOR_2, FACTOR_STORED = 0.03, 1.02, 1.08
ADDITIVE_BASE, ADDITIVE_PER_KM, ADDITIVE_PEAK, ADDITIVE_AIRPORT = 300.0, 60.0, 180.0, 600.0


def factor_seconds(hours: Iterable[int] = calendar.FACTOR_PEAK_HOURS) -> Column:
    """Distance line scaled by peak, passenger, vendor and flag factors."""
    peak = F.when(F.col("pickup_hour").isin(*hours), F.lit(FACTOR_PEAK)).otherwise(F.lit(FACTOR_OFF_PEAK))
    seats = F.lit(1.0) + (F.col("passenger_count") - 1) * F.lit(FACTOR_PER_SEAT)
    vendor = F.when(F.col("vendor_id") == 2, F.lit(FACTOR_VENDOR_2)).otherwise(F.lit(1.0))
    stored = F.when(F.col("store_and_fwd_flag") == "Y", F.lit(FACTOR_STORED)).otherwise(F.lit(1.0))
    return (F.lit(FACTOR_BASE) + F.col("distance_km") * F.lit(FACTOR_PER_KM)) * peak * seats * vendor * stored


def additive_seconds() -> Column:
    """Distance line plus fixed peak and airport seconds."""
    peak = F.when(F.col("is_peak") == 1, F.lit(ADDITIVE_PEAK)).otherwise(F.lit(0.0))
    airport = F.when(F.col("airport_trip") == 1, F.lit(ADDITIVE_AIRPORT)).otherwise(F.lit(0.0))
    return F.lit(ADDITIVE_BASE) + F.col("distance_km") * F.lit(ADDITIVE_PER_KM) + peak + airport


def add_outputs(df: DataFrame) -> DataFrame:
    """Minutes, speed, log prediction and band of ``duration_seconds``."""
    return df.withColumns(
        {
            "duration_minutes": trip.minutes("duration_seconds"),
            "avg_speed": trip.speed_kmh_or_zero("distance_km", "duration_seconds"),
            "log_prediction": trip.log_label("duration_seconds"),
            "band": trip.duration_band(trip.minutes("duration_seconds")),
        }
    )


def score_factors(
    featured: DataFrame, noise_scale: float = 0.0, hours: Iterable[int] = calendar.FACTOR_PEAK_HOURS
) -> DataFrame:
    seconds = factor_seconds(hours)
    if noise_scale:
        seconds = seconds * noise_factor(scale=noise_scale)
    return add_outputs(featured.withColumn("duration_seconds", seconds))


def score_additive(featured: DataFrame) -> DataFrame:
    return add_outputs(featured.withColumn("duration_seconds", additive_seconds()))


def prediction_column(model: PipelineModel) -> str:
    """Name of the prediction column of a fitted pipeline."""
    return model.stages[-1].getPredictionCol()


def score_model(featured: DataFrame, model: PipelineModel) -> DataFrame:
    """Apply a fitted pipeline whose prediction is in log space."""
    prediction = prediction_column(model)
    # Models are trained with a missing flag read as 'N'.
    filled = featured.withColumn("store_and_fwd_flag_num", F.coalesce("store_and_fwd_flag_num", F.lit(0)))
    predicted = model.transform(filled).select(*featured.columns, prediction)
    return add_outputs(predicted.withColumn("duration_seconds", trip.seconds_from_log(prediction)))


def score_or_fall_back(featured: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Model scores, or the additive rule when there is no model; ``scorer`` says which."""
    if model is None:
        return score_additive(featured).withColumn("scorer", F.lit("rules"))
    return score_model(featured, model).withColumn("scorer", F.lit("model"))


def prediction_interval(scored: DataFrame, rmse_log: float, z: float = 1.96) -> DataFrame:
    """Bounds in seconds of ``log_prediction`` ± z · rmse_log."""
    half = F.lit(z * rmse_log)
    return scored.withColumns(
        {
            "seconds_low": F.expm1(F.col("log_prediction") - half),
            "seconds_high": F.expm1(F.col("log_prediction") + half),
        }
    )


def score_report(scored: DataFrame, key: str = "id") -> DataFrame:
    """Ten (metric, value) text rows per scored trip; ``scorer`` says what made the score."""
    mode = F.when(F.col("scorer") == "model", "Live Model").otherwise("Demo Mode")
    # Metric names of the report.
    cells = [
        ("Processing Mode", mode),
        ("Input Features", F.lit(f"{len(S.REQUEST_COLUMNS)} columns")),
        ("Generated Features", F.lit(f"{len(S.SERVING_COLUMNS)} columns")),
        ("Log Prediction", trip.fixed_text("log_prediction", 4)),
        ("Duration (seconds)", trip.fixed_text("duration_seconds", 0)),
        ("Duration (minutes)", trip.fixed_text("duration_minutes", 1)),
        ("Distance (km)", trip.fixed_text("distance_km", 2)),
        ("Average Speed (km/h)", trip.fixed_text("avg_speed", 1)),
        ("Peak Hour Factor", trip.yes_no("is_peak")),
        ("Airport Trip Factor", trip.yes_no("airport_trip")),
    ]
    rows = [F.struct(F.lit(metric).alias("metric"), value.alias("value")) for metric, value in cells]
    return scored.select(key, F.inline(F.array(*rows)))
