"""Score trip requests, in batch or on a stream, through one code path."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from wayfare.functions.calendar import pickup_timestamp
from wayfare.operators import score
from wayfare.operators.features import add_serving_features
from wayfare.operators.validate import RequestRules, accepted, quarantined, validate_requests


def combine_pickup(requests: DataFrame) -> DataFrame:
    """Requests that carry ``pickup_date`` and ``pickup_time`` get ``pickup_datetime``.

    A date or time that does not parse gives NULL, which validation rejects.
    """
    return requests.withColumn("pickup_datetime", pickup_timestamp("pickup_date", "pickup_time")).drop(
        "pickup_date", "pickup_time"
    )


def score_requests(
    requests: DataFrame, model: PipelineModel | None = None, rules: RequestRules = RequestRules()
) -> DataFrame:
    """Scored rows of the accepted requests."""
    return _scored(accepted(validate_requests(requests, rules)), model)


def _scored(good: DataFrame, model: PipelineModel | None) -> DataFrame:
    scored = score.score_or_fall_back(add_serving_features(good), model)
    return scored.select(*score.SCORED_COLUMNS, "scorer")


def rejected_requests(requests: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Requests that failed validation, unchanged, with their reasons."""
    return quarantined(validate_requests(requests, rules))


def write_scored(
    requests: DataFrame,
    out_path: str,
    rejected_path: str,
    model: PipelineModel | None = None,
    rules: RequestRules = RequestRules(),
) -> None:
    """Scored and rejected requests as two tables, both replaced; requests are read and validated once and held for both."""
    validated = validate_requests(requests, rules).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _scored(accepted(validated), model).write.mode("overwrite").parquet(out_path)
        quarantined(validated).write.mode("overwrite").parquet(rejected_path)
    finally:
        validated.unpersist()
