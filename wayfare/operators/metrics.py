"""Regression metrics in log and second space, residual profile, model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.schema import LABEL

METRICS = ("rmse_log", "rmse_sec", "rmsle", "mae_sec", "r2")


def _metric_struct(name: str, prediction: str, label: str) -> Column:
    y, p = F.col(label), F.col(prediction)
    y_sec, p_sec = F.expm1(y), F.expm1(p)
    error = y - p

    def root_mean_square(e: Column) -> Column:
        return F.sqrt(F.avg(e * e))

    return F.struct(
        F.lit(name).alias("model"),
        F.count(p).alias("rows"),
        root_mean_square(error).alias("rmse_log"),
        root_mean_square(y_sec - p_sec).alias("rmse_sec"),
        F.sqrt(F.avg(F.pow(F.log1p(p_sec) - F.log1p(y_sec), F.lit(2.0)))).alias("rmsle"),
        F.avg(F.abs(y_sec - p_sec)).alias("mae_sec"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def regression_metrics(df: DataFrame, predictions: dict[str, str], label: str = LABEL) -> DataFrame:
    """One row of metrics per model, all models from one pass.

    ``predictions`` maps a model's name to its prediction column (log space).
    """
    stats = df.agg(*[_metric_struct(name, column, label).alias(f"m{i}") for i, (name, column) in enumerate(predictions.items())])
    return stats.select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(predictions))])))


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the lowest RMSLE; ties go to the first name."""
    return comparison.orderBy("rmsle", "model").limit(1)


def residuals(df: DataFrame, prediction: str = "prediction", label: str = LABEL) -> DataFrame:
    """Add the residual in log space and in seconds."""
    return df.withColumns(
        {
            "residual_log": F.col(label) - F.col(prediction),
            "residual_sec": F.expm1(label) - F.expm1(prediction),
        }
    )
