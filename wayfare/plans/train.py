"""Train, compare and save the model variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from wayfare.operators import metrics, tuning
from wayfare.operators import models as M
from wayfare.operators.split import hash_split
from wayfare.sources.models import save_model

PLAIN_VARIANTS = [M.BASELINE_7, M.BASELINE, M.INTERACTION]
COMPARED = [M.BASELINE, M.INTERACTION, M.OPTIMIZED]


def fit_and_predict(clean: DataFrame, variants: list[M.Variant]) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit on the training rows; the test rows with every variant's prediction."""
    train, test = hash_split(M.model_frame(clean))
    fitted = M.fit_variants(train, variants)
    return fitted, M.predict_variants(test, fitted, variants)


def tune_optimized(train: DataFrame, **search) -> tuning.Tuned:
    """Position clusters from the training rows, then the grid search."""
    return tuning.cross_validate(train, M.OPTIMIZED, M.fit_clusters(train), **search)


@dataclass
class Comparison:
    models: dict[str, PipelineModel]
    predictions: DataFrame
    tuned: tuning.Tuned

    def table(self) -> DataFrame:
        """Metrics of every model from one pass over the test rows."""
        return metrics.regression_metrics(self.predictions, {v.name: v.prediction for v in COMPARED})

    def best(self) -> tuple[str, PipelineModel]:
        name = metrics.best_model(self.table()).first()["model"]
        return name, self.models[name]


def compare(clean: DataFrame, folds: int = tuning.FOLDS, **search) -> Comparison:
    """Baseline, +Interaction and the tuned model on one split.

    The training rows are read twice: for the positions, and for the sums of products from which all three
    models and the whole grid are fitted.
    """
    train, test = hash_split(M.model_frame(clean))
    spark, clusters = clean.sparkSession, M.fit_clusters(train)
    sums = M.collect_variants(tuning.with_folds(train, clusters, folds), COMPARED, "fold")
    plain = [M.BASELINE, M.INTERACTION]
    fitted = {v.name: PipelineModel(stages=stages) for v, stages in zip(plain, M.fit_all(plain, sums, spark), strict=True)}
    tuned = tuning.tuned_from(sums, spark, M.OPTIMIZED, clusters, **search)
    fitted[M.OPTIMIZED.name] = tuned.model
    return Comparison(fitted, M.predict_variants(test, fitted, COMPARED), tuned)


def train_and_save(clean: DataFrame, model_path: str, **search) -> tuple[str, DataFrame, Comparison]:
    """Compare the variants and save the best one; its name, the metrics (computed once, a row for each model) and
    what was compared."""
    comparison = compare(clean, **search)
    rows = comparison.table()
    table = clean.sparkSession.createDataFrame(rows.collect(), rows.schema)
    name = metrics.best_model(table).first()["model"]
    save_model(comparison.models[name], model_path)
    return name, table, comparison
