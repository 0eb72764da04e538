"""Grid search with cross-validation over the regression settings."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession

from wayfare.operators import models as M
from wayfare.operators import moments
from wayfare.operators.split import fold_of

# The search grid.
REG_PARAMS = (0.01, 0.05, 0.1)
ELASTIC_NETS = (0.0, 0.3, 0.7)
FOLDS = 3


@dataclass(frozen=True)
class GridScore:
    reg_param: float
    elastic_net: float
    fold: int
    rmse: float


@dataclass
class Tuned:
    variant: M.Variant
    model: PipelineModel
    scores: list[GridScore]


def parameter_grid(
    lr: LinearRegression, reg_params: tuple[float, ...] = REG_PARAMS, elastic_nets: tuple[float, ...] = ELASTIC_NETS
) -> list[dict[Param, float]]:
    return (
        ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).addGrid(lr.elasticNetParam, list(elastic_nets)).build()
    )


def search(
    sums: moments.Moments,
    spark: SparkSession,
    variant: M.Variant,
    reg_params: tuple[float, ...] = REG_PARAMS,
    elastic_nets: tuple[float, ...] = ELASTIC_NETS,
) -> tuple[M.Variant, list[GridScore]]:
    """The variant with the settings of the least mean held-out error, and all errors, from the sums of each fold.

    A fold's fit sees the sums of all others: its indexes, its scales, its products. No pass over the rows.
    """
    lr = M.regression(variant)
    features, grid = lr.getFeaturesCol(), parameter_grid(lr, reg_params, elastic_nets)
    tests, tables = [], []
    for fold in sums.folds:
        fit, held_out = sums.part(lambda f, fold=fold: f != fold), sums.part(lambda f, fold=fold: f == fold)
        labels = {f: fit.labels(f) for f in variant.features if f in moments.CATEGORY_OF}
        scale = fit.scale(variant.features, labels)
        reduced, test = (moments.moment_rows(s.gram(variant.features, variant.degree, labels, *scale)) for s in (fit, held_out))
        tests.append(test)
        tables.append(reduced.table(spark, features).persist(StorageLevel.MEMORY_AND_DISK))
    weighted = lr.copy().setWeightCol("trips")
    try:
        tasks = [partial(weighted.fit, table, point) for table in tables for point in grid]
        fitted = M.at_once(spark, *tasks)
    finally:
        for table in tables:
            table.unpersist()
    places = [(fold, test, point) for fold, test in zip(sums.folds, tests, strict=True) for point in grid]
    scores = [
        GridScore(point[lr.regParam], point[lr.elasticNetParam], fold, test.rmse(model))
        for (fold, test, point), model in zip(places, fitted, strict=True)
    ]
    best = min(grid, key=lambda point: _mean_rmse(scores, point[lr.regParam], point[lr.elasticNetParam]))
    return replace(variant, reg_param=best[lr.regParam], elastic_net=best[lr.elasticNetParam]), scores


def tuned_from(
    sums: moments.Moments, spark: SparkSession, variant: M.Variant, clusters: list[Transformer] | None = None, **settings
) -> Tuned:
    """Search, then the fit of the chosen variant on all folds."""
    chosen, scores = search(sums, spark, variant, **settings)
    position_stages = list(clusters or []) if variant.clustered else []
    return Tuned(chosen, PipelineModel(stages=[*position_stages, *M.fit_from_moments(chosen, sums, spark)]), scores)


def with_folds(train: DataFrame, clusters: list[Transformer] | None, folds: int) -> DataFrame:
    """The rows with their cluster and their fold; folds come from the id's hash, so they survive any repartitioning."""
    for stage in clusters or []:
        train = stage.transform(train)
    return train.withColumn("fold", fold_of(folds=folds))


def cross_validate(
    train: DataFrame,
    variant: M.Variant = M.OPTIMIZED,
    clusters: list[Transformer] | None = None,
    folds: int = FOLDS,
    **settings,
) -> Tuned:
    """Choose ``reg_param`` and ``elastic_net`` by mean held-out RMSE, then refit on all of ``train``.

    Gives what ``CrossValidator`` gives over the whole pipeline with the same folds. That reads the training rows
    several times for every fold and grid point; here one pass collects the sums of products of every fold, and
    everything else is fitted on the few rows that carry such sums.
    """
    rows = with_folds(train, clusters if variant.clustered else None, folds)
    return tuned_from(M.collect_variants(rows, [variant], "fold"), train.sparkSession, variant, clusters, **settings)


def _mean_rmse(scores: list[GridScore], reg_param: float, elastic_net: float) -> float:
    values = [s.rmse for s in scores if (s.reg_param, s.elastic_net) == (reg_param, elastic_net)]
    return sum(values) / len(values)


def score_table(train: DataFrame, tuned: Tuned) -> DataFrame:
    """Mean held-out RMSE per grid point; as many rows as the grid has points."""
    points = sorted({(s.reg_param, s.elastic_net) for s in tuned.scores})
    rows = [(r, e, _mean_rmse(tuned.scores, r, e)) for r, e in points]
    return train.sparkSession.createDataFrame(rows, "reg_param double, elastic_net double, mean_rmse double")
