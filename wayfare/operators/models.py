"""Model frames and pipeline factories for trip-duration regression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    PolynomialExpansion,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.operators import clusters, moments

#: Small fits in flight; changes no result.
PARALLELISM = 8

# What any variant may read; keeps training and scoring scans narrow.
MODEL_COLUMNS = [
    "id",
    "vendor_id",
    "distance_km",
    "pickup_hour",
    "passenger_count",
    "is_peak",
    "airport_trip",
    "store_and_fwd_flag_num",
    "pickup_weekday",
    "pickup_month",
    "distance_peak",
    "pickup_longitude",
    "pickup_latitude",
    S.LABEL,
]


@dataclass(frozen=True)
class Variant:
    """One model: its feature set and regression settings."""

    name: str
    features: tuple[str, ...]
    degree: int = 1
    max_iter: int = 50
    reg_param: float = 0.1
    elastic_net: float = 0.0

    @property
    def prefix(self) -> str:
        return "".join(ch if ch.isalnum() else "_" for ch in self.name.lower())

    @property
    def prediction(self) -> str:
        return f"{self.prefix}_prediction"

    @property
    def clustered(self) -> bool:
        return "cluster_idx" in self.features


# Model names and settings.
BASELINE_7 = Variant("Baseline-7", S.BASE_7)
BASELINE = Variant("Baseline", S.BASE_9)
INTERACTION = Variant("+Interaction", S.INTERACTION_10)
OPTIMIZED = Variant("Optimized", S.CLUSTER_10, degree=2, max_iter=100)


def model_frame(clean: DataFrame) -> DataFrame:
    """Only the columns models read; a missing flag counts as 'N'."""
    return clean.select(*MODEL_COLUMNS).withColumn(
        "store_and_fwd_flag_num", F.coalesce("store_and_fwd_flag_num", F.lit(0))
    )


def indexer(columns: dict[str, str]) -> StringIndexer:
    """Most frequent value first; unseen values and NULL share one extra index.
    All columns are counted in the same pass."""
    return StringIndexer(inputCols=list(columns), outputCols=list(columns.values()), handleInvalid="keep")


def vendor_indexer() -> StringIndexer:
    return indexer({"vendor_id": "vendor_idx"})


def cluster_indexer() -> StringIndexer:
    return indexer({"pickup_cluster": "cluster_idx"})


def assembler(inputs: tuple[str, ...] | list[str], out: str, handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid=handle_invalid)


def scaler(inp: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def index_stage(variants: list[Variant]) -> StringIndexer:
    clusters = {"pickup_cluster": "cluster_idx"} if any(v.clustered for v in variants) else {}
    return indexer({"vendor_id": "vendor_idx"} | clusters)


def scale_stages(variant: Variant) -> list[Estimator | Transformer]:
    p = variant.prefix
    return [assembler(variant.features, f"{p}_raw"), scaler(f"{p}_raw", f"{p}_scaled")]


def feature_stages(variant: Variant) -> list[Estimator | Transformer]:
    """Index, assemble and scale."""
    return [index_stage([variant]), *scale_stages(variant)]


def expansion(variant: Variant) -> PolynomialExpansion:
    p = variant.prefix
    return PolynomialExpansion(degree=variant.degree, inputCol=f"{p}_scaled", outputCol=f"{p}_features")


def expand_stages(variant: Variant) -> list[Estimator | Transformer]:
    return [expansion(variant)] if variant.degree > 1 else []


def vector_stages(variant: Variant) -> list[Estimator | Transformer]:
    """Everything before the regression."""
    return [*feature_stages(variant), *expand_stages(variant)]


def regression(variant: Variant) -> LinearRegression:
    """Least squares on the normal equations: with these feature counts one pass
    collects the moments, and iterations happen on that small matrix."""
    p = variant.prefix
    return LinearRegression(
        featuresCol=f"{p}_features" if variant.degree > 1 else f"{p}_scaled",
        labelCol=S.LABEL,
        predictionCol=variant.prediction,
        maxIter=variant.max_iter,
        regParam=variant.reg_param,
        elasticNetParam=variant.elastic_net,
    )


def fit_clusters(df: DataFrame, k: int = 10, rounds: int = clusters.ROUNDS) -> list[Transformer]:
    """The stage that gives a pickup position the nearest of ``k`` centres as ``pickup_cluster``."""
    return [clusters.cluster_stage(clusters.fit_centres(df, k, rounds))]


def cluster_table(df: DataFrame, stages: list[Transformer]) -> DataFrame:
    """Cluster, its frequency index, size and mean position."""
    for stage in stages:
        df = stage.transform(df)
    indexed = cluster_indexer().fit(df).transform(df)
    return (
        indexed.groupBy("pickup_cluster", F.col("cluster_idx").cast("int").alias("cluster_idx"))
        .agg(
            F.count("*").alias("trips"),
            F.avg("pickup_longitude").alias("mean_longitude"),
            F.avg("pickup_latitude").alias("mean_latitude"),
        )
        .orderBy("pickup_cluster")
    )


def fitted_scaler(variant: Variant, mean: np.ndarray, spread: np.ndarray, spark: SparkSession) -> StandardScalerModel:
    """Spark's scaler, fitted on two rows that have this mean and sample spread."""
    half = spread / np.sqrt(2)
    rows = spark.createDataFrame([(Vectors.dense(v),) for v in (mean - half, mean + half)], [f"{variant.prefix}_raw"])
    return scaler(f"{variant.prefix}_raw", f"{variant.prefix}_scaled").fit(rows.coalesce(1))


def fitted_index(features: tuple[str, ...], labels: dict[str, list[str]]) -> StringIndexerModel:
    """Spark's indexer with these labels; other values and NULL get the extra index."""
    names = [f for f in features if f in labels]
    inputs = [moments.CATEGORY_OF[f] for f in names]
    return StringIndexerModel.from_arrays_of_labels([labels[f] for f in names], inputs, names, handleInvalid="keep")


def fit_from_moments(variant: Variant, sums: moments.Moments, spark: SparkSession) -> list[Transformer]:
    """Fitted stages of a variant: index, assemble, scale, expand, regress. No pass over the training rows."""
    labels = {f: sums.labels(f) for f in variant.features if f in moments.CATEGORY_OF}
    mean, spread = sums.scale(variant.features, labels)
    line = regression(variant).setWeightCol("trips")
    rows = moments.moment_rows(sums.gram(variant.features, variant.degree, labels, mean, spread))
    scale, fitted = at_once(
        spark,
        lambda: fitted_scaler(variant, mean, spread, spark),
        lambda: line.fit(rows.table(spark, line.getFeaturesCol())),
    )
    index = [fitted_index(variant.features, labels)] if labels else []
    return [*index, scale_stages(variant)[0], scale, *expand_stages(variant), fitted]


def at_once(spark: SparkSession, *tasks: Callable[[], object]) -> list:
    """What the tasks return; each is a small job whose time is mostly set-up, so up to ``PARALLELISM`` are in flight."""
    call = inheritable_thread_target(spark)(lambda task: task())
    with ThreadPool(max(1, min(PARALLELISM, len(tasks)))) as pool:
        return pool.map(call, tasks, chunksize=1)


def collect_variants(train: DataFrame, variants: list[Variant], fold: str | None = None) -> moments.Moments:
    """What any of the variants needs to know of the training rows, from one pass."""
    features = [f for v in variants for f in v.features]
    return moments.collect_moments(train, features, max(v.degree for v in variants), fold)


def fit_variants(train: DataFrame, variants: list[Variant], clusters_k: int = 10) -> dict[str, PipelineModel]:
    """Fit every variant from sums of products that one pass over the training rows collects for all of them.

    A clustered variant gets the position stage that turns a raw pickup position into ``pickup_cluster``
    in front, so its model scores raw requests; its centres need passes of their own.
    """
    head = fit_clusters(train, clusters_k) if any(v.clustered for v in variants) else []
    sums = collect_variants(PipelineModel(stages=head).transform(train) if head else train, variants)
    fitted = fit_all(variants, sums, train.sparkSession)
    return {
        v.name: PipelineModel(stages=[*(head if v.clustered else []), *stages]) for v, stages in zip(variants, fitted, strict=True)
    }


def fit_all(variants: list[Variant], sums: moments.Moments, spark: SparkSession) -> list[list[Transformer]]:
    """``fit_from_moments`` of every variant."""
    return at_once(spark, *(partial(fit_from_moments, v, sums, spark) for v in variants))


def predict_variants(df: DataFrame, models: dict[str, PipelineModel], variants: list[Variant]) -> DataFrame:
    """Add each variant's prediction column; helper columns are dropped on the way."""
    keep = list(df.columns)
    for v in variants:
        keep.append(v.prediction)
        df = models[v.name].transform(df).select(*keep)
    return df
