from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from wayfare import schema as S
from wayfare.operators import clusters as C
from wayfare.operators import metrics, moments, tuning
from wayfare.operators import models as M
from wayfare.operators.split import fold_of, hash_split
from wayfare.plans import serve, train
from wayfare.sources import models as store
from wayfare.sources import scratch
from wayfare.sources.trips import requests_from_trips


@pytest.fixture(scope="module")
def parts(cleaned):
    train_rows, test_rows = hash_split(M.model_frame(cleaned))
    return train_rows, test_rows


@pytest.fixture(scope="module")
def clusters(parts):
    return M.fit_clusters(parts[0])


@pytest.fixture(scope="module")
def tuned(parts, clusters):
    return tuning.cross_validate(parts[0], M.OPTIMIZED, clusters, reg_params=(0.01, 0.1), elastic_nets=(0.0, 0.7), folds=2)


def test_indexer_gives_unseen_vendors_the_extra_index(spark, parts):
    fitted = M.vendor_indexer().fit(parts[0])
    rows = fitted.transform(spark.createDataFrame([(1,), (2,), (9,), (None,)], "vendor_id int")).collect()
    assert sorted(r.vendor_idx for r in rows[:2]) == [0.0, 1.0]
    assert [r.vendor_idx for r in rows[2:]] == [2.0, 2.0]


def test_scaled_features_have_zero_mean_and_unit_spread(parts):
    fitted = Pipeline(stages=M.feature_stages(M.BASELINE)).fit(parts[0])
    rows = fitted.transform(parts[0]).select(vector_to_array(f"{M.BASELINE.prefix}_scaled")).collect()
    values = np.array([r[0] for r in rows])
    assert values.shape[1] == len(S.BASE_9)
    assert np.allclose(values.mean(axis=0), 0, atol=1e-9) and np.allclose(values.std(axis=0, ddof=1), 1)


@pytest.mark.parametrize(("features", "terms"), [(S.BASE_9, 54), (S.INTERACTION_10, 65)])
def test_expansion_sizes(parts, features, terms):
    variant = M.Variant("wide", features, degree=2)
    fitted = Pipeline(stages=[*M.feature_stages(variant), M.expansion(variant)]).fit(parts[0])
    assert fitted.transform(parts[0]).first()["wide_features"].size == terms


def test_assembler_refuses_or_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert M.assembler(["a", "b"], "v", "skip").transform(df).count() == 1
    with pytest.raises(Exception, match="(?i)null"):
        M.assembler(["a", "b"], "v").transform(df).collect()


def test_clusters_are_nearest_centres(parts, clusters):
    centres = C.fit_centres(parts[0])
    assert len(centres) == 10
    df = parts[0]
    for stage in clusters:
        df = stage.transform(df)
    pdf = df.select("pickup_longitude", "pickup_latitude", "pickup_cluster").toPandas()
    points = np.floor(pdf[["pickup_longitude", "pickup_latitude"]].to_numpy() * C.UNITS + 0.5) + C.OFFSETS
    distance = ((points[:, None, :] - np.array(centres, float)[None]) ** 2).sum(axis=2)
    assert np.array_equal(distance.argmin(axis=1), pdf["pickup_cluster"])


def test_rounds_are_lloyds(spark):
    """Every round against plain arithmetic: seeds by count then cell, whole-number means, empty centres stay."""
    r = np.random.default_rng(0)
    rows = [(float(x), float(y)) for x, y in np.round(r.normal([-73.9, 40.7], 0.05, (500, 2)), 6)] + [(None, 40.7), (float("nan"), 1.0), (200.0, 0.0)]
    df = spark.createDataFrame(rows, "pickup_longitude double, pickup_latitude double").repartition(3)
    points = np.floor(np.array(rows[:500]) * C.UNITS + 0.5).astype(np.int64) + C.OFFSETS
    cells, counts = np.unique(points // C.CELL, axis=0, return_counts=True)
    order = np.lexsort((cells[:, 1], cells[:, 0], -counts))[:4]
    centres = cells[order] * C.CELL + C.CELL // 2
    assert C.fit_centres(df, 4, rounds=0) == list(map(tuple, centres))
    for n in range(1, 6):
        near = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([points[near == i].sum(axis=0) // max(1, (near == i).sum()) if (near == i).any() else centres[i] for i in range(4)])
        assert C.fit_centres(df, 4, rounds=n) == list(map(tuple, centres))
    stage = C.cluster_stage(C.fit_centres(df, 4))
    assert stage.transform(df).filter("pickup_cluster IS NULL").count() == 3


def test_clusters_of_few_or_no_positions(spark):
    df = spark.createDataFrame([(-73.9, 40.7)] * 5, "pickup_longitude double, pickup_latitude double")
    assert C.degrees(C.fit_centres(df, 10)) == [[-73.9, 40.7]]
    assert {x.pickup_cluster for x in C.cluster_stage(C.fit_centres(df, 10)).transform(df).collect()} == {0}
    assert C.fit_centres(df.limit(0)) == []
    assert {x.pickup_cluster for x in C.cluster_stage([]).transform(df).collect()} == {None}
    with pytest.raises(ValueError, match="k must"):
        C.fit_centres(df, 100)


def test_clusters_of_separate_groups_are_their_means(spark):
    rows = [(-74.0 + 0.001 * (i % 3), 40.6 + 0.1 * (i % 4), ) for i in range(400)]
    df = spark.createDataFrame(rows, "pickup_longitude double, pickup_latitude double")
    got = sorted(C.degrees(C.fit_centres(df, k=4)), key=lambda c: c[1])
    pdf = df.toPandas()
    want = pdf.groupby("pickup_latitude")["pickup_longitude"].mean()
    assert np.allclose([c[1] for c in got], want.index, atol=2e-6) and np.allclose([c[0] for c in got], want.values, atol=2e-6)


def test_cross_validation_equals_the_built_in_one(parts, clusters, tuned):
    """Same folds, whole pipeline refitted for every grid point: same mean errors."""
    train_rows = parts[0]
    for stage in clusters:
        train_rows = stage.transform(train_rows)
    train_rows = train_rows.withColumn("fold", fold_of(folds=2))
    lr = M.regression(M.OPTIMIZED)
    whole = Pipeline(stages=[*M.feature_stages(M.OPTIMIZED), M.expansion(M.OPTIMIZED), lr])
    grid = tuning.parameter_grid(lr, (0.01, 0.1), (0.0, 0.7))
    evaluator = RegressionEvaluator(labelCol=S.LABEL, predictionCol=M.OPTIMIZED.prediction, metricName="rmse")
    built_in = CrossValidator(
        estimator=whole, estimatorParamMaps=grid, evaluator=evaluator, numFolds=2, foldCol="fold", parallelism=4
    ).fit(train_rows)
    ours = [tuning._mean_rmse(tuned.scores, p[lr.regParam], p[lr.elasticNetParam]) for p in grid]
    assert ours == pytest.approx(built_in.avgMetrics, rel=1e-7)
    best = built_in.bestModel.stages[-1]
    assert (tuned.variant.reg_param, tuned.variant.elastic_net) == (best.getRegParam(), best.getElasticNetParam())
    assert np.allclose(tuned.model.stages[-1].coefficients.toArray(), best.coefficients.toArray(), atol=1e-9)


def test_tuned_model_scores_raw_requests_after_reload(spark, trips, tuned):
    """Cluster stages are in the saved pipeline, so requests need no preparation."""
    path = scratch.run_dir(spark, "test-model")
    store.save_model(tuned.model, path)
    loaded = store.load_model(path)
    requests = requests_from_trips(trips)
    direct = serve.score_requests(requests, tuned.model).orderBy("id").toPandas()
    reloaded = serve.score_requests(requests, loaded).orderBy("id").toPandas()
    assert len(direct) > 0 and set(direct["scorer"]) == {"model"}
    assert np.allclose(direct["duration_seconds"], reloaded["duration_seconds"])


def test_saving_overwrites(spark, parts):
    path = scratch.run_dir(spark, "test-model")
    for variant in (M.BASELINE_7, M.BASELINE):
        store.save_model(M.fit_variants(parts[0], [variant])[variant.name], path)
    assert store.load_model(path).stages[-1].getPredictionCol() == M.BASELINE.prediction


def test_missing_model_falls_back_to_the_rule(spark, trips):
    model = store.load_model(scratch.run_dir(spark, "nothing"))
    assert model is None
    scored = serve.score_requests(requests_from_trips(trips), model)
    assert {r.scorer for r in scored.select("scorer").distinct().collect()} == {"rules"}


def test_damaged_model_is_an_error(spark, parts):
    path = scratch.run_dir(spark, "test-model")
    store.save_model(M.fit_variants(parts[0], [M.BASELINE_7])[M.BASELINE_7.name], path)
    spark.createDataFrame([("garbage",)], "value string").write.mode("overwrite").text(f"{path}/metadata")
    with pytest.raises(Exception):
        store.load_model(path)


def test_fits_do_not_depend_on_the_layout_of_the_input(parts):
    found = [
        M.fit_variants(parts[0].repartition(n), [M.BASELINE])[M.BASELINE.name].stages[-1].coefficients.toArray() for n in (1, 3, 16)
    ]
    assert np.allclose(found[0], found[1], atol=1e-9) and np.allclose(found[0], found[2], atol=1e-9)


def test_clusters_do_not_depend_on_shuffle_settings(spark, parts):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    found = []
    try:
        for n, adaptive in ((3, "true"), (8, "false"), (200, "true")):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            found.append(C.fit_centres(parts[0].repartition(n)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] == found[2]


def test_one_pass_metrics_equal_the_evaluator(parts):
    fitted = M.fit_variants(parts[0], [M.BASELINE_7, M.BASELINE])
    predicted = M.predict_variants(parts[1], fitted, [M.BASELINE_7, M.BASELINE])
    table = {r.model: r for r in metrics.regression_metrics(predicted, {v.name: v.prediction for v in (M.BASELINE_7, M.BASELINE)}).collect()}
    for v in (M.BASELINE_7, M.BASELINE):
        evaluator = RegressionEvaluator(labelCol=S.LABEL, predictionCol=v.prediction, metricName="rmse")
        assert table[v.name].rmse_log == pytest.approx(evaluator.evaluate(predicted))
        assert table[v.name].rmsle == pytest.approx(table[v.name].rmse_log)
        r2 = RegressionEvaluator(labelCol=S.LABEL, predictionCol=v.prediction, metricName="r2").evaluate(predicted)
        assert table[v.name].r2 == pytest.approx(r2)


def test_train_and_save_keeps_the_best(spark, cleaned):
    path = scratch.run_dir(spark, "test-best")
    name, table, _ = train.train_and_save(cleaned, path, reg_params=(0.01,), elastic_nets=(0.0,), folds=2)
    rows = {r.model: r.rmsle for r in table.collect()}
    assert set(rows) == {"Baseline", "+Interaction", "Optimized"}
    assert rows[name] == min(rows.values())
    assert store.load_model(path) is not None


@pytest.fixture
def counted(spark):
    """A frame that counts how many of its rows are read."""

    def wrap(df):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema), seen

    return wrap


def test_moments_equal_the_stages_on_all_rows(parts, clusters):
    """Index, scale and expansion from sums by category, against Spark's stages on the rows themselves."""
    rows = clusters[0].transform(parts[0])
    variant = M.Variant("wide", (*S.CLUSTER_10, "distance_peak"), degree=2)
    fitted = Pipeline(stages=M.vector_stages(variant)).fit(rows)
    x = np.array([r[0] for r in fitted.transform(rows).select(vector_to_array("wide_features")).collect()])
    y = np.array([r[0] for r in rows.select(S.LABEL).collect()])
    sums = M.collect_variants(rows.withColumn("fold", fold_of()), [variant, M.BASELINE], "fold")
    labels = {f: sums.labels(f) for f in ("vendor_idx", "cluster_idx")}
    mean, spread = sums.scale(variant.features, labels)
    gram = sums.gram(variant.features, 2, labels, mean, spread)
    full = np.column_stack([x, y, np.ones(len(y))])
    assert full.shape[1] == 79 and sums.rows() == len(y) and sums.folds == [0, 1, 2]
    assert np.allclose(gram, full.T @ full, rtol=1e-8, atol=1e-8 * np.abs(gram).max())
    scale = M.fitted_scaler(variant, mean, spread, rows.sparkSession)
    assert np.allclose(scale.mean, fitted.stages[2].mean) and np.allclose(scale.std, fitted.stages[2].std)
    reduced = moments.moment_rows(gram)
    again = np.column_stack([reduced.x, reduced.y, np.ones(len(reduced.y))])
    assert np.allclose(reduced.weight * again.T @ again, gram, rtol=1e-9, atol=1e-7 * np.abs(gram).max())


def test_variants_read_the_training_rows_once(parts, counted):
    rows, seen = counted(parts[0])
    fitted = M.fit_variants(rows, train.PLAIN_VARIANTS)
    assert len(fitted) == 3 and seen.value == parts[0].count()


def test_search_reads_the_training_rows_once(parts, counted):
    rows, seen = counted(parts[0])
    tuning.cross_validate(rows, M.BASELINE, reg_params=(0.01, 0.1), elastic_nets=(0.0,), folds=3)
    assert seen.value == parts[0].count()


def test_null_features_are_an_error(parts):
    with pytest.raises(ValueError, match="NULL"):
        M.fit_variants(parts[0].withColumn("pickup_hour", F.expr("nullif(pickup_hour, 3)")), [M.BASELINE])


def test_moment_rows_keep_constant_columns_constant():
    x = np.column_stack([np.zeros(50), np.full(50, 3.0), np.arange(50.0), np.arange(50.0) ** 2, np.ones(50)])
    rows = moments.moment_rows(x.T @ x)
    assert np.all(rows.x[:, 0] == 0.0) and np.all(rows.x[:, 1] == 3.0)
    assert rows.x[:, 2].mean() == pytest.approx(24.5)


def test_search_over_a_plain_variant(parts):
    """No clusters, no expansion: the search works for any variant."""
    found = tuning.cross_validate(parts[0], M.BASELINE, reg_params=(0.01, 0.1), elastic_nets=(0.0,), folds=2)
    assert len(found.scores) == 4 and found.variant.reg_param == 0.01
