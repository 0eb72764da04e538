"""The command-line jobs one after the other, as a user runs them."""

from __future__ import annotations

import pytest

from wayfare.__main__ import main, parser
from wayfare.sources import scratch, sinks
from wayfare.sources.trips import requests_from_trips


def test_jobs_end_to_end(spark, trips):
    root = scratch.run_dir(spark, "test-jobs")
    raw, table, model = f"{root}/trips.csv", f"{root}/clean", f"{root}/model"
    sinks.export_csv(trips, raw)
    main(["explore", "--trips", raw, "--clean", table, "--reports", f"{root}/reports"])
    assert sinks.read_clean(spark, table).count() == 886

    outputs = ["--metrics", f"{root}/metrics", "--residuals", f"{root}/residuals", "--grid", f"{root}/grid"]
    main(["train", "--clean", table, "--model", model, *outputs])
    assert spark.read.option("header", True).csv(f"{root}/residuals").count() == 24
    assert spark.read.option("header", True).csv(f"{root}/grid").count() == 9
    metrics = spark.read.option("header", True).csv(f"{root}/metrics")
    assert {r.model for r in metrics.collect()} == {"Baseline", "+Interaction", "Optimized"}

    requests = requests_from_trips(trips)
    sinks.export_csv(requests, f"{root}/requests.csv")
    requests.write.parquet(f"{root}/incoming")
    common = ["--model", model]
    main(["score", "--requests", f"{root}/requests.csv", "--out", f"{root}/batch", "--rejected", f"{root}/bad", *common])
    main(
        ["stream", "--requests", f"{root}/incoming", "--out", f"{root}/live", "--rejected", f"{root}/live-bad"]
        + ["--checkpoint", f"{root}/log", "--once", *common]
    )
    batch, live = spark.read.parquet(f"{root}/batch"), spark.read.parquet(f"{root}/live").drop("batch")
    assert batch.count() + spark.read.parquet(f"{root}/bad").count() == trips.count()
    assert {r.scorer for r in batch.select("scorer").distinct().collect()} == {"model"}
    assert sorted(map(str, batch.collect())) == sorted(map(str, live.collect()))
    assert spark.read.parquet(f"{root}/bad").count() == spark.read.parquet(f"{root}/live-bad").count()


def test_train_reads_the_exported_csv_and_missing_models_are_errors(spark, cleaned, trips):
    root = scratch.run_dir(spark, "test-jobs")
    sinks.export_csv(cleaned, f"{root}/clean")
    main(["train", "--format", "csv", "--clean", f"{root}/clean", "--model", f"{root}/model", "--metrics", f"{root}/metrics"])
    requests_from_trips(trips).write.parquet(f"{root}/requests")
    score = ["score", "--format", "parquet", "--requests", f"{root}/requests", "--out", f"{root}/out", "--rejected", f"{root}/bad"]
    with pytest.raises(SystemExit, match="no model"):
        main([*score, "--model", f"{root}/nothing"])
    main([*score, "--model", f"{root}/nothing", "--fall-back"])
    assert {r.scorer for r in spark.read.parquet(f"{root}/out").select("scorer").distinct().collect()} == {"rules"}


def test_jobs_need_their_options():
    with pytest.raises(SystemExit):
        parser().parse_args(["train", "--clean", "x"])
