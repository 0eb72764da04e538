"""Spark session for tests and benchmarks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def make_session(cpus: str | None = None, **conf: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wayfare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wayfare-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
