"""Table and report sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from wayfare.schema import CLEAN_COLUMNS, CLEAN_SCHEMA
from wayfare.sources.trips import CSV_OPTIONS, read_by_name


def write_clean(
    clean: DataFrame,
    path: str,
    partition_by: str | None = "pickup_month",
    rebalance: bool = True,
) -> None:
    """Write the cleaned table as Parquet, one directory per month.

    Without ``rebalance`` every input task writes a file for every month it
    meets. The rebalance hint shuffles rows by month first; adaptive execution
    then splits a month that holds far more rows than the others and merges
    small ones, so files come out near the advisory partition size. Turn it off
    when the input is already laid out by time.
    """
    if partition_by and rebalance:
        clean = clean.hint("rebalance", partition_by)
    writer = clean.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def rewrite_months(clean: DataFrame, path: str, months: Iterable[int], partition_by: str = "pickup_month") -> None:
    """Replace only these months of a written cleaned table; all others stay as they are.

    Rows of other months are refused before anything is written, and so is a month without rows, which would stay as
    it was. Running it again gives the same table.
    """
    months = sorted(set(months))
    found = {r[0] for r in clean.select(partition_by).distinct().collect()}  # at most as many as a year has months
    if found - set(months):
        raise ValueError(f"rows of other months: {sorted(map(str, found - set(months)))}")
    if set(months) - found:
        raise ValueError(f"no rows for the months {sorted(set(months) - found)}")
    rows = clean.hint("rebalance", partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table with its types and column order as written."""
    return spark.read.schema(CLEAN_SCHEMA).parquet(path).select(*CLEAN_COLUMNS)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header each, written in parallel."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported cleaned table; columns are found by their header. A cell that does not parse is an error."""
    return read_by_name(spark, path, CLEAN_SCHEMA, mode="FAILFAST").select(*CLEAN_COLUMNS)
