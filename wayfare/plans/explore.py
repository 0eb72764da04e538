"""Explore and clean: profile the raw trips, write the cleaned table, report on it."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schema as S
from wayfare.functions import geo
from wayfare.operators import clean, profile, stats
from wayfare.sources import scratch, sinks
from wayfare.sources.trips import CORRUPT, malformed, parse_trips_csv, well_formed

GRID_DEGREES = 0.01
PARSED_SCHEMA = T.StructType([*S.TRIP_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])


#: Bins and range of the duration histogram.
DURATION_BINS = (100, 0, 3600)


def raw_reports(trips: DataFrame, rules: clean.CleanRules = clean.CleanRules()) -> dict[str, DataFrame]:
    """The reports on the raw trips from three passes: one row of aggregates, one table of counts, the preview.

    The aggregates and the counts run here; the counts are written to a run folder, from which the tables are read.
    """
    spark, fields = trips.sparkSession, trips.schema.fields
    seated, placed = F.coalesce(rules.passengers_ok(), F.lit(False)), F.coalesce(rules.position_ok(), F.lit(False))
    passed = clean.add_measures(trips).withColumns(
        {"_passed": clean.steps_passed(rules), "_duration": F.when(seated & placed, F.col("trip_duration"))}
    )
    reports = profile.one_pass(
        passed,
        {
            "schema": profile.schema_report(fields),
            "shape": profile.shape_report(len(fields)),
            "missing": profile.missing_report(fields),
            "describe": profile.numeric_report(["vendor_id", *S.NUMERIC_COLUMNS]),
            "describe_strings": profile.string_report(["id", "store_and_fwd_flag"]),
            "funnel": clean.funnel_report("_passed"),
            "duration_summary": profile.summary_report("_duration"),
        },
    )
    kinds = {
        "flag": stats.Cells({"flag": F.col("store_and_fwd_flag")}),
        "passengers": stats.Cells({"passengers": F.col("passenger_count")}),
        "vendor": stats.Cells({"vendor": F.col("vendor_id")}, value=F.col("trip_duration")),
        "bin": stats.Cells({"bin": stats.fixed_bin("trip_duration", *DURATION_BINS)}, where=seated & placed),
    }
    for kind in ("pickup", "dropoff"):
        x, y = f"{kind}_longitude", f"{kind}_latitude"
        cell = {c: geo.grid_cell(c, GRID_DEGREES) for c in (x, y)}
        shown = {"zoomed": geo.in_box(x, y, rules.lon_range, rules.lat_range)}
        kinds[kind] = stats.Cells(cell | shown, where=seated & stats.drawable(x, y))
    path = scratch.run_dir(spark, "counts")
    stats.cell_counts(trips, kinds).write.parquet(path)
    counts = spark.read.parquet(path)

    def table(kind: str, **names: str) -> DataFrame:
        return stats.cells_of(counts, kind, names)

    positions = reduce(
        DataFrame.union,
        [
            table(kind, cell_x="long", cell_y="long", zoomed="boolean").select(F.lit(kind).alias("kind"), "*")
            for kind in ("pickup", "dropoff")
        ],
    )
    vendors = table("vendor", vendor_id="int")
    by_cell = positions.groupBy("kind", "cell_x", "cell_y")
    return reports | {
        "preview": profile.preview(trips),
        "flag": table("flag", store_and_fwd_flag="string").select("store_and_fwd_flag", "count").orderBy("store_and_fwd_flag"),
        "passengers": table("passengers", passenger_count="int").select("passenger_count", "count").orderBy("passenger_count"),
        "vendor_share": stats.share_of_counts(vendors.select("vendor_id", "count"), "vendor_id"),
        "vendor_duration": vendors.select("vendor_id", F.try_divide("sum", "n").alias("avg_duration")).orderBy("vendor_id"),
        "positions": by_cell.agg(F.sum("count").alias("count")),
        "positions_zoomed": positions.filter("zoomed").select("kind", "cell_x", "cell_y", "count"),
        "duration_histogram": stats.histogram_from_counts(
            table("bin", bin="int").filter("bin IS NOT NULL").select("bin", "count"), *DURATION_BINS
        ),
    }


def clean_reports(cleaned: DataFrame) -> dict[str, DataFrame]:
    return {
        "frequencies": stats.frequency_tables(cleaned, S.CATEGORY_COLUMNS),
        "log_duration_summary": profile.value_summary(cleaned, "log_duration"),
        "log_duration_histogram": stats.histogram_range(cleaned, "log_duration", 100),
        "correlation": stats.correlation_matrix(cleaned, S.CORRELATION_COLUMNS),
        "hour_profile": stats.exact_group_profile(cleaned, "pickup_hour", "trip_duration"),
        "distance_duration": stats.density_grid(
            cleaned, "distance_km", "trip_duration", 1.0, 60.0, y_range=(0, 7200)
        ),
        "binned_log_duration": stats.binned_mean(cleaned, "distance_km", "log_duration"),
    }


def explore(
    spark: SparkSession,
    trips: DataFrame,
    clean_path: str,
    report_path: str | None = None,
    rules: clean.CleanRules = clean.CleanRules(),
    rebalance: bool = True,
    funnel: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write the cleaned table once and report from it.

    ``trips`` is read three times for the raw reports, and once for the cleaned table: give it as a
    table (``ingest_csv`` makes one), not as text. The written table is the cut in the lineage:
    later reports and training survive the loss of any executor. The strong pairs come from the written
    correlation matrix, the quartiles from the hour profile. A ``funnel`` counted on the way in spares the pass for it.
    """
    reports = raw_reports(trips, rules) | ({"funnel": funnel} if funnel else {})
    sinks.write_clean(clean.clean_trips(trips, rules), clean_path, rebalance=rebalance)
    reports |= clean_reports(sinks.read_clean(spark, clean_path))
    if report_path:
        for name, table in reports.items():
            sinks.export_csv(table, f"{report_path}/{name}")
    return reports


class Ingested(NamedTuple):
    """A parsed CSV: its well-formed rows, the lines that do not parse, and the funnel that counts both."""

    trips: DataFrame
    malformed: DataFrame
    funnel: DataFrame


def ingest_csv(
    spark: SparkSession, path: str, table_path: str, rules: clean.CleanRules = clean.CleanRules()
) -> Ingested:
    """Parse a trips CSV once, into Parquet. The rows of every cleaning step are counted while they are written."""
    parsed = clean.add_measures(parse_trips_csv(spark, path))
    passed = F.when(F.col(CORRUPT).isNotNull(), -1).otherwise(clean.steps_passed(rules))
    observed = Observation("ingest")
    report = clean.funnel_report("_passed")
    counts = [F.count(F.lit(1)).alias("lines"), *[c.alias(name) for name, c in report.aggregates.items()]]
    counted = parsed.withColumn("_passed", passed).observe(observed, *counts)
    counted.select(*PARSED_SCHEMA.fieldNames()).write.mode("overwrite").parquet(table_path)
    found = observed.get
    steps = [clean.STEPS[0], clean.MALFORMED, *clean.STEPS[1:]]
    counts = [found["lines"], *(found[f"n{i}"] for i in range(len(clean.STEPS)))]
    row = spark.range(1).select(*[F.lit(n).cast("long").alias(f"n{i}") for i, n in enumerate(counts)])
    parsed = spark.read.schema(PARSED_SCHEMA).parquet(table_path)
    return Ingested(well_formed(parsed), malformed(parsed), row.select(F.inline(F.array(*clean.funnel_rows(steps)))))
