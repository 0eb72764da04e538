"""Table profile: schema, shape, preview, missing values, descriptive statistics.

Each function is one aggregate over the table; the one-row result is turned
into a long table, so nothing is looped over on the driver. ``one_pass`` makes one aggregate of several.
``exact_profile`` takes two, for quartiles of any number.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.5, 0.75)
QUANTILE_ACCURACY = 10_000
#: How far from a quartile its bounds are sketched, as a multiple of the sketch's own error of rank.
MARGIN = 4


def _is_missing(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


class OneRow(NamedTuple):
    """A report made of one row of aggregates: the aggregates by name, and the rows of the report as structs."""

    aggregates: dict[str, Column]
    rows: list[Column]

    def of(self, df: DataFrame) -> DataFrame:
        """The report as one aggregate of its own."""
        return self.table(df.agg(*[c.alias(name) for name, c in self.aggregates.items()]))

    def table(self, row: DataFrame) -> DataFrame:
        return row.select(F.inline(F.array(*self.rows)))


def one_pass(df: DataFrame, reports: dict[str, OneRow]) -> dict[str, DataFrame]:
    """All the reports from a single aggregate over ``df``, which runs here; its one row comes to the driver."""
    named = {f"{r}.{name}": c for r, report in reports.items() for name, c in report.aggregates.items()}
    aggregated = df.agg(*[c.alias(name) for name, c in named.items()])
    row = df.sparkSession.createDataFrame([aggregated.first()], aggregated.schema)
    return {
        r: report.table(row.select(*[F.col(f"`{r}.{name}`").alias(name) for name in report.aggregates]))
        for r, report in reports.items()
    }


def schema_report(fields: list[T.StructField]) -> OneRow:
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"c{i}").alias("values"),
        )
        for i, f in enumerate(fields)
    ]
    return OneRow({f"c{i}": F.count(f.name) for i, f in enumerate(fields)}, rows)


def schema_listing(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, with its number of non-NULL values."""
    return schema_report(df.schema.fields).of(df)


def shape_report(columns: int) -> OneRow:
    return OneRow({"n": F.count("*")}, [F.struct(F.col("n").alias("rows"), F.lit(columns).alias("columns"))])


def table_shape(df: DataFrame) -> DataFrame:
    return shape_report(len(df.columns)).of(df)


def preview(df: DataFrame, n: int = 20, by: str = "id") -> DataFrame:
    """First ``n`` rows in the order of ``by``; each task keeps only its own first ``n``."""
    return df.orderBy(by).limit(n)


def missing_report(fields: list[T.StructField]) -> OneRow:
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"m{i}").alias("missing"),
            F.col("n").alias("rows"),
            F.try_divide(F.col(f"m{i}"), F.col("n")).alias("fraction"),
        )
        for i, f in enumerate(fields)
    ]
    return OneRow({"n": F.count("*")} | {f"m{i}": F.count_if(_is_missing(f)) for i, f in enumerate(fields)}, rows)


def missing_profile(df: DataFrame) -> DataFrame:
    """NULLs per column, NaN counted too for floating-point columns."""
    return missing_report(df.schema.fields).of(df)


def _structs(columns: list[str], cells) -> OneRow:
    """One struct for each column, with its name first."""
    aggregates = {f"s{i}": F.struct(F.lit(c).alias("column"), *cells(c)) for i, c in enumerate(columns)}
    return OneRow(aggregates, [F.col(name) for name in aggregates])


def numeric_report(columns: Iterable[str]) -> OneRow:
    return _structs(
        list(columns),
        lambda c: [
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ],
    )


def describe_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column, as doubles."""
    return numeric_report(columns).of(df)


def string_report(columns: Iterable[str]) -> OneRow:
    return _structs(list(columns), lambda c: [F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max")])


def describe_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, min, max per string column."""
    return string_report(columns).of(df)


def exact_profile(df: DataFrame, by: Iterable[str], value: str, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """count, n (not NULL), min, p25, p50, p75, max, mean, stddev of ``value`` per group, with exact quartiles for any type of number.

    A first pass sketches values just below and just above each quartile. A second one counts what lies below the two and, one by one, the
    values between them, about a thousandth of the group; among these the quartile is the first that reaches its rank.
    NaN is the greatest value. The groups have to fit into a broadcast; no group's rows meet in one task.
    """
    by = list(by)
    group, kind = [f"_g{i}" for i in range(len(by))], df.schema[value].dataType
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(by, group, strict=True)], F.col(value).alias("_v"))
    greatest = F.lit(float("inf"))
    fractional = isinstance(kind, (T.DoubleType, T.FloatType))
    sketched = F.nanvl("_v", greatest) if fractional else F.col("_v")  # sketches do not order NaN
    near = [p + side * MARGIN / accuracy for p in QUARTILES for side in (-1, 1)]
    moments = {
        "count": F.count("*"),
        "n": F.count("_v"),
        "min": F.min("_v"),
        "max": F.max("_v"),
        "mean": F.avg("_v"),
        "stddev": F.stddev("_v"),
    }
    sketches = rows.groupBy(*group).agg(
        *[c.alias(name) for name, c in moments.items()], F.percentile_approx(sketched, near, accuracy).alias("_near")
    )
    sketches = sketches.select(*[F.col(g).alias(f"{g}_") for g in group], *moments, "_near")
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in group], F.lit(True))
    v, cells = F.col("_v"), []
    for i, p in enumerate(QUARTILES):
        low, high = F.col("_near")[2 * i], F.col("_near")[2 * i + 1]
        reached = (v <= high) | (high == greatest) if fractional else v <= high
        # A NULL key stands for all below, and comes first; what lies above counts nothing but keeps its group.
        cells.append(
            F.struct(
                F.lit(i).alias("_i"),
                F.greatest(F.ceil(F.col("n") * F.lit(p)), F.lit(1)).alias("_rank"),
                F.when(reached & (v >= low), v).alias("_key"),
                F.when(reached, 1).otherwise(0).cast("long").alias("_one"),
            )
        )
    cells = rows.join(F.broadcast(sketches), same).select(*group, *moments, F.inline(F.array(*cells)))
    counts = cells.groupBy(*group, *moments, "_i", "_rank", "_key").agg(F.sum("_one").alias("_n"))
    so_far = F.sum("_n").over(Window.partitionBy(*group, "_i").orderBy(F.col("_key").asc_nulls_first()))
    missed = F.raise_error(F.lit(f"a quartile of {value} lies outside the sketched bounds"))
    found = counts.withColumn("_found", F.when(so_far >= F.col("_rank"), F.coalesce(F.col("_key"), missed.cast(kind))))
    quartiles = [F.min(F.when(F.col("_i") == i, F.col("_found"))).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    names = ["count", "n", "min", "p25", "p50", "p75", "max", "mean", "stddev"]
    return (
        found.groupBy(*group, *moments)
        .agg(*quartiles)
        .select(
            *[F.col(g).alias(c) for c, g in zip(by, group, strict=True)],
            *[F.when(F.col("n") > 0, F.coalesce(c, missed.cast(kind))).alias(c) if c in ("p25", "p50", "p75") else c for c in names],
        )
    )


def summary_report(column: str, kind: str = "int") -> OneRow:
    """As ``value_summary`` from one aggregate, for whole numbers of bounded range: its state is a count for each value."""
    cells = ("count", "min", "p25", "p50", "p75", "max", "mean", "stddev")
    quartiles = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{column}`)").cast(kind) for p in QUARTILES]
    return OneRow(
        {
            "count": F.count(column),
            "min": F.min(column),
            **dict(zip(("p25", "p50", "p75"), quartiles, strict=True)),
            "max": F.max(column),
            "mean": F.avg(column),
            "stddev": F.stddev(column),
        },
        [F.struct(*cells)],
    )


def value_summary(df: DataFrame, column: str, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """count, min, exact quartiles, max, mean, stddev of one column (see ``exact_profile``); no rows give a count of 0."""
    found = exact_profile(df, [], column, accuracy)
    cells = ("min", "p25", "p50", "p75", "max", "mean", "stddev")
    # Without any row there is no cell to hold the one row of the report.
    return found.agg(F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("count"), *[F.max(c).alias(c) for c in cells])
