"""Grouped statistics, correlation, histograms and density grids."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions import geo, trip
from wayfare.operators.profile import QUANTILE_ACCURACY, QUARTILES, exact_profile


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(column)


def frequency_tables(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Frequency tables of several low-cardinality columns from one pass.

    Rows are first counted per combination of all the columns, then the
    combinations are unpivoted and added up, so the data is not multiplied by
    the number of columns before it is reduced.
    """
    columns = list(columns)
    combos = df.groupBy(*columns).agg(F.count("*").alias("n"))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        combos.select("n", F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.sum("n").alias("count"))
        .orderBy("column", "value")
    )


class Cells(NamedTuple):
    """One count in a common pass: which rows (all, if None), by which keys, and a value whose sum is wanted."""

    keys: dict[str, Column]
    where: Column | None = None
    value: Column | None = None


def cell_counts(df: DataFrame, kinds: dict[str, Cells]) -> DataFrame:
    """Counts of several kinds of cells from one pass: (kind, keys as text, count, n, sum).

    Every row yields a cell of each kind that takes it; cells are counted in the map tasks first.
    """
    cells = []
    for kind, c in kinds.items():
        keys = F.array(*[k.cast("string") for k in c.keys.values()])
        value = (F.lit(None) if c.value is None else c.value).cast("double")
        cell = F.struct(F.lit(kind).alias("kind"), keys.alias("keys"), value.alias("value"))
        cells.append(cell if c.where is None else F.when(c.where, cell))
    rows = df.select(F.inline(F.array_compact(F.array(*cells))))
    return rows.groupBy("kind", "keys").agg(F.count("*").alias("count"), F.count("value").alias("n"), F.sum("value").alias("sum"))


def cells_of(counts: DataFrame, kind: str, names: dict[str, str]) -> DataFrame:
    """The cells of one kind, with their keys under these names and types."""
    mine = counts.filter(F.col("kind") == kind)
    return mine.select(*[F.col("keys")[i].cast(t).alias(name) for i, (name, t) in enumerate(names.items())], "count", "n", "sum")


def group_mean(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(name)).orderBy(by)


def share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and percent of all rows; the total is read from the grouped counts."""
    return share_of_counts(df.groupBy(column).agg(F.count("*").alias("count")), column)


def share_of_counts(counts: DataFrame, column: str) -> DataFrame:
    """Percent of the sum of all counts."""
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") * F.lit(100.0) / total).orderBy(column)


def group_profile(df: DataFrame, by: str, value: str, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """count, min, exact quartiles, max, mean, stddev, IQR of ``value`` per group.

    For any column of numbers, from two passes: see ``profile.exact_profile``. NULL values count as rows and enter nothing else.
    """
    found = exact_profile(df, [by], value, accuracy)
    named = found.withColumnsRenamed({"p25": "q1", "p50": "median", "p75": "q3"}).drop("n")
    return named.withColumn("iqr", F.col("q3") - F.col("q1")).orderBy(by)


def _exact_quartiles(df: DataFrame, value: str) -> list[Column]:
    """The smallest values whose cumulative share reaches a quarter, half and three quarters; NULLs do not count."""
    kind = df.schema[value].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{value} is {kind.simpleString()}: exact quartiles are for integers, use group_profile")
    return [
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{value}`)").cast(kind).alias(name)
        for p, name in zip(QUARTILES, ("q1", "median", "q3"), strict=True)
    ]


def exact_group_profile(df: DataFrame, by: str, value: str) -> DataFrame:
    """As ``group_profile`` with exact quartiles, for an integer ``value`` of bounded range.

    A group's state is one count per value, merged from the map tasks: at most as many
    as the range has values (7,141 for cleaned durations), however many trips it
    stands for. Mean and spread come from integer sums and do not depend on the
    partitioning. NULL values count as rows and enter nothing else.
    """
    wide = F.col(value).cast("decimal(19,0)")
    sums = df.groupBy(by).agg(
        F.count("*").alias("count"),
        F.count(value).alias("n"),
        F.min(value).alias("min"),
        *_exact_quartiles(df, value),
        F.max(value).alias("max"),
        F.sum(wide).alias("s1"),
        F.sum(wide * wide).alias("s2"),
    )
    n = F.col("n").cast("decimal(19,0)")
    # n * sum of squares - square of the sum, exact before the one division.
    spread = (n * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    k = F.col("n").cast("double")
    return sums.select(
        by,
        "count",
        "min",
        "q1",
        "median",
        "q3",
        "max",
        F.when(F.col("n") > 0, F.col("s1").cast("double") / k).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(spread / (k * (k - 1)))).alias("stddev"),
        (F.col("q3") - F.col("q1")).alias("iqr"),
    ).orderBy(by)


#: Size of a quantile sketch: the rank error is below ``SKETCH_ERROR`` with 99 % probability.
SKETCH_K, SKETCH_ERROR = 400, 0.01


def quantile_sketches(df: DataFrame, by: Iterable[str], value: str) -> DataFrame:
    """One mergeable sketch of an integer ``value`` for each group, with its number of rows; to be stored."""
    sketch = F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(SKETCH_K))
    return df.groupBy(*by).agg(F.count(value).alias("n"), sketch.alias("sketch"))


def merged_quartiles(sketches: DataFrame, by: Iterable[str]) -> DataFrame:
    """q1, median and q3 of coarser groups from stored sketches; no row of the table behind them is read."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    quartiles = [
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for q, name in zip(QUARTILES, ("q1", "median", "q3"), strict=True)
    ]
    return merged.select(*by, "n", *quartiles)


def exact_group_quartiles(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box-plot data: exact q1, median, q3 per group (see ``exact_group_profile``)."""
    return df.groupBy(by).agg(*_exact_quartiles(df, value)).orderBy(by)


def _pair_corrs(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(
        *[F.corr(a, b).alias(f"r_{i}_{j}") for (i, a), (j, b) in combinations(enumerate(columns), 2)]
    )


def correlation_pairs(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Pearson r for each pair of columns (i < j), all pairs in one aggregate."""
    columns = list(columns)
    rows = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r_{i}_{j}").alias("r"))
        for (i, a), (j, b) in combinations(enumerate(columns), 2)
    ]
    return _pair_corrs(df, columns).select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The symmetric matrix, one row per column."""
    columns = list(columns)

    def cell(i: int, j: int):
        return F.lit(1.0) if i == j else F.col(f"r_{min(i, j)}_{max(i, j)}")

    rows = [
        F.struct(F.lit(a).alias("column"), *[cell(i, j).alias(b) for j, b in enumerate(columns)])
        for i, a in enumerate(columns)
    ]
    return _pair_corrs(df, columns).select(F.inline(F.array(*rows)))


def strong_pairs(pairs: DataFrame, threshold: float = 0.3) -> DataFrame:
    return pairs.filter(F.abs("r") > threshold)


def binned_mean(df: DataFrame, x: str, y: str, width: float = 1.0, max_x: float = 30.0) -> DataFrame:
    """Mean of ``y`` per bin of ``x`` up to ``max_x``."""
    return (
        df.filter(F.col(x) <= max_x)
        .groupBy(trip.distance_bin(x, width).alias("bin"))
        .agg(F.avg(y).alias("mean"), F.count("*").alias("count"))
        .orderBy("bin")
    )


def _fill_bins(counts: DataFrame, bins: int, lo, width) -> DataFrame:
    # Both sides have at most ``bins`` rows.
    frame = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        frame.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * width).alias("lower"),
            (lo + (F.col("bin") + 1) * width).alias("upper"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
        .orderBy("bin")
    )


def fixed_bin(column: str, bins: int, lo: float, hi: float) -> Column:
    """Bin of a value among equal ones over [lo, hi], the last one closed; NULL outside."""
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return F.when(F.col(column).between(lo, hi), index)


def histogram_from_counts(counts: DataFrame, bins: int, lo: float, hi: float) -> DataFrame:
    """All bins with their bounds, of the counts of those that have any."""
    return _fill_bins(counts, bins, F.lit(float(lo)), F.lit((hi - lo) / bins))


def histogram_fixed(df: DataFrame, column: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Counts in equal bins over [lo, hi]; values outside are left out, the last bin is closed."""
    bin_ = fixed_bin(column, bins, lo, hi)
    counts = df.select(bin_.alias("bin")).filter("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("count"))
    return histogram_from_counts(counts, bins, lo, hi)


def histogram_range(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins over the column's own [min, max].

    The range is a one-row aggregate read as a scalar subquery; the column is
    scanned twice, which any exact data-range histogram needs. NULL and NaN
    have no place on the axis and are left out.
    """
    df = df.filter(drawable(column))
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("e"))
    end = ends.scalar()
    lo, hi = end.getField("lo"), end.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    position = F.coalesce(F.try_divide(F.col(column) - lo, width), F.lit(0.0))
    index = F.least(F.floor(position), F.lit(bins - 1)).cast("int")
    counts = df.groupBy(index.alias("bin")).agg(F.count("*").alias("count"))
    return _fill_bins(counts, bins, lo, width)


def drawable(*columns: str):
    """Points with a position: neither NULL nor NaN."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return ok


def density_grid(
    df: DataFrame,
    x: str,
    y: str,
    x_size: float,
    y_size: float,
    x_range: tuple[float, float] | None = None,
    y_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Point counts per grid cell, optionally inside a viewport.

    Cells are counted in the map tasks first, so a crowded cell is one row per task.
    """
    if x_range:
        df = df.filter(F.col(x).between(*x_range))
    if y_range:
        df = df.filter(F.col(y).between(*y_range))
    df = df.filter(drawable(x, y))
    return df.groupBy(geo.grid_cell(x, x_size).alias("cell_x"), geo.grid_cell(y, y_size).alias("cell_y")).agg(
        F.count("*").alias("count")
    )


#: Units of a degree, and the edge of the finest cell of a zoom pyramid in these.
PYRAMID_UNITS, FINEST = 1_000_000, 1_000


def density_pyramid(df: DataFrame, lon: str, lat: str, levels: int = 8) -> DataFrame:
    """Counts in cells whose edge doubles with every level: (level, cell_x, cell_y, count).

    Rows are counted once, in the finest cells, counted in whole numbers from the date line and the south pole. A coarser
    cell is the finest one's number without its last bits, so all coarser levels are sums of the finest counts.
    """
    placed = df.filter(F.col(lon).between(-180, 180) & F.col(lat).between(-90, 90))
    finest = [
        F.expr(f"(CAST(floor({c} * {PYRAMID_UNITS}e0 + 5e-1) AS BIGINT) + {offset * PYRAMID_UNITS}) DIV {FINEST}").alias(name)
        for c, offset, name in ((lon, 180, "x"), (lat, 90, "y"))
    ]
    counts = placed.select(*finest).groupBy("x", "y").agg(F.count("*").alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    cells = counts.select("x", "y", "n", level).selectExpr("level", "shiftright(x, level) AS cell_x", "shiftright(y, level) AS cell_y", "n")
    return cells.groupBy("level", "cell_x", "cell_y").agg(F.sum("n").alias("count"))


def coordinates(df: DataFrame, key: str = "id") -> DataFrame:
    """Pickup and drop-off positions under short names."""
    return df.select(
        key,
        F.col("pickup_longitude").alias("lon"),
        F.col("pickup_latitude").alias("lat"),
        F.col("dropoff_longitude").alias("lon2"),
        F.col("dropoff_latitude").alias("lat2"),
    )


def coordinate_grid(
    df: DataFrame, size: float, lon_range: tuple[float, float] | None = None, lat_range: tuple[float, float] | None = None
) -> DataFrame:
    """Pickup and drop-off density from one scan: (kind, cell_x, cell_y, count)."""
    points = coordinates(df).select(
        F.inline(
            F.array(
                F.struct(F.lit("pickup").alias("kind"), F.col("lon"), F.col("lat")),
                F.struct(F.lit("dropoff").alias("kind"), F.col("lon2").alias("lon"), F.col("lat2").alias("lat")),
            )
        )
    )
    if lon_range:
        points = points.filter(F.col("lon").between(*lon_range))
    if lat_range:
        points = points.filter(F.col("lat").between(*lat_range))
    return points.filter(drawable("lon", "lat")).groupBy(
        "kind", geo.grid_cell("lon", size).alias("cell_x"), geo.grid_cell("lat", size).alias("cell_y")
    ).agg(F.count("*").alias("count"))
