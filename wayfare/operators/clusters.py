"""Position clusters: k-means with fixed seeds, in whole numbers.

Positions are whole micro-degrees, counted from the date line and the south pole. The seeds are the centres of the k
fullest cells of the density grid, ties by cell. Each round assigns every position to its nearest centre (exactly, ties to the
first) and moves each centre to the mean of its positions, rounded down; it is one grouped sum, combined in the map
tasks. So the clusters depend neither on the layout of the input nor on the session, and plain SQL gives the same.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S

#: Whole units of a degree, of a cell of the seeds' grid, and the range that keeps all values positive.
UNITS, CELL = 1_000_000, 10_000
OFFSETS = (180 * UNITS, 90 * UNITS)
ROUNDS = 10
#: Squared distances times this many centres fit into a 64-bit integer anywhere on earth.
MOST = 35

Centre = tuple[int, int]


def whole_degrees(column: str, offset: int) -> str:
    return f"CAST(floor({column} * {UNITS}e0 + 5e-1) AS BIGINT) + {offset}"


def whole_positions(df: DataFrame) -> DataFrame:
    """x and y of each row as whole numbers; rows without a position are left out."""
    lon, lat = S.POSITION_2
    placed = df.filter(f"{lon} BETWEEN -180 AND 180 AND {lat} BETWEEN -90 AND 90")
    return placed.selectExpr(f"{whole_degrees(lon, OFFSETS[0])} AS x", f"{whole_degrees(lat, OFFSETS[1])} AS y")


def grid_seeds(points: DataFrame, k: int) -> list[Centre]:
    """Centres of the k fullest cells; fewer if there are fewer cells."""
    cells = points.groupBy(F.expr(f"x DIV {CELL}").alias("cx"), F.expr(f"y DIV {CELL}").alias("cy")).agg(F.count("*").alias("n"))
    fullest = cells.orderBy(F.desc("n"), "cx", "cy").limit(k).collect()
    return [(c.cx * CELL + CELL // 2, c.cy * CELL + CELL // 2) for c in fullest]


def nearest(centres: list[Centre], x: str = "x", y: str = "y") -> str:
    """SQL for the number of the nearest centre: the least of (squared distance, number), packed into one integer."""
    k = len(centres)
    packed = [f"(({x} - {cx}) * ({x} - {cx}) + ({y} - {cy}) * ({y} - {cy})) * {k} + {i}" for i, (cx, cy) in enumerate(centres)]
    least = f"least({', '.join(packed)})" if k > 1 else f"({packed[0]})"
    return f"CAST({least} % {k} AS INT)"


def moved(points: DataFrame, centres: list[Centre]) -> list[Centre]:
    """The mean of each centre's positions; a centre without any stays."""
    sums = points.groupBy(F.expr(nearest(centres)).alias("i")).agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.count("*").alias("n"))
    found = {r.i: (r.x // r.n, r.y // r.n) for r in sums.collect()}  # a row for each centre
    return [found.get(i, c) for i, c in enumerate(centres)]


def fit_centres(df: DataFrame, k: int = 10, rounds: int = ROUNDS) -> list[Centre]:
    """Centres after so many rounds; the positions are read once and held as two integers a row."""
    if not 1 <= k <= MOST:
        raise ValueError(f"k must be from 1 to {MOST}")
    points = whole_positions(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = grid_seeds(points, k)
        for _ in range(rounds if centres else 0):
            centres, before = moved(points, centres), centres
            if centres == before:  # further rounds change nothing
                break
    finally:
        points.unpersist()
    return centres


def cluster_stage(centres: list[Centre]) -> SQLTransformer:
    """A stage that adds ``pickup_cluster`` to rows with a pickup position; NULL where there is none."""
    lon, lat = S.POSITION_2
    if not centres:
        return SQLTransformer(statement="SELECT *, CAST(NULL AS INT) AS pickup_cluster FROM __THIS__")
    placed = f"{lon} BETWEEN -180 AND 180 AND {lat} BETWEEN -90 AND 90"
    point = f"named_struct('x', {whole_degrees(lon, OFFSETS[0])}, 'y', {whole_degrees(lat, OFFSETS[1])})"
    found = f"transform(array({point}), p -> {nearest(centres, 'p.x', 'p.y')})[0]"
    return SQLTransformer(statement=f"SELECT *, CASE WHEN {placed} THEN {found} END AS pickup_cluster FROM __THIS__")


def degrees(centres: list[Centre]) -> list[list[float]]:
    """Longitude and latitude of each centre."""
    return [[(c - o) / UNITS for c, o in zip(centre, OFFSETS, strict=True)] for centre in centres]
