"""Embedding near-duplicates: a subspace pigeonhole join.

Vectors are scaled to length 1, so a cosine of at least t is a squared distance of at most 2 - 2t. They are turned
by a fixed rotation and cut into blocks of few dimensions; each block gets its part of the squared distance in proportion
to its dimensions. Two vectors within the whole budget are within the budget of one block at least. In every block
a vector lies in the cell given by the signs of its first coordinates, and visits each cell within the block's
radius. In a cell the vectors at home are range-joined with all others there, and what passes is verified with
all dimensions in double precision. A pair counts in the first block whose budget it meets, so nothing is counted
twice, and no pair leaves its task: a task returns each vector's number of links and a spanning forest of them.

Equal vectors are first joined into classes, so copies are one row. Large cells are cut into tiles of
homes and guests, so that no task holds an unbounded group.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of different
dimensions do not link. Floats stay floats; components of any other type are taken as doubles. A repeated row is a vector of its own. Rows without an id keep a null id and
link with nothing. A cosine of exactly the threshold links. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved
from wayfare.llm.components import components

BLOCK_DIMS = 16
#: Vectors at home in a cell at which its side is halved again, and rows of a tile.
CELL, HOMES, GUESTS = 4096, 8192, 32768
MOST_SIGNS = 8
SEED = 9


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


class Blocks:
    """The blocks of vectors of one dimension, each with its part of the squared distance."""

    def __init__(self, size: int, threshold: float, signs: int):
        self.rotation, self.threshold = rotation(size), threshold
        edges = np.linspace(0, size, max(1, round(size / BLOCK_DIMS)) + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
        self.budget = [(2 - 2 * threshold) * (p.stop - p.start) / size * (1 + 1e-9) + 1e-12 for p in self.parts]
        self.signs = signs

    def unit(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

    def cells(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each block: row numbers, cells, and whether the row is at home there."""
        turned = unit @ self.rotation
        for b, part in enumerate(self.parts):
            x = turned[:, part][:, : self.signs]
            masks = np.arange(1 << x.shape[1])
            flips = (masks[:, None] >> np.arange(x.shape[1])) & 1
            home = ((x < 0) << np.arange(x.shape[1])).sum(axis=1)
            row, flip = np.nonzero((x * x) @ flips.T <= self.budget[b])
            yield b, row, home[row] ^ masks[flip], flip == 0

    def links(self, b: int, homes: np.ndarray, guests: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (home, guest) that are near enough and meet the budget of no block before b."""
        h_all, g_all = homes @ self.rotation, guests @ self.rotation
        h32, g32 = (x[:, self.parts[b]].astype(np.float32) for x in (h_all, g_all))
        g_square = (g32 * g32).sum(axis=1)
        for i in range(0, len(homes), 512):
            for j in range(0, len(guests), 4096):
                h, g = h32[i : i + 512], g32[j : j + 4096]
                far = (h * h).sum(axis=1)[:, None] + g_square[None, j : j + 4096] - 2 * (h @ g.T)
                r, c = np.nonzero(far <= self.budget[b] + 1e-4)
                for k in range(0, len(r), 1 << 16):
                    p, q = r[k : k + (1 << 16)] + i, c[k : k + (1 << 16)] + j
                    apart = (h_all[p] - g_all[q]) ** 2
                    use = (homes[p] * guests[q]).sum(axis=1) >= self.threshold
                    for a in range(b + 1):
                        within = apart[:, self.parts[a]].sum(axis=1) <= self.budget[a]
                        use &= within if a == b else ~within
                    yield p[use], q[use]


class Forest:
    """Sets of linked rows of one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Tie the trees of linked rows together, the later root to the earlier one."""
        while len(a):
            root = self._roots()
            a, b = root[a], root[b]
            a, b = np.maximum(a, b)[a != b], np.minimum(a, b)[a != b]
            np.minimum.at(self.parent, a, b)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        root = self._roots()
        low = np.flatnonzero(root != np.arange(len(root)))
        return low, root[low]


def _grouped(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def near_classes(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links of each class (vec_id, n_links: members of linked classes) and a forest (a, b), from distinct vectors
    (vec_id, n, size, embedding)."""
    spark = classes.sparkSession
    many = classes.count()
    signs = int(np.clip(np.ceil(np.log2(max(1, many) / CELL)), 1, MOST_SIGNS))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for rows, vectors in common.vector_blocks(batch):
                size = vectors.shape[1]
                for b, row, cell, home in Blocks(size, threshold, signs).cells(Blocks(size, threshold, signs).unit(vectors)):
                    yield batch, size, b, rows[row], cell, home

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size, b, _, cell, home in placed(batches):
            cells, at = np.unique(cell, return_inverse=True)
            columns = [np.full(len(cells), size), np.full(len(cells), b), cells, np.bincount(at, home), np.bincount(at)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["size", "block", "cell", "homes", "guests"])

    counted = classes.mapInArrow(count, "size long, block long, cell long, homes long, guests long")
    sums = counted.groupBy("size", "block", "cell").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests"))
    # at most 256 cells for each block of a dimension
    tiles = {(r["size"], r["block"], r["cell"]): (-(-r["homes"] // HOMES), -(-r["guests"] // GUESTS)) for r in sums.collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size, b, rows, cell, home in placed(batches):
            ids = np.asarray(batch["vec_id"])[rows]
            spread = common.mixed(ids.astype(np.uint64))
            shape = np.array([tiles[size, b, c] for c in cell.tolist()]).reshape(-1, 2)
            for i in range(int(shape[:, 0].max(initial=0))):
                for j in range(int(shape[:, 1].max(initial=0))):
                    mine = home & (spread % np.maximum(shape[:, 0], 1).astype(np.uint64) == i)
                    theirs = (spread >> np.uint64(32)) % np.maximum(shape[:, 1], 1).astype(np.uint64) == j
                    at = np.flatnonzero((i < shape[:, 0]) & (j < shape[:, 1]) & (mine | theirs))
                    took = batch.take(pa.array(rows[at]))
                    fixed = [np.full(len(at), x) for x in (size, b, i, j)]
                    columns = [pa.array(x.astype(np.int32)) for x in (*fixed, cell[at])]
                    columns += [pa.array(mine[at]), pa.array(theirs[at]), took["vec_id"], took["n"], took["embedding"]]
                    names = ["size", "block", "i", "j", "cell", "home", "guest", "vec_id", "n", "embedding"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    def join(key: tuple, tile: pa.Table) -> pa.Table:
        size, b = key[0].as_py(), key[1].as_py()
        blocks = Blocks(size, threshold, signs)
        tile = tile.combine_chunks()
        unit = blocks.unit(_grouped(tile["embedding"].combine_chunks(), size))
        ids, n = np.asarray(tile["vec_id"]), np.asarray(tile["n"])
        homes, guests = (np.flatnonzero(np.asarray(tile[c])) for c in ("home", "guest"))
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        for p, q in blocks.links(b, unit[homes], unit[guests]):
            p, q = homes[p], guests[q]
            use = ids[p] != ids[q]
            p, q = p[use], q[use]
            np.add.at(links, p, n[q])
            forest.join(p, q)
        some, (a, b_) = np.flatnonzero(links), forest.edges()
        return pa.table({
            "vec_id": pa.array(np.concatenate([ids[some], ids[a]]), pa.int64()),
            "n_links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]), pa.int64()),
            "other": pa.array(np.concatenate([ids[some], ids[b_]]), pa.int64()),
        })

    common.prepared(spark)
    kind = classes.schema["embedding"].dataType.simpleString()
    dealt = classes.mapInArrow(
        deal, f"size int, block int, i int, j int, cell int, home boolean, guest boolean, vec_id long, n long, embedding {kind}"
    )
    found = dealt.groupBy("size", "block", "cell", "i", "j").applyInArrow(join, "vec_id long, n_links long, other long")
    found = saved(found, "found")
    links = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    return links, found.filter("vec_id <> other").selectExpr("vec_id AS a", "other AS b")


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of (vec_id, embedding)."""
    common.prepared(vectors.sparkSession)
    kind = "ARRAY<FLOAT>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "ARRAY<DOUBLE>"
    rows = vectors.selectExpr("CAST(vec_id AS LONG) AS vec_id", f"CAST(embedding AS {kind}) AS embedding")
    usable = (
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND exists(embedding, x -> x <> 0)"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    rows = rows.withColumn("embedding", F.when(F.expr(usable), F.col("embedding")))
    classes = rows.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
    classes = saved(classes.select("vec_id", "n", "embedding"), "classes")
    links, forest = near_classes(classes, threshold)
    of = components(forest).select(F.col("id").alias("vec_id"), "component")
    classes = classes.join(links, "vec_id", "left").join(of, "vec_id", "left").select(
        F.col("embedding"),
        (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    return rows.join(classes, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
