"""Exact top-k search: histogram selection over all scores.

Every vector is scored against a block of queries. Counts of scores in equal bins are summed over all
tasks; the bin with the k-th score is cut into finer bins, and so on, until few scores other than the k best
are left above the lower bound, or one score. Scores under the bound are then filtered out, and ties are broken
by the smaller id. A task sends, for each query, only the bins down to its own k-th score: the k-th of all is
not below it. Queries come in blocks of bounded size, so what goes to the tasks is bounded.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id.
Vectors of different dimensions have no score with each other. A repeated row is a candidate each time, but no
candidate of the query with its id; of repeated queries the first, in the order of the vectors, counts.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved

#: Queries in one block, and bins of one histogram.
BLOCK, BINS = 2048, 256
#: Refining ends when no query has more than this many times k scores above its bound.
ENOUGH = 4
RESULT = "query_id long, rank int, vec_id long, score long"


class QueryBlock:
    """Queries of one dimension and the range [low, high) in which each one's k-th score lies."""

    def __init__(self, ids: list[int], vectors: list[list[float]], scale: int):
        self.scale = scale
        self.ids = np.array(ids, np.int64)
        self.vectors = np.floor(scale * np.array(vectors, np.float64).reshape(len(ids), -1))
        self.low = self.high = np.zeros(len(ids), np.int64)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Integer inner products, queries by vectors; by doubles where these hold every sum exactly."""
        v = np.floor(self.scale * vectors)
        most = max(1, v.shape[1]) * np.abs(v).max(initial=0) * np.abs(self.vectors).max(initial=0)
        if most < 2**53:
            return (self.vectors @ v.T).astype(np.int64)
        return self.vectors.astype(np.int64) @ v.astype(np.int64).T

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of candidates with the right dimension, and their scores; a query's own id has the smallest score of all."""
        for batch in batches:
            ids = np.asarray(batch["vec_id"].fill_null(0), np.int64)
            there = np.asarray(batch["vec_id"].is_valid())
            for rows, vectors in common.vector_blocks(batch):
                if vectors.shape[1] == self.vectors.shape[1]:
                    rows, vectors = rows[there[rows]], vectors[there[rows]]
                    yield ids[rows], self.scores(vectors)

    def widths(self) -> np.ndarray:
        return np.maximum(1, -(-(self.high - self.low) // BINS))


def _histogram(block: QueryBlock, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, n = block.widths(), len(block.ids)
        # the bins of a query, then one for all that is above its range
        counts = np.zeros((n, BINS + 1), np.int64)
        row = np.arange(n)[:, None]
        for ids, scores in block.scored(batches):
            at = np.where(scores >= block.high[:, None], BINS, (scores - block.low[:, None]) // width[:, None])
            use = (at >= 0) & (ids[None, :] != block.ids[:, None])
            counts += np.bincount((row * (BINS + 1) + at)[use], minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        columns = [pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[q, b], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["q", "bin", "n"])

    return run


def _best(block: QueryBlock, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for ids, scores in block.scored(batches):
            q, c = np.nonzero((scores >= block.low[:, None]) & (ids[None, :] != block.ids[:, None]))
            kept = [np.concatenate(x) for x in zip(kept, (q, ids[c], scores[q, c]), strict=True)]
            order = np.lexsort((kept[1], -kept[2], kept[0]))
            kept = [x[order] for x in kept]
            first = np.flatnonzero(np.diff(kept[0], prepend=-1))
            place = np.arange(len(kept[0])) - np.repeat(first, np.diff(first, append=len(kept[0])))
            kept = [x[place < k] for x in kept]
        columns = [pa.array(x, pa.int64()) for x in (block.ids[kept[0]], kept[1], kept[2])]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def _search(vectors: DataFrame, block: QueryBlock, longest: float, k: int) -> DataFrame:
    """The k best of one block of queries."""
    reach = np.ceil(np.sqrt((block.vectors**2).sum(axis=1)) * longest) + 1
    block.high = np.minimum(reach, 2.0**62).astype(np.int64)
    block.low = -block.high
    while True:
        counts = vectors.mapInArrow(_histogram(block, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        downward = Window.partitionBy("q").orderBy(F.desc("bin"))
        reached = counts.withColumn("total", F.sum("n").over(downward))
        # the first bin from above with which there are k scores; without one, all scores count
        found = reached.groupBy("q").agg(
            F.min(F.when(F.col("total") >= k, F.struct("total", "bin"))).alias("at"), F.max("total").alias("all")
        )
        width, more = block.widths(), False
        for row in found.collect():  # one row for each query of the block
            if row["at"] is None or row["at"]["bin"] == BINS:
                continue
            low = int(block.low[row["q"]] + row["at"]["bin"] * width[row["q"]])
            block.low[row["q"]], block.high[row["q"]] = low, low + int(width[row["q"]])
            more |= row["at"]["total"] > ENOUGH * k and width[row["q"]] > 1
        if not more:
            break
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = vectors.mapInArrow(_best(block, k), "query_id long, vec_id long, score long")
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _longest(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 0.0
        for batch in batches:
            for _, block in common.vector_blocks(batch):
                most = max(most, float(np.sqrt((np.floor(scale * block) ** 2).sum(axis=1)).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([most], pa.float64())], ["most"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """The k highest scores of each query among all vectors but its own, with their ranks.

    ``vectors`` and ``queries`` have vec_id and embedding.
    """
    spark = vectors.sparkSession
    common.prepared(spark)
    vectors = vectors.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    queries = queries.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    queries = queries.filter(f"vec_id IS NOT NULL AND embedding IS NOT NULL AND {finite}")
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = saved(queries.withColumn("size", F.size("embedding")), "queries")
    sizes = {r["size"]: r["n"] for r in queries.groupBy("size").agg(F.count("*").alias("n")).collect()}
    result = spark.createDataFrame([], RESULT)
    if not sizes:
        return result
    longest = vectors.mapInArrow(_longest(scale), "most double").agg(F.max("most")).first()[0] or 0.0
    for size, n in sorted(sizes.items()):
        blocks = -(-n // BLOCK)
        for b in range(blocks):
            rows = queries.filter((F.col("size") == size) & (F.expr(f"pmod(xxhash64(vec_id), {blocks})") == b)).collect()
            if rows:
                block = QueryBlock([r["vec_id"] for r in rows], [r["embedding"] for r in rows], scale)
                result = result.union(saved(_search(vectors, block, longest, k), "best"))
    return result
