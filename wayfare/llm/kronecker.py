"""Hard-negative mining by Kronecker-packed products.

Components are whole numbers, floor(scale * x). Those of several candidates, made non-negative by a bias, lie in
separate fields of one wide integer; one product with an anchor's component, biased too, serves them all. The sum
over the components holds in each field the biased inner product of one candidate, exactly, as a field is as wide
as the largest sum needs. Where two or more fields fit into the 53 bits that a double holds exactly, the packed
products are a product of matrices of doubles; wider fields lie in integers of ``WIDE`` fields of any width.

Anchors go to the tasks in waves of bounded size. In a first pass over all rows each task keeps every anchor's best
rows of its own label, in a second one the best rows of other labels in the window below each positive; a task
sends no more than it was asked for, and the best of all tasks are the result. So no row moves, and a label or a
vector that holds a large share of the rows is dealt like any other.

Rows without id, without label, with a null vector, or with a component that is null, not finite, or not finite
once scaled, take no part. Vectors of different dimensions have no score with each other. Ties go to the smaller
id. A row with the id of the anchor is no candidate for it; of anchors with one id the first by label and vector
counts, and other repeated rows count each time. Scores beyond a 64-bit integer count as its limits. Empty tables
give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved

#: Bytes of the anchors of one wave, and anchors multiplied at once in a task.
WAVE_BYTES, BLOCK = 8 << 20, 512
#: Bits that a double holds exactly; fields of a wider integer.
EXACT, WIDE = 53, 64
MOST = np.iinfo(np.int64).max
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors by rows) of whole numbers given as doubles."""
    n, size = rows.shape
    bias_a, bias_r = (int(np.abs(x).max(initial=0)) for x in (anchors, rows))
    width = max(1, (size * 2 * bias_a * 2 * bias_r).bit_length())
    fields = EXACT // width
    exact = fields >= 2
    if not exact:
        fields = WIDE
        whole = np.frompyfunc(int, 1, 1)
        anchors, rows = whole(anchors), whole(rows)
    else:
        bias_a, bias_r = float(bias_a), float(bias_r)
    groups = -(-n // fields)
    biased = np.zeros((groups * fields, size), rows.dtype)
    biased[:n] = rows + bias_r
    biased = biased.reshape(groups, fields, size)
    packed = biased[:, 0].copy()
    for f in range(1, fields):
        packed = packed + biased[:, f] * (1 << (width * f))
    sums = (anchors + bias_a) @ packed.T  # one product for each anchor component and wide integer
    if exact:
        sums = sums.astype(np.int64)
    mask = (1 << width) - 1
    scores = np.stack([(sums >> (width * f)) & mask for f in range(fields)], axis=2).reshape(len(anchors), -1)[:, :n]
    scores = scores - (anchors.sum(axis=1) * bias_r).astype(scores.dtype)[:, None]
    scores = scores - (rows.sum(axis=1) * bias_a).astype(scores.dtype)[None, :] - type(mask)(size * bias_a * bias_r)
    return scores if exact else np.clip(scores, -MOST, MOST).astype(np.int64)


class Wave:
    """Anchors of one dimension, and the window of scores for the negatives of each of their positives."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[list[float]], scale: int, windows: int):
        self.ids, self.labels, self.scale = np.array(ids, np.int64), np.array(labels, np.int64), scale
        self.vectors = np.floor(scale * np.array(vectors, np.float64).reshape(len(ids), -1))
        self.low, self.high = np.full((len(ids), windows), MOST), np.full((len(ids), windows), -MOST)
        self.positive = np.zeros((len(ids), windows), np.int64)

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """First anchor of a block, ids and labels of candidates, and their scores."""
        for batch in common.portions(batches, 1 << 20):
            there = np.asarray(batch["vec_id"].is_valid()) & np.asarray(batch["label"].is_valid())
            ids, labels = (np.asarray(batch[c].fill_null(0), np.int64) for c in ("vec_id", "label"))
            for rows, vectors in common.vector_blocks(batch):
                with np.errstate(over="ignore"):
                    whole = np.floor(self.scale * vectors)
                use = there[rows] & np.isfinite(whole).all(axis=1)
                rows, whole = rows[use], whole[use]
                if len(rows) and whole.shape[1] == self.vectors.shape[1]:
                    for a in range(0, len(self.ids), BLOCK):
                        yield a, ids[rows], labels[rows], products(self.vectors[a : a + BLOCK], whole)


class Kept:
    """The ``k`` best of each window seen so far: higher scores first, then smaller ids."""

    def __init__(self, windows: int, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64)] * 3
        self.least = np.full(windows, -MOST)

    def add(self, window: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(window):
            return
        w, i, s = (np.concatenate(x) for x in zip(self.rows, (window, ids, scores), strict=True))
        order = np.lexsort((i, -s, w))
        w, i, s = w[order], i[order], s[order]
        first = np.flatnonzero(np.diff(w, prepend=-1))
        place = np.arange(len(w)) - np.repeat(first, np.diff(first, append=len(w)))
        self.rows = [x[place < self.k] for x in (w, i, s)]
        self.least[w[place == self.k - 1]] = s[place == self.k - 1]


def _positives(wave: Wave, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept(len(wave.ids), k)
        for a, ids, labels, scores in wave.scored(batches):
            own = slice(a, a + len(scores))
            use = (labels[None, :] == wave.labels[own, None]) & (ids[None, :] != wave.ids[own, None])
            w, c = np.nonzero(use & (scores >= kept.least[own, None]))
            kept.add(w + a, ids[c], scores[w, c])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in kept.rows], ["anchor", "id", "score"])

    return run


def _negatives(wave: Wave, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = wave.low.shape[1]
        kept = Kept(wave.low.size, k)
        for a, ids, labels, scores in wave.scored(batches):
            own = slice(a, a + len(scores))
            other = labels[None, :] != wave.labels[own, None]
            least = np.maximum(kept.least.reshape(-1, windows)[own], wave.low[own])
            for p in range(windows):
                w, c = np.nonzero(other & (scores >= least[:, p, None]) & (scores <= wave.high[own, p, None]))
                kept.add((w + a) * windows + p, ids[c], scores[w, c])
        w, i, s = kept.rows
        anchor, p = w // windows, w % windows
        columns = (wave.ids[anchor], p, wave.positive[anchor, p], i, wave.high[anchor, p], s)
        names = ["anchor_id", "place", "positive_id", "negative_id", "positive_score", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)

    return run


def _mined(vectors: DataFrame, wave: Wave, positives: int, negatives: int, low: int) -> DataFrame:
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    found = vectors.mapInArrow(_positives(wave, positives), "anchor long, id long, score long")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    for row in found.collect():  # at most ``positives`` rows for each anchor of the wave
        at = row["anchor"], row["place"] - 1
        wave.positive[at] = row["id"]
        # low * positive <= 100 * negative <= 100 * positive, in whole numbers
        wave.low[at], wave.high[at] = -(-low * row["score"] // 100), row["score"]
    names = "anchor_id long, place long, positive_id long, negative_id long, positive_score long, negative_score long"
    mined = vectors.mapInArrow(_negatives(wave, negatives), names)
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """The best ``negatives`` rows of other labels that score from ``low`` percent of a positive's score up to that
    score, for each of the best ``positives`` rows of an anchor's own label.

    ``vectors`` and ``anchors`` have vec_id, embedding and label. The anchors of one wave take ``wave_bytes`` as doubles.
    """
    spark = vectors.sparkSession
    common.prepared(spark)
    typed = ["CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding", "CAST(label AS LONG) AS label"]
    vectors, anchors = vectors.selectExpr(*typed), anchors.selectExpr(*typed)
    finite = f"forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs({scale} * x) < double('infinity'))"
    anchors = anchors.filter(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {finite}")
    anchors = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("a")).select("vec_id", "a.*")
    anchors = saved(anchors.withColumn("size", F.size("embedding")), "anchors")
    sizes = {r["size"]: r["n"] for r in anchors.groupBy("size").agg(F.count("*").alias("n")).collect()}
    result = spark.createDataFrame([], RESULT)
    for size, n in sorted(sizes.items()):
        waves = -(-n * max(1, size) * 8 // wave_bytes)
        for w in range(waves):
            mine = anchors.filter((F.col("size") == size) & (F.expr(f"pmod(xxhash64(vec_id), {waves})") == w))
            rows = mine.orderBy("vec_id").collect()  # the anchors of one wave
            if rows:
                wave = Wave([r["vec_id"] for r in rows], [r["label"] for r in rows], [r["embedding"] for r in rows], scale, positives)
                result = result.union(saved(_mined(vectors, wave, positives, negatives, low), "negatives"))
    return result
