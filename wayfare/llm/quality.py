"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its lower-cased words, hashed into buckets and weighted by their counts at length 1, and
statistics of its form (shares of capitals, digits, signs and white space, word and line lengths, repetition)
and its stated length, each as one of a few levels. Every feature has a weight and a vector of low rank; a score adds the
weights and all pairwise products, the latter in linear time by the sum-of-squares identity:
the sum over i < j of <v_i, v_j> x_i x_j is half of |sum v_i x_i|^2 - sum |v_i x_i|^2.

It is fitted by Adagrad on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id, in one task.
Labels, language, source and id are no features.

Null text: as empty; it is scored by its form alone. Null n_chars: a level of its own. Rows without a quality do not train;
a document with several labels trains with the lowest. Without any labels every score is 0.5. Repeated rows are
scored each; ties of the hash go to the smaller id. Very long texts count whole. An empty table gives no rows. Other columns are
ignored, and carried along by ``good_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import held_out

#: Labelled rows to fit on, at most.
SAMPLE = 20_000
BUCKETS, LEVELS, STATISTICS, RANK = 1 << 16, 16, 12, 8
SIZE = BUCKETS + LEVELS * STATISTICS
EPOCHS, ROWS, RATE, DECAY, SEED = 20, 512, 0.1, 1e-5, 6
#: Weight of a level beside words of total length 1.
LEVEL_WEIGHT = 0.5
THRESHOLD = 0.3

_CLASSES = np.zeros((4, 256), bool)
_CLASSES[0, 65:91] = True
_CLASSES[1, 48:58] = True
_CLASSES[2, [b for b in range(33, 127) if not chr(b).isalnum()]] = True
_CLASSES[3, 128:] = True


def _per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return np.diff(sums[at]).astype(np.float64)


def features(raw: np.ndarray, at: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values, text by text, and the number of features of each text."""
    n = len(at) - 1
    starts, ends, counts = common.words(raw, at)
    bucket = (common.word_hashes(raw, starts, ends, lower=True) % np.uint64(BUCKETS)).astype(np.int64)
    text = np.repeat(np.arange(n), counts)
    key, tf = np.unique(text * BUCKETS + bucket, return_counts=True)
    of = key // BUCKETS
    norm = np.sqrt(np.bincount(of, tf.astype(np.float64) ** 2, minlength=n))
    size = np.maximum(np.diff(at), 1)
    n_words = np.maximum(counts, 1)
    lines = _per_text(raw == 10, at) + 1
    distinct = np.bincount(of, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, of, tf)
    shares = [_per_text(c[raw], at) / size for c in _CLASSES]
    share = lambda x: np.sqrt(np.clip(x, 0, 1)) * (LEVELS - 1)
    levels = [
        *map(share, shares),
        share(_per_text(common.IS_SPACE[raw], at) / size),
        share(distinct / n_words),
        share(most / n_words),
        share(1 - shares[2] - shares[3]),
        np.bincount(text, ends - starts, minlength=n) / n_words,
        np.log2(n_words + 1),
        np.log2(counts / lines + 1) * 2,
        np.where(np.isnan(n_chars), LEVELS - 1, np.minimum(np.log2(np.maximum(np.nan_to_num(n_chars), 0) + 1) / 1.5, LEVELS - 2)),
    ]
    level = np.clip(np.array(levels), 0, LEVELS - 1).astype(np.int64)
    form = BUCKETS + np.arange(STATISTICS)[:, None] * LEVELS + level
    index = np.concatenate([key % BUCKETS, form.T.ravel()])
    value = np.concatenate([tf / norm[of], np.full(n * STATISTICS, LEVEL_WEIGHT)])
    owner = np.concatenate([of, np.repeat(np.arange(n), STATISTICS)])
    order = np.argsort(owner, kind="stable")
    return index[order].astype(np.int32), value[order].astype(np.float32), np.bincount(owner, minlength=n)


class Machine:
    """Bias, weights and vectors; all as float32."""

    def __init__(self):
        self.bias = np.float32(0)
        self.weight = np.zeros(SIZE, np.float32)
        self.vector = np.random.default_rng(SEED).normal(0, 0.01, (SIZE, RANK)).astype(np.float32)

    def _sums(self, index, value, counts):
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        vx = self.vector[index] * value[:, None]
        s = np.add.reduceat(vx, first, axis=0)
        linear = np.add.reduceat(self.weight[index] * value, first)
        return vx, s, self.bias + linear + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), first))

    def scores(self, index, value, counts) -> np.ndarray:
        """Probability of label 1; every text has at least its form features."""
        y = self._sums(index, value, counts)[2]
        return 1 / (1 + np.exp(-np.clip(y, -30, 30).astype(np.float64)))

    def fit(self, index, value, counts, label) -> None:
        ends = np.concatenate([[0], np.cumsum(counts)])
        seen = [np.full(SIZE, 1e-6, np.float64), np.full((SIZE, RANK), 1e-6, np.float64), 1e-6]
        random = np.random.default_rng(SEED)
        for _ in range(EPOCHS):
            order = random.permutation(len(label))
            for k in range(0, len(order), ROWS):
                rows = order[k : k + ROWS]
                at = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows])
                i, x, n = index[at], value[at], counts[rows]
                vx, s, y = self._sums(i, x, n)
                slope = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[rows]) / len(rows)
                g = np.repeat(slope, n) * x
                used, place = np.unique(i, return_inverse=True)
                gw = np.bincount(place, g) + DECAY * self.weight[used]
                each = g[:, None] * (np.repeat(s, n, axis=0) - vx)
                gv = np.stack([np.bincount(place, each[:, f]) for f in range(RANK)], axis=1) + DECAY * self.vector[used]
                gb = slope.sum()
                seen[0][used] += gw**2
                seen[1][used] += gv**2
                seen[2] += gb**2
                self.weight[used] -= (RATE * gw / np.sqrt(seen[0][used])).astype(np.float32)
                self.vector[used] -= (RATE * gv / np.sqrt(seen[1][used])).astype(np.float32)
                self.bias -= np.float32(RATE * gb / np.sqrt(seen[2]))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in common.slices(batch):
            chars = np.asarray(part["n_chars"].cast(pa.float64()).fill_null(float("nan")), np.float64)
            yield part, *features(*common.buffers(part["text"]), chars)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, index, value, counts in _featured(batches):
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (index, value)]
        yield pa.RecordBatch.from_arrays([part["doc_id"], part["quality"], *lists], ["doc_id", "quality", "i", "x"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine, tables = Machine(), [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if tables:
        rows = pa.concat_tables(tables).sort_by([("doc_id", "ascending"), ("quality", "ascending")]).combine_chunks()
        index, value = (np.asarray(rows[c].combine_chunks().flatten()) for c in ("i", "x"))
        counts = np.asarray(rows["i"].combine_chunks().value_lengths(), np.int64)
        machine.fit(index, value, counts, np.asarray(rows["quality"], np.float32))
    else:
        machine.vector[:] = 0
    parts = [machine.weight.tobytes(), machine.vector.tobytes(), np.float32(machine.bias).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["weight", "vector", "bias"])


def _input(docs: DataFrame) -> DataFrame:
    chars = "n_chars" if "n_chars" in docs.columns else "NULL"
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text", f"CAST({chars} AS DOUBLE) AS n_chars")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """The machine fitted on at most ``sample`` labelled documents outside the held-out ids."""
    common.prepared(docs.sparkSession)
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(5, 0))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = known.withColumn("_rank", F.xxhash64(F.col("doc_id").cast("long"))).orderBy("_rank", "doc_id").limit(sample).drop("_rank")
    rows = _input(docs).join(F.broadcast(known), "doc_id")
    sampled = rows.select("doc_id", "quality", "text", "n_chars").mapInArrow(
        _sampled, "doc_id long, quality int, i array<int>, x array<float>"
    )
    row = sampled.repartition(1).mapInArrow(_fitted, "weight binary, vector binary, bias binary").first()
    machine = Machine()
    machine.weight = np.frombuffer(row["weight"], np.float32)
    machine.vector = np.frombuffer(row["vector"], np.float32).reshape(SIZE, RANK)
    machine.bias = np.frombuffer(row["bias"], np.float32)[0]
    return machine


def score_quality(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted for each document."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, index, value, counts in _featured(batches):
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(model.value.scores(index, value, counts), pa.float64())], ["doc_id", "score"]
            )

    common.prepared(docs.sparkSession)
    scored = _input(docs).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that the classifier accepts."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                n_chars = part["n_chars"] if "n_chars" in part.schema.names else pa.nulls(part.num_rows)
                chars = np.asarray(n_chars.cast(pa.float64()).fill_null(float("nan")), np.float64)
                scores = model.value.scores(*features(*common.buffers(part["text"]), chars))
                yield part.filter(pa.array(scores >= threshold))

    common.prepared(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)
