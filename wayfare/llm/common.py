"""Parts that the text operators share: tables, saved results, and cutting and hashing words in numpy."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wayfare
from wayfare.sources import scratch

#: Rows in one Arrow batch: long texts then stay within a worker's memory.
BATCH_ROWS = 512
#: Bytes of text hashed at once.
HASH_BYTES = 1 << 20
#: Longer words are hashed one by one.
LONG_WORD = 1024

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20160101)
BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_random.integers(1, 2**62)) * 2 + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def carried(docs: DataFrame) -> DataFrame:
    """The documents with all columns but doc_id and text under names that no step uses; the names come back by position."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"carried_{i}" for i, c in enumerate(docs.columns)])


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps depend on no executor."""
    path = scratch.run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepared(spark: SparkSession) -> None:
    """Ready for Python tasks: workers can import this package, and an Arrow batch holds at most BATCH_ROWS rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if any(f.rsplit("/", 1)[-1] == "wayfare.zip" for f in context.listFiles):
        return
    package = Path(wayfare.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "wayfare.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves this remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each starts (one more at the end). A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each text."""
    inside = ~IS_SPACE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = at[:-1], at[1:]
    full = ends > begins
    first[begins[full]] = inside[begins[full]]
    last[ends[full] - 1] = inside[ends[full] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, at))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE & (2**64 - 1), np.uint64), np.full(n, pow(BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP_DOWN: list[np.ndarray] = []


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word: a random code for each byte, weighted by its place, bits mixed."""
    if not _UP_DOWN:
        _UP_DOWN.extend(_powers(HASH_BYTES + LONG_WORD))
    up, down = _UP_DOWN
    code = BYTE_CODE[LOWER] if lower else BYTE_CODE
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + HASH_BYTES)))
        a, b = starts[i:j] - starts[i], np.minimum(ends[i:j] - starts[i], HASH_BYTES + LONG_WORD)
        sums = np.zeros(int(b[-1]) + 1, np.uint64)
        np.cumsum(code[raw[starts[i] : starts[i] + b[-1]]] * up[: b[-1]], out=sums[1:])
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    out = mixed(out + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in np.flatnonzero(lengths > LONG_WORD):
        word = raw[starts[k] : ends[k]]
        digest = hashlib.blake2b((LOWER[word] if lower else word).tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def shingle_hashes(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size`` consecutive words within one text, and the index of its first word."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(BASE & (2**64 - 1)) + h[k : k + n])
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return out[at], at


def slices(batch: pa.RecordBatch, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes; one longer text is a part of its own."""
    if not batch.num_rows:
        return
    size = batch.nbytes / batch.num_rows
    if batch.nbytes <= most:
        yield batch
        return
    step = max(1, int(most / size))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def portions(batches: Iterator[pa.RecordBatch], least: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold ``least`` bytes; larger ones in parts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch):
            held.append(part)
            if sum(p.nbytes for p in held) >= least:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def vector_blocks(batch: pa.RecordBatch, column: str = "embedding") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors (as doubles) of the batch, by dimension; rows that are null, or hold null or
    non-finite components, are left out."""
    vectors = batch[column]
    if not len(vectors):
        return
    flat = vectors.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")), np.float64)
    lengths = np.asarray(vectors.value_lengths().fill_null(-1), np.int64)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
    for n in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == n)
        block = values[starts[rows, None] + np.arange(n)]
        good = np.isfinite(block).all(axis=1)
        if good.any():
            yield rows[good], block[good]
