"""MinHash near-dedup: circulant MinHash, banding, exact verification.

A document is the set of its 5-word shingles (64-bit hashes). A first permutation scatters the shingles over
``CIRCLE`` places; coordinate k of the signature is the smallest value of a second permutation, shifted by k, at the
occupied places. The shifts of one place lie side by side, so a shingle's values for all coordinates are one
slice. ``BANDS`` bands of ``ROWS`` coordinates: a pair with similarity 0.75 shares none of them with probability
(1 - 0.75^5)^48, about 2 in a million, one with similarity 0.2 any of them with 0.015. So documents that
share boilerplate alone are seldom candidates.

Documents with equal sets are one node. Nodes that share a band are candidates; their connected
components are the only places where links can be. In these, links are confirmed on the full sets, in tiles of bounded
numbers of shingles and documents, counted a strip of pairs at a time, each of which returns a spanning forest, never its pairs. A component that fits into one tile is compared
whole. A larger one is first compared tile by tile, each along with the same first tile; then only nodes outside the
largest linked part are compared with all others. So many near copies of one text cost one pass, and no link is lost.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Fewer than five words: the whole sequence is the one shingle.
Null text or no words: the empty set, linked with nothing. Rows without an id take no part and are kept with a null
component. Of repeated ids each row is linked by its own text. Very long texts are one set each, whole, and have to fit
into a task. Ties (equal ids or texts) go to the smallest id, then to one row. An empty table gives no rows. Other columns are
ignored, and carried along by ``one_of_each`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved
from wayfare.llm.components import components
from wayfare.llm.subspace_join import Forest

SHINGLE, BANDS, ROWS = 5, 48, 5
CIRCLE, SEED = 1 << 21, 7
#: Shingles in one tile, and documents of a shingle from which its pairs are counted by a matrix product.
TILE, COMMON = 400_000, 64
#: A document takes up the room of so many shingles at least, so a tile has a bounded number of documents too.
LEAST = 100
#: Pairs of documents that are counted at once.
STRIP = 1 << 22
THRESHOLD = 75

_CIRCLE: list[np.ndarray] = []


def _circulant() -> np.ndarray:
    """Row p holds the values of place p under all shifts."""
    if not _CIRCLE:
        values = np.random.default_rng(SEED).permutation(CIRCLE).astype(np.int32)
        wide = np.concatenate([values, values[: BANDS * ROWS]])
        _CIRCLE.append(np.lib.stride_tricks.sliding_window_view(wide, BANDS * ROWS))
    return _CIRCLE[0]


def _place(h: np.ndarray) -> np.ndarray:
    """The first permutation, of the places to which the hashes point."""
    return ((h * np.uint64(0x9E3779B97F4A7C15 | 1) + np.uint64(SEED)) % np.uint64(CIRCLE)).astype(np.int64)


def shingle_sets(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, text by text, and their numbers."""
    starts, ends, counts = common.words(raw, at)
    h = common.word_hashes(raw, starts, ends, lower=True)
    shingles, first = common.shingle_hashes(h, counts, SHINGLE)
    text_ends = np.cumsum(counts)
    text_starts = text_ends - counts
    cut = np.searchsorted(first, np.concatenate([text_starts, text_ends[-1:]]))
    sets = []
    for k, n in enumerate(counts.tolist()):
        if n >= SHINGLE:
            sets.append(np.unique(shingles[cut[k] : cut[k + 1]]))
        else:
            whole = np.zeros(min(n, 1), np.uint64)
            for x in h[text_starts[k] : text_ends[k]]:
                whole = common.mixed(whole * np.uint64(common.BASE & (2**64 - 1)) + x)
            sets.append(whole)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def fingerprints(elements: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit fingerprints of each set; sums over its elements."""
    ends = np.cumsum(sizes)
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mixed(elements ^ np.uint64(salt)))])
        out.append(common.mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64))
    return out


def signatures(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All coordinates of every set; the largest value for an empty set."""
    circle, place = _circulant(), _place(elements)
    out = np.full((len(sizes), BANDS * ROWS), CIRCLE, np.int32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for i in range(0, len(place), 1 << 14):
        own = owner[i : i + (1 << 14)]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        low = np.minimum.reduceat(circle[place[i : i + (1 << 14)]], first, axis=0)
        out[own[first]] = np.minimum(out[own[first]], low)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = common.mixed(key * np.uint64(common.BASE & (2**64 - 1)) + parts[:, :, r])
    return key.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch, 1 << 22):
            elements, sizes = shingle_sets(*common.buffers(part["text"]))
            bands = band_keys(signatures(elements, sizes))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))
            marks = [pa.array(f) for f in fingerprints(elements, sizes)]
            columns = [part["doc_id"], part["text_key"], pa.array(sizes), *marks, lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "node", "check", "bands"])


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the documents that stand for a node."""
    for batch in batches:
        for part in common.slices(batch, 1 << 22):
            elements, sizes = shingle_sets(*common.buffers(part["text"]))
            same = fingerprints(elements, sizes)[0] == np.asarray(part["node"])
            bounds = 8 * np.concatenate([[0], np.cumsum(sizes)])
            whole = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(elements)])
            columns = [part["node"], part["part"], part["size"], whole]
            yield pa.RecordBatch.from_arrays(columns, ["node", "part", "size", "elements"]).filter(pa.array(same))


def _shared_counts(elements: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes of the intersections of all sets of a tile (right above the diagonal), in strips of few sets against all."""
    n = len(sizes)
    _, column, df = np.unique(elements, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    order = np.argsort(column, kind="stable")
    order = order[df[column[order]] > 1]
    row, many = row[order], df[column[order]]
    column = np.cumsum(np.diff(column[order], prepend=-1) > 0) - 1
    dense = many > max(COMMON, n // 16)  # in a wide tile a product pays for the most frequent shingles only
    last = np.searchsorted(column, column, side="right")  # the rows of a shingle ascend: its pairs are (place, later place)
    by_row = np.flatnonzero(~dense)
    by_row = by_row[np.argsort(row[by_row], kind="stable")]
    dense_row, (_, dense_column) = row[dense], np.unique(column[dense], return_inverse=True)
    step = max(1, STRIP // max(1, n))
    for i in range(0, n, step):
        height = min(step, n - i)
        counts = np.zeros(height * n, np.float32)
        mine = by_row[slice(*np.searchsorted(row[by_row], [i, i + height]))]
        later = last[mine] - mine - 1
        ends = np.cumsum(later)
        k = 0
        while k < len(mine):
            j = max(k + 1, int(np.searchsorted(ends, ends[k] - later[k] + STRIP)))
            some, own = later[k:j], mine[k:j]
            other = np.arange(int(some.sum())) + np.repeat(own + 1 - (np.cumsum(some) - some), some)
            pair = np.repeat((row[own] - i) * n, some) + row[other]
            if len(pair) * 8 < len(counts):
                key, c = np.unique(pair, return_counts=True)
                counts[key] += c
            else:
                counts += np.bincount(pair, minlength=len(counts))
            k = j
        counts = counts.reshape(height, n)
        wide = max(1, min(2048, STRIP // max(1, n)))
        for k in range(0, int(dense_column.max(initial=-1)) + 1, wide):
            at = (dense_column >= k) & (dense_column < k + wide) & (dense_row >= i)
            block = np.zeros((n - i, wide), np.float32)
            block[dense_row[at] - i, dense_column[at] - k] = 1
            counts[:, i:] += block[:height] @ block.T
        yield i, counts


def _linked(tile: pa.Table) -> pa.Table:
    """A spanning forest of the confirmed links in a tile."""
    tile = tile.combine_chunks()
    node, once = np.unique(np.asarray(tile["node"]), return_index=True)  # repeated rows give a node again
    tile = tile.take(pa.array(once))
    sets = [np.frombuffer(x, np.uint64) for x in tile["elements"].to_pylist()]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    forest = Forest(len(sets))
    if len(sets) > 1:
        for start, counts in _shared_counts(np.concatenate(sets), sizes):
            for i, row in enumerate(counts, start):
                inter = row[i + 1 :]
                j = np.flatnonzero(100 * inter >= THRESHOLD * (sizes[i] + sizes[i + 1 :] - inter)) + i + 1
                if len(j):
                    forest.join(np.full(len(j), i), j)
    a, b = forest.edges()
    return pa.table({"a": pa.array(node[a], pa.int64()), "b": pa.array(node[b], pa.int64())})


def _confirm(sets: DataFrame, keys: list[str]) -> DataFrame:
    return saved(sets.select(*keys, "node", "elements").groupBy(*keys).applyInArrow(_linked, "a long, b long"), "confirmed")


def _room(shingles: str) -> Column:
    return F.greatest(F.expr(shingles), F.lit(LEAST))


def _tiles(size: str) -> Column:
    return F.ceil(F.col(size) / TILE).cast("int")


def confirmed_links(sets: DataFrame) -> DataFrame:
    """Forest (a, b) of the links among candidates (node, part, size: room of the part, elements)."""
    room = _room("octet_length(elements) DIV 8")
    total = sets.agg(F.sum(room)).first()[0] or 0
    bins = max(1, -(-total // TILE))
    placed = sets.withColumn("tiles", _tiles("size"))
    small = placed.filter("tiles <= 1").withColumn("bin", F.pmod(F.xxhash64("part"), F.lit(bins)))
    links = _confirm(small, ["bin"])
    large = placed.filter("tiles > 1").withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int"))
    first_with_all = F.when(F.col("tile") == 0, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))
    dealt = large.withColumn("with", F.explode(first_with_all))
    if large.isEmpty():
        return links
    tiled = _confirm(dealt, ["part", "with"])
    links = links.union(tiled)
    # nodes of large parts outside the largest linked set of their part, against all of the part
    linked = large.select("part", "node", room.alias("room"))
    linked = linked.join(components(tiled).withColumnRenamed("id", "node"), "node", "left")
    linked = linked.withColumn("component", F.coalesce("component", "node"))
    sums = linked.groupBy("part", "component").agg(F.count("*").alias("n"))
    best = sums.groupBy("part").agg(F.max(F.struct("n", "component"))["component"].alias("main"))
    rest = saved(linked.join(best, "part").filter("component <> main").select("part", "node", "room"), "outside")
    if rest.isEmpty():
        return links
    outside = rest.groupBy("part").agg(F.ceil(F.sum("room") / TILE).cast("int").alias("outer_tiles"))
    all_rows = large.join(outside, "part").join(rest.select("node", F.lit(True).alias("out")), "node", "left")
    outer = F.pmod(F.xxhash64("node", F.lit(2)), F.col("outer_tiles")).cast("int")
    pairs = F.flatten(
        F.array(
            F.when(F.col("out"), F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(outer.alias("o"), t.alias("t")))).otherwise(F.array()),
            F.transform(F.sequence(F.lit(0), F.col("outer_tiles") - 1), lambda o: F.struct(o.alias("o"), F.col("tile").alias("t"))),
        )
    )
    dealt = all_rows.withColumn("at", F.explode(F.array_distinct(pairs))).select("part", "at.o", "at.t", "node", "elements")
    return links.union(_confirm(dealt, ["part", "o", "t"]))


def near_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key (hash of the text) for every document."""
    common.prepared(docs.sparkSession)
    docs = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text", "xxhash64(text) AS text_key")
    schema = "doc_id long, text_key long, n_shingles long, node long, check long, bands array<long>"
    signed = saved(docs.mapInArrow(_signed, schema), "signed")
    there = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    banded = there.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    buckets = saved(buckets.select("band", "low"), "buckets")
    candidates = banded.join(buckets, "band").filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    parts = components(candidates.distinct()).select(F.col("id").alias("node"), F.col("component").alias("part"))
    nodes = there.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n")).join(parts, "node")
    nodes = saved(nodes, "nodes")
    nodes = nodes.join(nodes.groupBy("part").agg(F.sum(_room("n")).alias("size")), "part").select("doc_id", "node", "part", "size")
    texts = docs.join(nodes.hint("merge"), "doc_id").select("node", "part", "size", "text")
    sets = saved(texts.mapInArrow(_filled, "node long, part long, size long, elements binary"), "sets")
    linked = components(confirmed_links(sets)).withColumnRenamed("id", "node")
    placed = signed.select("doc_id", "text_key", "n_shingles", "node").join(linked, "node", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    placed = placed.withColumn("component", F.when(alone, None).otherwise(F.coalesce("component", "node")))
    lowest = placed.groupBy("component").agg(F.min("doc_id").alias("lowest")).filter("component IS NOT NULL")
    result = placed.join(lowest, "component", "left").withColumn("component_id", F.coalesce("lowest", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return result.select("doc_id", "n_shingles", "component_id", kept, "text_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document, with all its columns, of every group of near copies; equal rows become one."""
    names, docs = docs.columns, common.carried(docs)
    kept = near_documents(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_key"))
    return docs.join(kept.distinct(), same).dropDuplicates(["_id", "_key"]).select(docs.columns).toDF(*names)
