"""Token counts: rank-synchronous merging over ragged arrays.

The pieces of a batch lie end to end in one array of symbols. Each round finds the lowest rank
among the neighbouring pairs of every piece, merges that pair at all its places in all pieces at
once, and looks up only the pairs that the merges have touched. A piece leaves when none of its
pairs has a rank; the symbols that survive are its tokens.

Null or empty text: 0 tokens. A repeated row or id: one result for each row. Of equal ranks in a piece all places merge, from the
left. Very long texts are counted whole, and have to fit into a task. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wayfare.llm import common
from wayfare.llm.vocabulary import STORE, WordVocabulary, listed

NO_RANK = np.int32(2**31 - 1)


class Merges:
    """Pairs of symbols, sorted for binary search, with their ranks and products."""

    def __init__(self, vocabulary: WordVocabulary):
        model = vocabulary.spec["model"]
        ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.base = np.int64(max(ids.values()) + 1)
        keys = np.array([ids[a] * int(self.base) + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.inner = np.array([ids[c] for c in vocabulary.letters], np.int32)
        self.last = np.array([ids[c + end] for c in vocabulary.letters], np.int32)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.made[at]

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, end to end, and the number of ids of each piece (none is empty)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbol = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbol[ends] = self.last[raw[ends]]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        counts = np.zeros(len(pieces), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self._pairs(symbol, piece)
        while len(symbol):
            first = np.flatnonzero(np.diff(piece, prepend=-1))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(piece))
            ready = low == NO_RANK
            if ready.any():
                counts[piece[first[ready]]] = size[ready]
                out = np.repeat(ready, size)
                done.append((piece[out], symbol[out]))
                stay = np.flatnonzero(~out)
                symbol, piece, rank, made = (x[stay] for x in (symbol, piece, rank, made))
                low, size = low[~ready], size[~ready]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # a pair of equal symbols can overlap itself
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            keep = np.flatnonzero(keep)
            symbol, piece, rank, made = (x[keep] for x in (symbol, piece, rank, made))
            new = at - np.arange(len(at))
            self._refresh(symbol, piece, rank, made, np.concatenate([new, new[new > 0] - 1]))
        order = np.argsort(np.concatenate([p for p, _ in done]), kind="stable") if done else np.zeros(0, int)
        return (np.concatenate([s for _, s in done])[order] if done else np.zeros(0, np.int64)), counts

    def _pairs(self, symbol: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(symbol), NO_RANK), np.zeros(len(symbol), np.int32)
        self._refresh(symbol, piece, rank, made, np.arange(len(symbol)))
        return rank, made

    def _refresh(self, symbol, piece, rank, made, at) -> None:
        rank[at] = NO_RANK
        at = at[at < len(symbol) - 1]
        at = at[piece[at] == piece[at + 1]]
        rank[at], made[at] = self.look_up(symbol[at], symbol[at + 1])


class Ragged:
    """Growing lists of whole numbers, end to end."""

    def __init__(self):
        self.flat, self.starts, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64), 0
        self.sizes, self.used = np.zeros(0, np.int64), 0

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        flat_room, room = self.used + len(flat), self.n + len(sizes)
        if flat_room > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(2 * flat_room - self.used, np.int32)])
        if room > len(self.sizes):
            more = np.zeros(2 * room - self.n, np.int64)
            self.starts, self.sizes = (np.concatenate([x[: self.n], more]) for x in (self.starts, self.sizes))
        self.flat[self.used : flat_room] = flat
        self.sizes[self.n : room] = sizes
        self.starts[self.n : room] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = room, flat_room

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The lists of these rows, end to end."""
        sizes = self.sizes[rows]
        shift = self.starts[rows] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class ChunkStore:
    """The ids found for each chunk and for each piece of one; emptied before the chunks would pass the bound."""

    def __init__(self, vocabulary: WordVocabulary, merges: Merges, counts_only: bool):
        self.vocabulary, self.merges, self.counts_only = vocabulary, merges, counts_only
        if any(m.split() != [m] for m in vocabulary.marks):
            raise ValueError("a special string with white space in it")
        self._empty()

    def _empty(self) -> None:
        # No other chunk equals a special string: wherever it occurs, it is a part of its own.
        marks = self.vocabulary.marks
        self.numbers: dict[str, int] = {m: k for k, m in enumerate(marks)}
        self.chunks = Ragged()
        self.chunks.extend(np.array(list(marks.values()), np.int32), np.ones(len(marks), np.int64))
        self.piece_numbers: dict[str, int] = {}
        self.pieces = Ragged()

    def _learn(self, chunks: list[str]) -> None:
        found, sizes = self.vocabulary.all_pieces(chunks)
        different = listed(found.dictionary)
        number = list(map(self.piece_numbers.get, different))
        new = [k for k, n in enumerate(number) if n is None]
        if new:
            pieces = [different[k] for k in new]
            numbers = range(len(self.piece_numbers), len(self.piece_numbers) + len(new))
            self.pieces.extend(*self.merges.merged([p.encode() for p in pieces]))
            self.piece_numbers.update(zip(pieces, numbers))
            for k, n in zip(new, numbers):
                number[k] = n
        rows = np.array(number, np.int64)[np.asarray(found.indices)]
        ends = np.concatenate([[0], np.cumsum(self.pieces.sizes[rows])])
        last = np.cumsum(sizes)
        self.numbers.update(zip(chunks, range(self.chunks.n, self.chunks.n + len(chunks))))
        self.chunks.extend(self.pieces.gather(rows), ends[last] - ends[last - sizes])

    def texts(self, texts: list[str | None]) -> list:
        """For each text the number of its tokens, or their ids as bytes."""
        whole = pa.array([" ".join(self.vocabulary.parts(t or "")) for t in texts], pa.large_string())
        cut = pc.ascii_split_whitespace(whole)
        words = cut.flatten()
        full = np.asarray(pc.binary_length(words)) > 0  # white space at an end leaves an empty word there
        n_words = np.concatenate([[0], np.cumsum(full)])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]
        coded = words.filter(pa.array(full)).dictionary_encode()
        different = listed(coded.dictionary)
        number = list(map(self.numbers.get, different))
        new = [k for k, n in enumerate(number) if n is None]
        if len(self.numbers) + len(new) > STORE:
            self._empty()
            number = list(map(self.numbers.get, different))
            new = [k for k, n in enumerate(number) if n is None]
        if new:
            first = self.chunks.n
            self._learn([different[k] for k in new])
            for n, k in enumerate(new, first):
                number[k] = n
        rows = np.array(number, np.int64)[np.asarray(coded.indices)]
        ends = np.concatenate([[0], np.cumsum(self.chunks.sizes[rows])])[n_words]
        if self.counts_only:
            return np.diff(ends).tolist()
        ids, ends = self.chunks.gather(rows).astype("<u4").tobytes(), (4 * ends).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


_STORES: dict[tuple[str, bool], ChunkStore] = {}


def chunk_store(path: str, counts_only: bool) -> ChunkStore:
    """This worker's store for a vocabulary file."""
    if (path, counts_only) not in _STORES:
        vocabulary = WordVocabulary(path)
        _STORES[path, counts_only] = ChunkStore(vocabulary, Merges(vocabulary), counts_only)
    return _STORES[path, counts_only]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than ``limit`` tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = chunk_store(path, counts_only=True)
        for part in common.portions(batches):
            n = pa.array(store.texts(part["text"].to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], n], ["doc_id", "n_bytes", "n_tokens"])

    common.prepared(docs.sparkSession)
    counted = docs.selectExpr("doc_id", "text", "CAST(octet_length(coalesce(text, '')) AS LONG) AS n_bytes").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.selectExpr("*", f"n_tokens > {int(limit)} AS over_limit")
