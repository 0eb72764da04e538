"""Packing: sum-of-squares placement of documents into token windows.

Every task packs the documents of its partition as they come. It counts its partially filled
windows by fill level in one array; a document goes to the level (or a new window) after which the sum
of the squared counts is smallest, the fullest such level at a tie. Documents longer than a window give
full windows first. A task holds at most ``most_open`` open windows: for each one more, the fullest is filled up
from the emptiest and closed, and all others stay as they are. When a task ends, the open ones are joined end to end and
cut into full windows; what is left is cut at powers of two. So nothing is padded.

The same input split gives the same sequences again, so a repeated task changes nothing.
A null or empty text has one token, the closing id. A null id stays null; repeated rows are documents of their own. Very
long texts are tokenized whole and cut at the window. Of equal levels any window is as good: the one opened last is
taken. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wayfare.llm import common
from wayfare.llm.token_counts import chunk_store

#: Open windows of a task, if the caller names no other number.
MOST_OPEN = 512
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: doc_id, first token's place in the document, ids as bytes, tokens of the document
Piece = tuple[object, int, bytes, int]


class LevelPacker:
    """Open windows by fill level, and the rows of closed ones."""

    def __init__(self, window: int, first_sequence: int, most_open: int = MOST_OPEN):
        if most_open < 1:
            raise ValueError("a task needs at least one open window")
        self.window, self.next_sequence, self.most_open = window, first_sequence, most_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_sequence, at))
            at += n
        self.next_sequence += 1

    def best_level(self, size: int) -> int:
        """The level whose window takes the piece; 0 is a new window."""
        room = self.window - size
        levels = np.flatnonzero(self.level[1 : room + 1]) + 1
        if not len(levels):
            return 0
        to = levels + size
        change = 1 - 2 * self.level[levels] + np.where(to < self.window, 2 * self.level[to] + 1, 0)
        k = len(change) - 1 - int(np.argmin(change[::-1]))
        return int(levels[k]) if change[k] <= 2 * self.level[size] + 1 else 0

    def place(self, piece: Piece) -> None:
        size = len(piece[2]) // 4
        at = self.best_level(size)
        pieces = self._taken(at) if at else []
        pieces.append(piece)
        self._put(pieces, at + size)
        while self.n_open > self.most_open:
            self._top_up()

    def _taken(self, level: int) -> list[Piece]:
        self.level[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, pieces: list[Piece], fill: int) -> None:
        if fill == self.window:
            self.close(pieces)
        else:
            self.open.setdefault(fill, []).append(pieces)
            self.level[fill] += 1
            self.n_open += 1

    def add(self, doc: object, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.window
        full = len(ids) // step * step
        for a in range(0, full, step):
            self.close([(doc, a // 4, ids[a : a + step], total)])
        if len(ids) > full:
            self.place((doc, full // 4, ids[full:], total))

    def _top_up(self) -> None:
        """Fill the fullest open window from the emptiest ones; what is left of the last of these stays open."""
        fill = int(np.flatnonzero(self.level)[-1])
        pieces = self._taken(fill)
        while fill < self.window and self.n_open:
            level = int(np.flatnonzero(self.level)[0])
            rest = self._taken(level)
            while rest and fill < self.window:
                doc, start, ids, total = rest.pop()
                cut = 4 * (self.window - fill)
                if len(ids) > cut:
                    rest.append((doc, start + cut // 4, ids[cut:], total))
                    ids = ids[:cut]
                pieces.append((doc, start, ids, total))
                fill += len(ids) // 4
                level -= len(ids) // 4
            if rest:
                self._put(rest, level)
        self._put(pieces, fill)

    def flush(self) -> None:
        """Cut the open windows, end to end, into full ones, and the rest at powers of two."""
        waiting = [p for fill in sorted(self.open) for window in self.open[fill] for p in window]
        left = sum(len(p[2]) for p in waiting) // 4
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        waiting.reverse()
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            taken, fill = [], 0
            while fill < size:
                doc, start, ids, total = waiting.pop()
                cut = 4 * (size - fill)
                if len(ids) > cut:
                    waiting.append((doc, start + cut // 4, ids[cut:], total))
                    ids = ids[:cut]
                taken.append((doc, start, ids, total))
                fill += len(ids) // 4
            left -= size
            self.close(taken)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        self.rows = []
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(docs: DataFrame, path: str, window: int = 4096, closing: int = 2, most_open: int = MOST_OPEN) -> DataFrame:
    """One row for each piece of a document in a sequence; a task holds ``most_open`` windows of ids at most."""
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = chunk_store(path, counts_only=False)
        packer = LevelPacker(window, TaskContext.get().partitionId() << 40, most_open)
        for part in common.portions(batches):
            for doc, ids in zip(part["doc_id"].to_pylist(), store.texts(part["text"].to_pylist()), strict=True):
                packer.add(doc, ids + end)
            yield packer.take()
        packer.flush()
        yield packer.take()

    common.prepared(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, SCHEMA)
