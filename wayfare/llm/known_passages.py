"""Substring dedup against a given reference: broadcast suffix automata, documents streamed past them.

The other form of ``substrings``, for a reference that is known and bounded (benchmark items, licences) instead of the
documents themselves. A word goes if ``WINDOW`` consecutive words that cover it stand in one reference text.

Reference texts are cut into pieces of ``PIECE`` windows; neighbouring pieces share ``WINDOW`` - 1 words, so each window lies
whole in one. Different pieces are dealt by hash to shards of about ``SHARD`` words. A task builds a shard's suffix
automaton and returns it as arrays; ``AT_ONCE`` automata are broadcast for one pass over the documents. In a pass each stretch of words that
the shard knows streams through the automaton, which gives at each word the longest match that ends there (the matching
statistic); from ``WINDOW`` on its words are marked. Marks of several passes add up, and the maximal spans that they
cover are removed at the end. A reference of more than ``most_words`` words is refused before any broadcast.

Null, empty and short reference texts hold no window; an empty reference removes nothing. Documents are judged one by one,
rows with null or repeated ids too. Null text: no words; it stays null, or becomes empty without ``layout``. Very long texts are judged whole
and have to fit into a task. An empty table gives an empty one. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.llm import common
from wayfare.llm.common import saved
from wayfare.llm.substrings import WINDOW, SuffixAutomaton, kept_text

#: Windows of a piece; words of a shard, about; shards of one pass.
PIECE, SHARD, AT_ONCE = 10_000, 100_000, 4
#: Words of the reference, if the caller names no other bound.
MOST_WORDS = 2_000_000

AUTOMATON = "shard int, state binary, word binary, target binary, link binary, length binary"


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of all texts in a row, and the number of words of each."""
    raw, at = common.buffers(texts)
    starts, ends, counts = common.words(raw, at)
    return (common.word_hashes(raw, starts, ends, lower=False) >> np.uint64(32)).astype("<u4"), counts


def _pieces(windows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                code, counts = _coded(part["text"])
                rows = []
                for a, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
                    for s in range(0, n - WINDOW + 1, windows):
                        rows.append(code[a + s : a + min(n, s + windows + WINDOW - 1)].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["words"])

    return run


def _built(key: tuple, shard: pa.Table) -> pa.Table:
    """The automaton of a shard: its transitions, and link and length of each state."""
    automaton = SuffixAutomaton()
    for k, piece in enumerate(sorted(shard["words"].to_pylist())):
        automaton.add(-1 - k)  # no document has it, so no match crosses it
        for word in np.frombuffer(piece, "<u4").tolist():
            automaton.add(word)
    ways = [(state, word, to) for state, nexts in enumerate(automaton.next) for word, to in nexts.items() if word >= 0]
    state, word, target = np.array(ways, np.int64).reshape(-1, 3).T
    arrays = [state.astype("<u4"), word.astype("<u4"), target.astype("<u4"), np.array(automaton.link, "<i4"), np.array(automaton.length, "<i4")]
    columns = [pa.array([key[0].as_py()], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)]
    return pa.table(columns, [c.split()[0] for c in AUTOMATON.split(", ")])


class Matcher:
    """A shard's automaton as documents stream past it."""

    def __init__(self, state: bytes, word: bytes, target: bytes, link: bytes, length: bytes):
        words = np.frombuffer(word, "<u4")
        ways = np.frombuffer(state, "<u4").astype(np.int64) << 32 | words
        self.to = dict(zip(ways.tolist(), np.frombuffer(target, "<u4").tolist(), strict=True))
        self.link, self.length = (np.frombuffer(x, "<i4").tolist() for x in (link, length))
        self.words = np.unique(words)

    def statistics(self, words: list[int]) -> Iterator[int]:
        """At each word the length of the longest match that ends there."""
        to, link, length = self.to, self.link, self.length
        state = matched = 0
        for word in words:
            following = to.get(state << 32 | word)
            while following is None and state:
                state = link[state]
                matched = length[state]
                following = to.get(state << 32 | word)
            if following is not None:
                state, matched = following, matched + 1
            yield matched

    def covered(self, code: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which words of the texts lie in a match of ``WINDOW`` words or more."""
        change = np.zeros(len(code) + 1, np.int64)
        known = np.isin(code, self.words)
        cut = np.zeros(len(code) + 1, bool)
        cut[np.concatenate([[0], np.cumsum(counts)])] = True
        cut[1:-1] |= known[1:] != known[:-1]
        edges = np.flatnonzero(cut)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if known[a] and b - a >= WINDOW:
                for i, n in enumerate(self.statistics(code[a:b].tolist()), a + 1):
                    if n >= WINDOW:
                        change[i - WINDOW] += 1
                        change[i] -= 1
        return np.cumsum(change[:-1]) > 0


def _marked(shards) -> Callable:
    """Adds what the shards cover to the marks, eight words to a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(*s) for s in shards.value]
        for batch in batches:
            for part in common.slices(batch):
                code, counts = _coded(part["text"])
                gone = np.zeros(len(code), bool)
                for m in matchers:
                    gone |= m.covered(code, counts)
                marks = []
                for mark, before in zip(np.split(gone, np.cumsum(counts)[:-1]), part["_gone"].to_pylist(), strict=True):
                    mark = np.packbits(mark)
                    marks.append((mark | np.frombuffer(before, np.uint8) if before else mark).tobytes())
                yield part.set_column(part.schema.get_field_index("_gone"), "_gone", pa.array(marks, pa.binary()))

    return run


def _removed(layout: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                n_words, n_removed, kept = [], [], []
                for text, marks in zip(part["text"].to_pylist(), part["_gone"].to_pylist(), strict=True):
                    raw = (text or "").encode()
                    n = len(raw.split())
                    gone = np.unpackbits(np.frombuffer(marks, np.uint8), count=n).astype(bool)
                    n_words.append(n)
                    n_removed.append(int(gone.sum()))
                    kept.append(None if text is None and layout else kept_text(raw, gone, layout).decode())
                names = [c for c in part.schema.names if c != "_gone"]
                columns = [pa.array(kept, pa.string()) if c == "text" else part[c] for c in names]
                columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed"])

    return run


def automata(reference: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """One row for each shard of the reference: its automaton as arrays."""
    common.prepared(reference.sparkSession)
    pieces = saved(reference.select("text").mapInArrow(_pieces(PIECE), "words binary").distinct(), "pieces")
    total = pieces.agg(F.sum(F.octet_length("words") / 4)).first()[0] or 0
    if total > most_words:
        raise ValueError(f"a reference of {total:.0f} words is more than the {most_words} to be broadcast; remove_repeats has no such bound")
    shards = max(1, -(-int(total) // SHARD))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int"))
    return saved(dealt.groupBy("shard").applyInArrow(_built, AUTOMATON), "automata")


def remove_known(docs: DataFrame, reference: DataFrame, layout: bool = True, most_words: int = MOST_WORDS) -> DataFrame:
    """The documents without the words that stand in a passage of the reference's texts, with n_words and n_removed.

    ``layout`` is that of ``remove_repeats``. Input columns n_words and n_removed are replaced.
    """
    built = automata(reference, most_words)
    shards = sorted(r["shard"] for r in built.select("shard").collect())
    docs = docs.drop("n_words", "n_removed")
    names, docs = docs.columns, common.carried(docs)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("n_words long, n_removed long").fields])
    docs = docs.withColumn("_gone", F.lit(None).cast("binary"))
    for i in range(0, max(1, len(shards)), AT_ONCE):
        if i:
            docs = saved(docs, "marked")
        now = built.filter(F.col("shard").isin(shards[i : i + AT_ONCE])).drop("shard")
        held = docs.sparkSession.sparkContext.broadcast([tuple(map(bytes, r)) for r in now.collect()])
        docs = docs.mapInArrow(_marked(held), docs.schema)
    return docs.mapInArrow(_removed(layout), schema).toDF(*names, "n_words", "n_removed")
