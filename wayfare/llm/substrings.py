"""Substring dedup: suffix automata over shards of reference text.

A window is ``WINDOW`` consecutive words. A word goes if a window over it has the same words as an earlier
one (smaller document, or earlier in the same document).

1. Each window names its anchor, the smallest hash among its ``GRAM``-word shingles. Equal windows have equal
   anchors, and an anchor stands for a run of up to 15 windows, so there is one row for about eight windows.
   Anchors that occur once are counted out.
2. The runs of windows with a repeated anchor become segments of word codes, the reference text. Equal segments become one,
   at their earliest place; the other places repeat all of it.
3. Segments are dealt by anchor to shards of bounded size. A shard builds one suffix automaton, segment by segment in
   document order. While a segment streams in, the automaton gives at each word the longest match with what came
   before (the matching statistic); where that reaches ``WINDOW``, the window ending there is a repeat.
4. Each document is joined with its own repeated windows, and the maximal spans that they cover are removed.

A frequent anchor (over ``FREQUENT`` places) may stand in as many different surroundings; its windows are dealt one by one,
by their own words, so that no shard gathers them. Shards go to tasks, each with its own part of the reference, since
a broadcast of all would grow with the corpus. Word codes have 32 bits, a segment at least 20 words.

Documents are ordered by id; rows with one id by a hash of their text, equal rows are one document. Rows without an id take no part
and stay as they are. Null or empty text: no words. Very long texts are judged whole; a text has to fit into a task. An empty
table gives an empty one. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.llm import common
from wayfare.llm.common import saved

WINDOW, GRAM = 20, 6
#: Places of an anchor from which its windows go one by one; words in a shard.
FREQUENT, SHARD = 2000, 100_000


def anchors(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor its hash, the number of its first window's first word, and how many windows it stands for."""
    grams, first = common.shingle_hashes(h, counts, GRAM)
    wide = WINDOW - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(grams) < wide:
        return grams[:0], none, none
    starts = np.flatnonzero(first[wide - 1 :] == first[: len(first) - wide + 1] + wide - 1)
    if not len(starts):
        return grams[:0], none, none
    at = starts + np.lib.stride_tricks.sliding_window_view(grams, wide)[starts].argmin(axis=1)
    run = np.flatnonzero((np.diff(at, prepend=-1) != 0))
    return grams[at[run]], first[starts[run]], np.diff(run, append=len(at))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch):
            raw, at = common.buffers(part["text"])
            starts, ends, counts = common.words(raw, at)
            key, word, n = anchors(common.word_hashes(raw, starts, ends, lower=False), counts)
            begin = np.cumsum(counts) - counts
            text = np.searchsorted(begin + counts, word, side="right")
            own = pa.array(text)
            columns = [pa.array(key.view(np.int64)), part["doc_id"].take(own), part["text_key"].take(own)]
            columns += [pa.array((word - begin[text]).astype(np.int32)), pa.array(n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "doc_id", "text_key", "start", "n"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word codes of the runs of windows in ``places``; of frequent anchors, of each window."""
    names = ["route", "doc_id", "text_key", "start", "words"]
    for batch in batches:
        for part in common.slices(batch):
            raw, at = common.buffers(part["text"])
            starts, ends, counts = common.words(raw, at)
            code = (common.word_hashes(raw, starts, ends, lower=False) >> np.uint64(32)).astype("<u4").tobytes()
            begin = (np.cumsum(counts) - counts).tolist()
            rows: list[tuple] = []
            for text, (doc, key, places) in enumerate(zip(*(part[c].to_pylist() for c in ("doc_id", "text_key", "places")), strict=True)):
                for p in places:
                    step = 1 if p["frequent"] else p["n"]
                    for s in range(p["start"], p["start"] + p["n"], step):
                        a = 4 * (begin[text] + s)
                        words = code[a : a + 4 * (step + WINDOW - 1)]
                        rows.append((None if p["frequent"] else p["anchor"], doc, key, s, words))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class SuffixAutomaton:
    """Online automaton of a text of integer words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def add(self, word: int) -> int:
        """Append a word; the length of the longest suffix that has occurred before."""
        nexts, link, length = self.next, self.link, self.length
        new, p = len(nexts), self.last
        nexts.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][word]
            if length[q] != length[p] + 1:
                copy = len(nexts)
                nexts.append(nexts[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = copy
                while p >= 0 and nexts[p].get(word) == q:
                    nexts[p][word] = copy
                    p = link[p]
                q = copy
            link[new] = q
        self.last = new
        return length[link[new]]


def _first_windows(shard: pa.Table) -> pa.Table:
    """For each segment the windows, as bits, that do not occur earlier in the shard."""
    shard = shard.sort_by([(c, "ascending") for c in ("doc_id", "text_key", "start")])
    automaton, masks = SuffixAutomaton(), []
    for k, segment in enumerate(shard["words"].to_pylist()):
        automaton.add(-1 - k)  # occurs once, so no match crosses it
        mask = 0
        for i, word in enumerate(np.frombuffer(segment, "<u4").tolist()):
            if automaton.add(word) < WINDOW <= i + 1:
                mask |= 1 << (i + 1 - WINDOW)
        masks.append(mask)
    return shard.select(["doc_id", "text_key", "start"]).append_column("mask", pa.array(masks, pa.int32()))


def removed_words(n_words: int, places: list[dict], firsts: list[dict]) -> np.ndarray:
    """Which words are covered by a window that is a repeat."""
    repeat = np.zeros(n_words + 1, np.int8)
    for p in places:
        repeat[p["start"] : p["start"] + p["n"]] = 1
    for f in firsts:
        start, mask = f["start"], f["mask"]
        while mask:
            low = mask & -mask
            repeat[start + low.bit_length() - 1] = 0
            mask ^= low
    begun = np.cumsum(repeat, dtype=np.int64)
    begun[WINDOW:] -= begun[:-WINDOW].copy()
    return begun[:-1] > 0


def kept_text(text: bytes, gone: np.ndarray, layout: bool, words: list[bytes] | None = None) -> bytes:
    """The words that stay, joined by single spaces; with layout, whole stretches of the text as they are."""
    if not layout:
        words = text.split() if words is None else words
        return b" ".join(words if not gone.any() else list(compress(words, (~gone).tolist())))
    if not gone.any():
        return text
    starts, ends, _ = common.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=1, append=1))
    return b" ".join([text[starts[a] : ends[b - 1]] for a, b in edge.reshape(-1, 2).tolist()])


def _without_repeats(layout: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                n_words, n_removed, kept = [], [], []
                for text, places, firsts in zip(*(part[c].to_pylist() for c in ("text", "_places", "_firsts")), strict=True):
                    raw = (text or "").encode()
                    words = raw.split()
                    gone = removed_words(len(words), places, firsts or []) if places else np.zeros(len(words), bool)
                    n_words.append(len(words))
                    n_removed.append(int(gone.sum()))
                    kept.append(None if text is None and layout else kept_text(raw, gone, layout, words).decode())
                names = [c for c in part.schema.names if c not in ("_places", "_firsts")]
                columns = [pa.array(kept, pa.string()) if c == "text" else part[c] for c in names]
                columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed"])

    return run


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each document with repeated anchors their places (start, n: windows), and those windows that are
    first occurrences (start, mask). Documents are (doc_id, text_key, text)."""
    named = docs.filter("doc_id IS NOT NULL")
    found = named.mapInArrow(_anchored, "anchor long, doc_id long, text_key long, start int, n int")
    often = found.groupBy("anchor").agg(F.count("*").alias("count")).filter("count > 1")
    often = saved(often.select("anchor", (F.col("count") > FREQUENT).alias("frequent")), "anchors")
    place = F.struct("start", "n", "anchor", "frequent")
    places = found.join(often, "anchor").groupBy("doc_id", "text_key").agg(F.collect_set(place).alias("places"))
    places = saved(places, "places")
    segments = named.join(places, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "places")
    segments = segments.mapInArrow(_segments, "route long, doc_id long, text_key long, start int, words binary")
    segments = segments.withColumn("route", F.coalesce("route", F.xxhash64("words")))
    earliest = segments.groupBy("route", "words").agg(F.min(F.struct("doc_id", "text_key", "start")).alias("at"))
    earliest = saved(earliest.select("route", "words", "at.*"), "segments")
    total = earliest.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-total // (4 * SHARD)))
    sharded = earliest.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    sharded = sharded.select("shard", "doc_id", "text_key", "start", "words")
    firsts = sharded.groupBy("shard").applyInArrow(_first_windows, "doc_id long, text_key long, start int, mask int")
    firsts = firsts.filter("mask <> 0").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "mask")).alias("firsts"))
    return places, firsts


def remove_repeats(docs: DataFrame, layout: bool = True) -> DataFrame:
    """The documents without repeated words, with n_words and n_removed.

    The text keeps its white space within the stretches that stay; without ``layout`` its words are joined by single spaces,
    and a null text becomes empty. Input columns n_words and n_removed are replaced.
    """
    common.prepared(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed")
    names, docs = docs.columns, common.carried(docs)
    keyed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "xxhash64(text) AS text_key", "text")
    places, firsts = repeated_windows(keyed)
    spans = places.join(firsts, ["doc_id", "text_key"], "left").select(
        F.col("doc_id").alias("_id"),
        F.col("text_key").alias("_key"),
        F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"))).alias("_places"),
        F.col("firsts").alias("_firsts"),
    )
    joined = docs.join(spans, (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left")
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("n_words long, n_removed long").fields])
    return joined.drop("_id", "_key").mapInArrow(_without_repeats(layout), schema).toDF(*names, "n_words", "n_removed")
