"""Byte-level BPE by recursive queries in DuckDB, inside each task.

A task cuts its texts into pre-tokens and looks the different ones up in a store; those not yet known go to
DuckDB in bounded batches, one row for each byte. The recursive query joins neighbouring rows with
the table of merges and contracts each word's leftmost pair of lowest rank, round by round; a word without
such a pair has reached its fixpoint and leaves. Ordered aggregation then gives each word's ids, and joined
with the tokens' bytes, the decoded word. As in the library, a pre-token that is a token itself is
not merged.

Words of ``LONG`` bytes and more (encoded data, rulers, scripts without spaces) go to a query that contracts all places
of the pair in a round, as far as that gives the same ids; its rounds grow with the number of different ranks that the word meets, not
with its length. A longer word than ``QUERY_BYTES`` is a query of its own.

Null or empty text: no ids. Very long texts are coded whole, and have to fit into a task. Repeated rows: one result each. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wayfare.llm import common
from wayfare.llm.vocabulary import STORE, ByteChunks, read_ranks

#: Bytes of words that one recursive query works on.
QUERY_BYTES = 1 << 19

#: Bytes of texts that a task codes at once; the more, the fewer times a word is met again.
PORTION = 1 << 23

#: Words from so many bytes on go to the query that contracts more than one pair of a word in a round.
LONG = 256

FOUND = """
SELECT s.word, list(s.tok ORDER BY s.place) AS ids, unhex(string_agg(t.hex, '' ORDER BY s.place)) AS bytes
FROM step s JOIN tokens t USING (tok)
WHERE NOT live
GROUP BY s.word
"""

ENCODE = f"""
WITH RECURSIVE step AS (
  SELECT word, place, tok, true AS live FROM start
  UNION ALL
  SELECT word, place, CASE WHEN place = best_place THEN made ELSE tok END, best_place IS NOT NULL
  FROM (
    WITH pair AS MATERIALIZED (
      SELECT p.word, p.place, p.tok, p.place_before, m.made
      FROM (
        SELECT word, place, tok, lead(word) OVER w AS next_word, lead(tok) OVER w AS next_tok,
          lag(place) OVER w AS place_before
        FROM step WHERE live WINDOW w AS (ORDER BY place)
      ) p
      LEFT JOIN merges m ON m.a = p.tok AND m.b = p.next_tok AND p.next_word = p.word
    )
    SELECT p.word, p.place, p.tok, p.place_before, b.made, b.best_place
    FROM pair p
    LEFT JOIN (
      SELECT word, min(made) AS made,
        arg_min(place, (made::BIGINT << 32) | (place & 4294967295)) AS best_place
      FROM pair WHERE made IS NOT NULL GROUP BY word
    ) b USING (word)
  )
  WHERE best_place IS NULL OR place_before IS DISTINCT FROM best_place
)
{FOUND}"""

# A round contracts, from the left, the places of the word's lowest rank that do not overlap. Overlapping ones follow each
# other without a gap: of such a run every other one is taken. Where a new token has a pair of a lower rank with its neighbour,
# which would come first, the round ends for the word.
ENCODE_LONG = f"""
WITH RECURSIVE step AS (
  SELECT word, place, tok, true AS live FROM start
  UNION ALL
  SELECT word, place, CASE WHEN hit THEN best ELSE tok END, best IS NOT NULL
  FROM (
    WITH pair AS MATERIALIZED (
      SELECT p.*, m.made
      FROM (
        SELECT word, place, tok, lead(word) OVER w AS next_word, lead(tok) OVER w AS next_tok, row_number() OVER w AS n,
          CASE WHEN lag(word) OVER w = word THEN lag(tok) OVER w END AS before,
          CASE WHEN lead(word, 2) OVER w = word THEN lead(tok, 2) OVER w END AS after
        FROM step WHERE live WINDOW w AS (ORDER BY place)
      ) p
      LEFT JOIN merges m ON m.a = p.tok AND m.b = p.next_tok AND p.next_word = p.word
    ),
    run AS MATERIALIZED (
      SELECT p.word, p.place, p.tok, p.n, p.before, p.after, b.made AS best, coalesce(p.made = b.made, false) AS there
      FROM pair p LEFT JOIN (SELECT word, min(made) AS made FROM pair WHERE made IS NOT NULL GROUP BY word) b USING (word)
    ),
    ending AS (
      SELECT word, min(n) AS n
      FROM (
        SELECT r.word, r.n FROM run r JOIN merges m ON m.a = r.before AND m.b = r.best AND m.made < r.best WHERE r.there
        UNION ALL SELECT r.word, r.n FROM run r JOIN merges m ON m.a = r.best AND m.b = r.after AND m.made < r.best WHERE r.there
        UNION ALL SELECT r.word, r.n FROM run r JOIN merges m ON m.a = r.best AND m.b = r.best AND m.made < r.best WHERE r.there
      )
      GROUP BY word
    ),
    taken AS (
      SELECT r.*, r.there AND (r.n - coalesce(max(CASE WHEN NOT r.there THEN r.n END) OVER (ORDER BY r.n), 0)) % 2 = 1
        AND (e.n IS NULL OR r.n <= e.n) AS hit
      FROM run r LEFT JOIN ending e USING (word)
    )
    SELECT *, lag(hit) OVER (ORDER BY n) AS gone FROM taken
  )
  WHERE gone IS DISTINCT FROM true
)
{FOUND}"""


class RecursiveBpe:
    """One in-memory database of the worker: merges, tokens and the query over start rows."""

    def __init__(self, path: str):
        import duckdb

        ranks = read_ranks(path)
        self.ranks = ranks
        self.con = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "400MB", "temp_directory": ""})
        merges = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        a, b, made = (np.array(c, np.int32) for c in zip(*merges, strict=True))
        self.con.register("m", pa.table({"a": a, "b": b, "made": made}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.con.register("t", pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.con.execute("CREATE TABLE tokens AS SELECT * FROM t")
        self.byte_rank = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def encode(self, words: list[bytes], query: str = ENCODE) -> list[tuple[bytes, bytes]]:
        """Ids and decoded bytes of each word; none is empty."""
        ranked = [self.ranks.get(w) for w in words]
        sizes = np.array([len(w) if r is None else 1 for w, r in zip(words, ranked, strict=True)])
        raw = b"".join([w if r is None else w[:1] for w, r in zip(words, ranked, strict=True)])
        tok, first = self.byte_rank[np.frombuffer(raw, np.uint8)], np.cumsum(sizes) - sizes
        for k, r in enumerate(ranked):
            if r is not None:
                tok[first[k]] = r
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        start = pa.table({"word": word, "place": np.arange(len(tok)), "tok": tok})
        self.con.register("start", start)
        found = self.con.sql(query).to_arrow_table().combine_chunks()
        lists, texts = found["ids"].chunk(0), found["bytes"].chunk(0)
        ends = (np.asarray(lists.offsets) * 4).tolist()
        ids, (raw, at) = np.asarray(lists.values).astype("<u4").tobytes(), common.buffers(texts)
        raw, at = raw.tobytes(), at.tolist()
        out: list = [None] * len(words)
        for n, k in enumerate(found["word"].to_numpy().tolist()):
            out[k] = (ids[ends[n] : ends[n + 1]], raw[at[n] : at[n + 1]])
        return out

    def encode_all(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """The same in queries of bounded size; a longer word is a query of its own."""
        found: dict[bytes, tuple[bytes, bytes]] = {}
        for query, mine in (
            (ENCODE, [w for w in words if len(w) < LONG]),
            (ENCODE_LONG, [w for w in words if len(w) >= LONG]),
        ):
            some: list[bytes] = []
            size = 0
            for w in mine:
                if some and size + len(w) > QUERY_BYTES:
                    found.update(zip(some, self.encode(some, query), strict=True))
                    some, size = [], 0
                some.append(w)
                size += len(w)
            if some:
                found.update(zip(some, self.encode(some, query), strict=True))
        return [found[w] for w in words]


class Codec:
    """Texts to ids and back by way of the different chunks; the store keeps words, and before it would pass its bound only
    those of the texts at hand."""

    def __init__(self, path: str, pattern: str):
        self.bpe, self.chunks = RecursiveBpe(path), ByteChunks(pattern)
        self.words: dict[str, tuple[bytes, bytes]] = {}

    def _learn(self, chunks: list[str], parts: dict[str, list[str]]) -> None:
        new = list(set(chain.from_iterable(parts.values())) - self.words.keys())
        if len(self.words) + len(new) > STORE // 2:
            held = set(chunks).union(*parts.values())
            self.words = {w: f for w, f in self.words.items() if w in held}
        self.words.update(zip(new, self.bpe.encode_all([w.encode() for w in new]), strict=True))

    def coded(self, chunks: list[str]) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded bytes of each chunk. A chunk found among the words is one: alone, a pre-token is cut no further."""
        parts = {c: self.chunks.pattern.findall(c) for c in chunks if c not in self.words}
        self._learn(chunks, parts)
        found = self.words
        coded = [found[c] if c in found else _joined([found[p] for p in parts[c]]) for c in chunks]
        return pa.array([c[0] for c in coded], pa.large_binary()), pa.array([c[1] for c in coded], pa.large_binary())

    def texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded bytes of each text; a null is an empty text."""
        chunks, first = self.chunks.cut(*common.buffers(texts))
        ids, decoded = self.coded(chunks.dictionary.cast(pa.large_string()).to_pylist())
        return _gathered(ids, chunks.indices, first), _gathered(decoded, chunks.indices, first)


def _joined(parts: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    return b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])


def _gathered(values: pa.Array, indices: pa.Array, first: np.ndarray) -> pa.Array:
    """The values at these indices, joined from ``first[k]`` to ``first[k + 1]``."""
    raw, at = common.buffers(values.take(indices))
    ends = pa.py_buffer(at[first])
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, ends, pa.py_buffer(raw)]).cast(pa.binary())


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """This worker's codec for a file of ranks."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, the ids (little-endian 32-bit) and the bytes decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in common.portions(batches, PORTION):
            ids, decoded = own.texts(part["text"])
            n = pc.divide(pc.binary_length(ids), 4).cast(pa.int64())
            found = pa.RecordBatch.from_arrays([part["doc_id"], n, ids, decoded], ["doc_id", "n_tokens", "ids", "decoded"])
            yield from common.slices(found)

    common.prepared(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded binary"
    )
