"""LM scoring: prediction by partial matching over bytes.

The model predicts a document's class mark, then its lower-cased words, byte by byte, each closed by a space, and an end
mark. Contexts are the up to ``ORDER`` symbols before, back to a mark for the start of the word, the longest one together
with the class: a context is a path in a trie, and its node counts what followed it in the training texts. From the
longest context that training has seen, a symbol that followed it c times has probability 2c / (2n + d) (n: all that followed,
d: different symbols); else the escape, d / (2n + d), leads to the next shorter context, where the symbols of the longer
one are excluded from n and d. Below the empty context all symbols not yet excluded are equally likely.

The class is the nearest of ``CLASSES`` byte histograms (about: the language), found by k-means on all training documents; its
mark costs log10(CLASSES). The histograms are saved once. Each of up to ``ROUNDS`` rounds adds them up by class in the map
tasks, as whole numbers, so the centres do not depend on how rows are dealt. All statistics are of the whole corpus.

The trie is a table with a row for each context and symbol, built level by level with grouped sums. As the
symbols after a context also follow its suffix, what is excluded is known per context. A level joins each row with its parent;
a context has at most as many rows, and a row as many children, as there are symbols and classes, so no key is hot. Nothing of
the trie is broadcast or bounded in size.

Documents lie in blocks of about ``BLOCK`` bytes. A block sends each of its different words and grams once, gets
their counts and code lengths back, and adds them up for each document.

The base score is that of the contract: log10((c + 1) / (N + 1 * (V + 1))) summed over words and end.
Null text: as empty, the end only. Training are documents whose crc32(doc_id as text) mod 7 is not 2; a null
id counts as an empty text. Repeated rows train and are scored each. Very long texts are scored whole, and have to fit into a task. Of
equally near classes the first counts. An empty table gives no rows. Other columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import held_out, saved

ORDER, CLASSES, SEED = 5, 8, 2
#: Rounds of k-means at most, and the unit of the sums of shares.
ROUNDS, UNIT = 20, float(1 << 24)
#: Bytes of text in a block, and of those worked on at once.
BLOCK, SLICE = 1 << 25, 1 << 22
#: Symbols: 0 is no symbol, byte b is b + 1, then the start of a word and the end of the text. All bytes and the end can be predicted.
BITS, START, END, SPACE, ALPHABET = 9, 257, 258, 33, 257
WORD, GRAM = 0, 1
END_WORD = 1

RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def grams_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word the context and symbol of each of its bytes and of its closing space; and how many."""
    sizes = ends - starts + 2
    first = np.cumsum(sizes) - sizes
    flat = np.full(int(sizes.sum()), SPACE, np.int64)
    flat[first] = START
    place = np.arange(len(flat)) - np.repeat(first, sizes)
    inner = (place > 0) & (place < np.repeat(sizes - 1, sizes))
    flat[inner] = raw[(np.repeat(starts, sizes) + place - 1)[inner]].astype(np.int64) + 1
    gram = flat.copy()
    for k in range(1, ORDER + 1):
        back = np.zeros(len(flat), np.int64)
        back[k:] = flat[:-k]
        gram |= np.where(place >= k, back, 0) << (BITS * k)
    return gram[place > 0], sizes - 1


END_GRAM = (START << BITS) | END
#: The class stands above the symbols of the longest context.
CLASS_BIT = BITS * (ORDER + 1)


def histograms(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Square roots of the shares of bytes other than white space, in lower case."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = ~common.IS_SPACE[raw]
    counts = np.bincount(text[inside] * 256 + common.LOWER[raw[inside]], minlength=256 * (len(at) - 1))
    counts = counts.reshape(-1, 256).astype(np.float64)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


_WEIGHTS = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _drawn(rows: np.ndarray, centres: np.ndarray) -> tuple[float, np.ndarray]:
    """The row to be the next seed, and its key: the smallest of rows drawn by squared distance, by their own hash."""
    far = np.ones(len(rows))
    if len(centres):
        far = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
    marks = (rows.astype(np.float32).view(np.uint32).astype(np.uint64) * _WEIGHTS).sum(axis=1, dtype=np.uint64)
    h = common.mixed(marks + np.uint64(len(centres) * CLASSES + SEED))
    lot = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
    key = np.divide(lot, far, out=np.full(len(rows), np.inf), where=far > 0)
    return float(key.min()), rows[key.argmin()]


def _sums(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For every class its number of rows, then the sums of their shares in units."""
    member = np.eye(CLASSES)[nearest(rows, centres)]
    units = np.hstack([np.ones((len(rows), 1)), np.rint(rows * UNIT)])
    return (member.T @ units).astype(np.int64)


def _fitted(draw, add) -> np.ndarray:
    """k-means with seeds drawn by squared distance: draw(centres) gives a key and a row, add(centres) sums."""
    found = draw(np.zeros((0, 256)))
    if found is None:
        return np.zeros((CLASSES, 256))
    centres = found[1][None]
    while len(centres) < CLASSES:
        key, row = draw(centres)
        centres = np.vstack([centres, row if np.isfinite(key) else centres[0]])
    for _ in range(ROUNDS):
        sums = add(centres)
        n = sums[:, :1]
        new = np.where(n > 0, sums[:, 1:] / UNIT / np.maximum(n, 1), centres)
        if np.array_equal(new, centres):
            break
        centres = new
    return centres


def class_centres(rows: np.ndarray) -> np.ndarray:
    """The centres of histograms at hand."""
    return _fitted(lambda c: _drawn(rows, c) if len(rows) else None, lambda c: _sums(rows, c))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch["shares"].to_pylist()), np.float32).reshape(-1, 256).astype(np.float64)


def fitted_centres(train: DataFrame) -> np.ndarray:
    """The centres of all texts; the driver sees a row for each seed, and the sums by class and byte."""
    shares = saved(train.select("text").mapInArrow(_histogrammed, "shares binary"), "histograms")

    def draw(centres):
        def best(batches):
            found = [_drawn(_rows(b), centres) for b in batches if b.num_rows]
            if found:
                key, row = min(found, key=lambda x: (x[0], x[1].tobytes()))
                columns = [pa.array([key]), pa.array([row.astype(np.float32).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "shares"])

        first = shares.mapInArrow(best, "key double, shares binary").orderBy("key", "shares").limit(1).collect()
        return (first[0]["key"], np.frombuffer(first[0]["shares"], np.float32).astype(np.float64)) if first else None

    def add(centres):
        def sums(batches):
            total = np.zeros((CLASSES, 257), np.int64)
            for b in batches:
                if b.num_rows:
                    total += _sums(_rows(b), centres)
            at = np.flatnonzero(total)
            columns = [pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])]
            yield pa.RecordBatch.from_arrays(columns, ["at", "total"])

        total = np.zeros(CLASSES * 257, np.int64)
        for r in shares.mapInArrow(sums, "at int, total long").groupBy("at").agg(F.sum("total").alias("total")).collect():
            total[r["at"]] = r["total"]
        return total.reshape(CLASSES, 257)

    return _fitted(draw, add)


def _histogrammed(batches):
    for batch in batches:
        for part in common.slices(batch):
            rows = histograms(*common.buffers(part["text"])).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], ["shares"])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), minlength=len(key)).astype(np.int64)


class Slice:
    """Words of some documents: different ones, their grams by class, and which word stands where."""

    def __init__(self, part: pa.RecordBatch, centres: np.ndarray):
        raw, at = common.buffers(part["text"])
        kind = nearest(histograms(raw, at), centres)
        raw = common.LOWER[raw]
        starts, ends, self.counts = common.words(raw, at)
        h = common.word_hashes(raw, starts, ends, lower=False).view(np.int64)
        self.words, first, self.word = np.unique(h, return_index=True, return_inverse=True)
        self.document = np.repeat(np.arange(len(self.counts)), self.counts)
        pairs, self.pair = np.unique(self.word * CLASSES + kind[self.document], return_inverse=True)
        at_first = first[pairs // CLASSES]
        grams, self.sizes = grams_of(raw, starts[at_first], ends[at_first])
        self.grams = grams | (np.repeat(pairs % CLASSES, self.sizes) << CLASS_BIT)
        self.ends = END_GRAM | (kind << CLASS_BIT)


def _slices(table: pa.Table):
    for batch in table.to_batches():
        yield from common.slices(batch, SLICE)


def _counter(centres: np.ndarray):
    def contents(key: tuple, table: pa.Table) -> pa.Table:
        """Different words and grams of a block, with how often they occur in training documents."""
        words, n_words, grams, n_grams = ([np.zeros(0, np.int64)] for _ in range(4))
        for part in _slices(table):
            s, train = Slice(part, centres), (~np.asarray(part["held_out"])).astype(np.float64)
            words += [s.words, np.array([END_WORD])]
            n_words += [np.bincount(s.word, train[s.document], minlength=len(s.words)), train.sum(keepdims=True)]
            count = np.bincount(s.pair, train[s.document], minlength=len(s.sizes))
            gram, n = _summed([s.grams, s.ends], [np.repeat(count, s.sizes), train])
            grams.append(gram)
            n_grams.append(n)
        (word, n_word), (gram, n_gram) = _summed(words, n_words), _summed(grams, n_grams)
        kind = np.repeat(np.array([WORD, GRAM], np.int32), [len(word), len(gram)])
        return pa.table({
            "block": pa.array(np.full(len(kind), key[0].as_py(), np.int64)),
            "kind": pa.array(kind),
            "key": pa.array(np.concatenate([word, gram])),
            "n": pa.array(np.concatenate([n_word, n_gram])),
        })

    return contents


def code_lengths(grams: DataFrame) -> DataFrame:
    """(key, value): log10 probability of the symbol in each gram (key, c: training count)."""
    symbol = F.col("key").bitwiseAND((1 << BITS) - 1)
    levels = [grams.select("key", "c")]
    for k in range(ORDER - 1, -1, -1):
        key = F.col("key").bitwiseAND((1 << (BITS * (k + 1))) - 1)
        levels.append(levels[-1].groupBy(key.alias("key")).agg(F.sum("c").alias("c")))
    levels.reverse()
    everything = Window.partitionBy(F.shiftright("key", BITS))  # the symbols of one context
    counted = [
        F.sum("c").over(everything).alias("n"),
        F.count(F.when(F.col("c") > 0, 1)).over(everything).alias("d"),
    ]
    # below the empty context: what it has not seen is equally likely
    low = levels[0].select("key", "c", *counted).withColumn("lower", -F.log10(ALPHABET - F.col("d")))
    rows = low.withColumn("value", _value(F.col("lower")))
    for k in range(1, ORDER + 1):
        parent = rows.select(
            F.col("key").alias("up"), *(F.col(c).alias(f"up_{c}") for c in ("c", "n", "d", "lower", "value"))
        )
        level = levels[k].withColumn("up", F.col("key").bitwiseAND((1 << (BITS * k)) - 1)).join(parent, "up")
        level = level.select(
            "*", *counted, F.sum(F.when(F.col("c") > 0, F.col("up_c"))).over(everything).alias("seen_up")
        ).withColumn("seen_up", F.coalesce("seen_up", F.lit(0)))
        left_n, left_d = F.col("up_n") - F.col("seen_up"), F.col("up_d") - F.col("d")
        lower = (
            F.when(F.col("c") > 0, F.lit(0.0))  # never asked for
            .when(F.col("up_c") > 0, F.log10(2 * F.col("up_c") / (2 * left_n + left_d)))
            .when(left_d > 0, F.log10(left_d / (2 * left_n + left_d)) + F.col("up_lower"))
            .otherwise(F.col("up_lower"))
        )
        level = level.withColumn("lower", lower).withColumn("value", _value(F.col("up_value")))
        rows = level.select("key", "c", "n", "d", "lower", "value")
        rows = saved(rows, f"trie-{k}") if k < ORDER else rows
    return rows.select("key", "value")


def _value(unseen):
    """Log probability from a context on; a context that training has not seen is left at no cost."""
    seen = F.when(F.col("c") > 0, F.log10(2 * F.col("c") / (2 * F.col("n") + F.col("d")))).otherwise(
        F.log10(F.col("d") / (2 * F.col("n") + F.col("d"))) + F.col("lower")
    )
    return F.when(F.col("n") == 0, unseen).otherwise(seen)


def _scorer(centres: np.ndarray, train_tokens: int, different: int):
    log_all = np.log10(train_tokens + 1.0 * (different + 1))

    def score(docs: pa.Table, found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        kind, key, value = (np.asarray(found[c]) for c in ("kind", "key", "value"))
        tables = []
        for k in (WORD, GRAM):
            order = np.argsort(key[kind == k])
            tables.append((key[kind == k][order], value[kind == k][order]))
        (words, count), (grams, length) = tables
        ends = count[np.searchsorted(words, END_WORD)]
        out = []
        for part in _slices(docs):
            s = Slice(part, centres)
            n = len(s.counts)
            c = count[np.searchsorted(words, s.words)]
            each = length[np.searchsorted(grams, s.grams)]
            code = np.add.reduceat(each, np.cumsum(s.sizes) - s.sizes) if len(s.sizes) else np.zeros(0)
            code = np.bincount(s.document, code[s.pair], minlength=n) + length[np.searchsorted(grams, s.ends)]
            total = lambda x: np.bincount(s.document, x[s.word], minlength=n)  # noqa: B023, E731
            out.append(pa.table({
                "doc_id": part["doc_id"], "held_out": part["held_out"],
                "n_tokens": pa.array(s.counts.astype(np.int64) + 1),
                "n_known": pa.array((total((c > 0).astype(np.float64)) + (ends > 0)).astype(np.int64)),
                "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
                "base_score": pa.array(total(np.log10(c + 1)) + np.log10(ends + 1) - (s.counts + 1) * log_all),
                "score": pa.array(code - np.log10(CLASSES)),
            }))
        return pa.concat_tables(out)

    return score


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Base score and model score of every document."""
    common.prepared(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(modulus, remainder).alias("held_out"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    centres = fitted_centres(docs.filter("NOT held_out"))
    contents = docs.groupBy("block").applyInArrow(_counter(centres), "block long, kind int, key long, n long")
    contents = saved(contents, "contents")
    counts = contents.groupBy("kind", "key").agg(F.sum("n").alias("c"))
    words = saved(counts.filter(F.col("kind") == WORD).select("key", "c"), "words")
    train_tokens, different = words.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    lengths = code_lengths(saved(counts.filter(F.col("kind") == GRAM).select("key", "c"), "grams"))
    values = words.select(F.lit(WORD).alias("kind"), "key", F.col("c").cast("double").alias("value"))
    values = values.union(lengths.select(F.lit(GRAM).alias("kind"), "key", "value"))
    found = contents.select("block", "kind", "key").join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    scorer = _scorer(centres, train_tokens or 0, different or 0)
    return docs.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scorer, RESULT)
