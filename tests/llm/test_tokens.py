"""Packing, byte-level BPE and token counts against the libraries."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm import brute
from wayfare.llm import token_counts as counting
from wayfare.llm import byte_bpe, common
from wayfare.llm.byte_bpe import ENCODE_LONG, Codec, RecursiveBpe, encode_decode
from wayfare.llm.packing import LevelPacker, pack
from wayfare.llm.queries import QUERIES
from wayfare.llm.token_counts import token_counts
from wayfare.llm.vocabulary import BYTE_PATTERN, ByteChunks, WordVocabulary, read_ranks

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def key(row):
    return tuple((x is not None, x) for x in row)


def test_token_counts(docs, texts, library):
    want = []
    for doc, text in texts:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc, len((text or "").encode()), n, n > 2048))
    assert sorted(map(tuple, token_counts(docs, WORDS).collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("most_open", [1, 8, 512])
def test_packing_covers_every_token(docs, texts, library, most_open):
    rows = pack(docs, WORDS, most_open=most_open).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        if r["doc_id"] is not None:
            pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts:
        if doc is None:
            continue
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0  # full, or a power of two


@pytest.mark.parametrize("most_open", [8, 512])
def test_level_is_the_sum_of_squares_choice(most_open):
    """Before every placement, also where windows were filled up because too many were open."""
    packer = LevelPacker(16, 0, most_open)
    random = np.random.default_rng(1)
    for size in random.integers(1, 16, 300):
        counts = packer.level.copy()
        best = {}
        for level in [0, *np.flatnonzero(counts)]:
            if level + size <= 16:
                after = counts.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 16
                best[int(level)] = int((after[:16] ** 2).sum())
        assert best[packer.best_level(int(size))] == min(best.values())
        packer.add(1, bytes(4 * int(size)))
        assert packer.n_open == packer.level.sum() == sum(map(len, packer.open.values())) <= most_open


def test_filled_up_windows_are_full_and_keep_the_rest():
    packer = LevelPacker(16, 0, 8)
    random = np.random.default_rng(2)
    ids = [np.arange(1000 * k, 1000 * k + n, dtype="<u4").tobytes() for k, n in enumerate(random.integers(9, 14, 200))]
    for doc, x in enumerate(ids):  # no two fit into one window, so only filling up closes any
        packer.add(doc, x)
    closed = len({r[5] for r in packer.rows})
    assert closed >= sum(map(len, ids)) // 64 - 9
    packer.flush()
    ends, parts = defaultdict(int), defaultdict(list)
    for doc, start, n, crc, total, sequence, offset in packer.rows:
        assert crc == zlib.crc32(ids[doc][4 * start : 4 * (start + n)]) and total == len(ids[doc]) // 4
        assert offset == ends[sequence]
        ends[sequence] += n
        parts[doc].append((start, n))
    assert sorted(ends.values())[9:] == [16] * (len(ends) - 9) and all(n & (n - 1) == 0 for n in ends.values())
    for doc, cut in parts.items():
        cut.sort()
        assert [s for s, _ in cut] == [0, *np.cumsum([n for _, n in cut])[:-1]] and sum(n for _, n in cut) == len(ids[doc]) // 4


def test_byte_bpe(docs, texts):
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(BYTES), special_tokens={})
    want = [(d, len(i := coder.encode_ordinary(t or "")), np.array(i, "<u4").tobytes(), (t or "").encode()) for d, t in texts]
    got = [(r[0], r[1], bytes(r[2]), bytes(r[3])) for r in encode_decode(docs, BYTES, public_tokenizers.PATTERN).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty_tables(no_docs):
    assert token_counts(no_docs, WORDS).count() == 0
    assert pack(no_docs, WORDS).count() == 0
    assert encode_decode(no_docs, BYTES, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(BYTES), special_tokens={})


def test_long_words_equal_the_library(encoding):
    """Several places in a round: runs of one letter or sign, and words of few or all letters, long and short."""
    random, own = np.random.default_rng(8), RecursiveBpe(BYTES)
    words = [b"a" * 200_000, b"=" * 100_001, b"ab" * 20_000, b"abcdefgh" * 3000, bytes(random.integers(97, 123, 3000, dtype=np.uint8))]
    for letters in (b"ab", b"aeinst", b"=-", b"the ", bytes(range(97, 123)), bytes(range(256))):
        words += [bytes(random.choice(list(letters), n).astype(np.uint8)) for n in random.integers(1, 90, 25)]
    words = list(dict.fromkeys(words))
    want = [(np.array(encoding._encode_single_piece(w), "<u4").tobytes(), w) for w in words]
    assert own.encode(words, ENCODE_LONG) == want
    assert own.encode_all(words) == want


def test_chunks_have_the_pre_tokens_of_their_text():
    """Spaces of all kinds, quotes, signs, letters and digits of one to four bytes, in random order."""
    random, chunks = np.random.default_rng(9), ByteChunks(public_tokenizers.PATTERN)
    signs = [*" \n\t\x0b\x1c\x1f\x85\xa0\u1680\u2000\u200a\u200b\u2028\u202f\u205f\u3000", *"'stlredvm", *"Az19éÿ×÷²ªßĀжЀ٣日À\u0301😀\0\x7f,._-", *"  ''"]
    texts = ["".join(random.choice(signs, n)) for n in random.integers(0, 40, 5000)] + ["", "don't, 's''s 'stop'", "\xa0 a\u2009 b", "x\u0120 y"]
    found, first = chunks.cut(*common.buffers(pa.array(texts)))
    found = found.cast(pa.string()).to_pylist()
    for k, t in enumerate(texts):
        mine = found[first[k] : first[k + 1]]
        assert "".join(mine) == t
        assert sum(map(chunks.pattern.findall, mine), []) == chunks.pattern.findall(t)
    assert BYTE_PATTERN == public_tokenizers.PATTERN
    whole, _ = ByteChunks(r"\S+|\s+").cut(*common.buffers(pa.array(["a b, c"])))
    assert whole.to_pylist() == [b"a b, c"]


def test_a_word_is_merged_once_whatever_stands_behind_it(monkeypatch, encoding):
    """Neither signs nor the emptying of the store send a word of the texts at hand to the query again."""
    coder, sent = Codec(BYTES, public_tokenizers.PATTERN), []
    encode_all = coder.bpe.encode_all
    monkeypatch.setattr(coder.bpe, "encode_all", lambda words: sent.extend(words) or encode_all(words))
    monkeypatch.setattr(byte_bpe, "STORE", 2 * 6)
    rounds = [["a thentien, b", None, "été; a"], ["a thentien. thentien! a (thentien", ""], ["été thentien"]]
    for texts in rounds:
        ids, decoded = coder.texts(pa.array(texts, pa.string()))
        assert decoded.to_pylist() == [(t or "").encode() for t in texts]
        assert ids.to_pylist() == [np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes() for t in texts]
    assert sent.count(b" thentien") == 1
    chunks, _ = coder.chunks.cut(*common.buffers(pa.array(["é thentien, thentien; thentien."])))
    assert chunks.dictionary.to_pylist() == ["é".encode(), b" thentien", b",", b";", b"."]


def test_byte_bpe_query_equals_the_library_and_hashlib(spark, encoding):
    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op4_byte_bpe"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array(encoding.encode_ordinary(r["text"] or ""), "<u4")
        hashes = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (r["text"] or "").encode())]
        assert got[r["doc_id"]] == (r["doc_id"], len(ids), *hashes)


def test_substring_query_equals_plain_windows_and_hashlib(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = sorted((d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute.without_repeats(rows))
    assert sorted(map(tuple, QUERIES["op10_substrings"](spark, sf_dir).collect())) == want


def test_chunks_cut_together_have_the_pieces_of_each_alone():
    vocabulary = WordVocabulary(WORDS)
    chunks = ["don't", "ΑΣ", "'s's12x", "x\x7fy", "Ünï-ÀÉß", "日本語", "I'LL,", "\u0085", "4.5e-6", "K"]
    found, sizes = vocabulary.all_pieces(chunks)
    alone = [vocabulary.pieces(c) for c in chunks]
    assert sizes.tolist() == list(map(len, alone))
    assert [p.encode() for p in found.to_pylist()] == sum(alone, [])


@pytest.mark.parametrize("counts_only", [True, False])
def test_a_store_that_is_emptied_between_texts_finds_the_same(monkeypatch, counts_only):
    vocabulary = WordVocabulary(WORDS)
    texts = ["", None, " \n a<|endoftext|>b\x0b", "<|startoftext|><|endoftext|>", "A b ΑΣ b", "x " * 50 + "y", "日本 b's"]
    wanted = [vocabulary.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(counting, "STORE", 4)
    store = counting.ChunkStore(vocabulary, counting.Merges(vocabulary), counts_only)
    found = [store.texts([t])[0] for t in texts] + store.texts(texts)
    assert found == ([len(w) if counts_only else np.array(w, "<u4").tobytes() for w in wanted] * 2)
