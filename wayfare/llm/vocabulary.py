"""Public tokenizer files, read from a path that is a parameter, and exact cutting of texts into chunks.

A chunk is a piece of text whose tokens do not depend on what stands around it, so each
different chunk is encoded once per worker. The stores of encoded chunks are emptied when
they reach a bound; that changes no result.
"""

from __future__ import annotations

import base64
import json
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Different chunks that a worker keeps.
STORE = 1_000_000

#: Of such characters neither normal form nor case depends on the neighbours.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
#: The piece pattern of the vocabulary, for plain characters in lower case.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The same with the ends of lines.
_PIECE_OR_LINE = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is visible, else the next free one."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


@dataclass
class WordVocabulary:
    """BPE with word ends (a ``tokenizers`` file): pieces of chunks between ASCII white space."""

    path: str
    tokenizer: object = field(init=False)

    def __post_init__(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        with open(self.path) as f:
            self.spec = json.load(f)
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        marks = [t["content"] for t in self.spec["added_tokens"]]
        self.marks = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.split_marks = re.compile("(" + "|".join(map(re.escape, sorted(marks, key=len, reverse=True))) + ")") if marks else None

    def parts(self, text: str) -> list[str]:
        """The text with the special strings in it as parts of their own, at odd places."""
        return self.split_marks.split(text) if self.split_marks and "<" in text else [text]

    def plain(self, chunk: str) -> list[bytes] | None:
        """Pieces of a chunk of plain characters; None for any other chunk."""
        return [p.encode() for p in _PIECE.findall(chunk.lower())] if _PLAIN.fullmatch(chunk) else None

    def pieces(self, chunk: str) -> list[bytes]:
        """Pieces that are merged one by one."""
        found = self.plain(chunk)
        if found is not None:
            return found
        normal = self.tokenizer.normalizer.normalize_str(chunk)
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def all_pieces(self, chunks: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Pieces of all chunks, end to end, and how many each has. Chunks of plain characters are cut in one go, a line for each."""
        plain = [(c.isascii() and c.isprintable()) or _PLAIN.fullmatch(c) is not None for c in chunks]
        lines = "\n".join(chunks if all(plain) else [c if p else "" for c, p in zip(chunks, plain, strict=True)])
        flat = _PIECE_OR_LINE.findall(lines.lower())
        for k in [k for k, p in enumerate(plain) if not p]:
            flat += ["\n", *[p.decode() for p in self.pieces(chunks[k])]]
        found = pa.array(flat, pa.string())
        line = np.asarray(pc.equal(found, "\n"))
        sizes = np.diff(np.flatnonzero(line), prepend=-1, append=len(flat)) - 1
        # The chunks cut one by one come last; every chunk's pieces go to its own place.
        place = np.concatenate([np.arange(len(chunks)), np.flatnonzero(~np.array(plain, bool))])
        own = np.argsort(np.repeat(place, sizes), kind="stable")
        found = found.filter(pa.array(~line)).take(pa.array(own)).dictionary_encode()
        return found, np.bincount(place, sizes, len(chunks)).astype(np.int64)


def listed(strings: pa.Array) -> list[str]:
    """Strings without line ends in them, not empty; much faster than ``to_pylist``."""
    if not len(strings):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings.cast(pa.string()))
    return pc.binary_join(whole, "\n")[0].as_py().split("\n")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: Pre-tokens of byte-level BPE: the pattern whose classes ``ByteChunks`` knows.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_OTHER, _SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE = range(6)


def _classes() -> np.ndarray:
    """Class of each ASCII byte in the pattern; _OTHER: not known from the byte alone."""
    out = np.zeros(256, np.uint8)
    out[:0x1C] = out[0x21:0x80] = _SIGN
    out[[0x20, *range(0x09, 0x0E)]] = _SPACE
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = _LETTER
    out[39] = _QUOTE
    return out


def _cut_between() -> np.ndarray:
    """True at 8 * class of a byte + class of the next one where a pre-token always ends, whatever stands around them."""
    out = np.zeros((8, 8), bool)
    out[[_LETTER, _DIGIT, _SIGN, _QUOTE], _SPACE] = True
    out[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = out[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    out[_SIGN, [_LETTER, _DIGIT]] = True
    return out.reshape(-1)


class ByteChunks:
    """Cuts texts, all bytes at once, at places where a pre-token ends whatever stands around: where the class of
    characters changes, but not after white space (what follows decides on its length) nor after an apostrophe (of 's). Of other than
    ASCII characters, the letters À to ÿ are known; beside the rest there are cuts only before ASCII white space. With
    another pattern a text is one chunk."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.known = pattern == BYTE_PATTERN
        self.classes, self.between = _classes(), _cut_between()

    def starts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the chunks of texts begin that lie end to end in ``raw``, the text k from ``at[k]`` on."""
        cut = np.zeros(len(raw), bool)
        if self.known and len(raw):
            kind = self.classes[raw]
            lead = np.flatnonzero(raw[:-1] == 0xC3)
            lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
            pair = kind[:-1] << 3
            pair |= kind[1:]
            cut[1:] = self.between[pair]
            after = np.flatnonzero(pair == (_OTHER << 3 | _SPACE)) + 1
            cut[after[~_may_be_space(raw[after - 2], raw[after - 1])]] = True
        begins = at[:-1]
        cut[begins[at[1:] > begins]] = True
        return np.flatnonzero(cut)

    def cut(self, raw: np.ndarray, at: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The chunks of all texts, end to end, and the number of the first one of each text (one more at the end)."""
        starts = self.starts(raw, at)
        ends = np.append(starts, len(raw)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return chunks.dictionary_encode(), np.searchsorted(starts, at)


def _may_be_space(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a character with these last two bytes can be white space beyond ASCII, or a control sign of no known class."""
    latin = (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
    wide = np.isin(before, (0x80, 0x81, 0x9A)) & ((last <= 0x8A) | np.isin(last, (0x9F, 0xA8, 0xA9, 0xAF)))
    return (last < 0x80) | latin | wide
