"""Secret scans: patterns, and the guess cost of values in the context of a credential.

Base spans come from three patterns (an assignment to a credential's name, an access key, a run of hexadecimal digits),
leftmost and without overlap within a kind; matches that are too short are dropped.

A value that follows a wider set of credential names is judged by its guess cost: the least decimal logarithm of the
guesses that find it, over all ways to cut it into segments, by dynamic programming over its places. A segment is a
word of a ranked dictionary (any case, usual replacements of letters by signs), a date or year, a repetition of
a unit of at most ``UNIT`` characters, a walk over neighbouring keys of a keyboard, or a brute-force
span; each one costs a choice of its kind besides. A repetition or a walk reaches as far as it goes from where it begins.
Values that cost at least ``least_cost`` are secrets; those outside base spans are added as spans of kind "guess". Plain words,
dates, placeholders and rulers cost little and stay. The value of an assignment carries its cost, too.

Places are code points, ends exclusive. Null text: as empty, no spans. Texts are scanned whole, and a value's cost
takes time in proportion to its length. Rows are independent of each other: repeated rows and null ids
give one result each, an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from math import comb, log10

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm import common

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ["assign", "access", "hex", "guess"]

#: Names of credentials, what may stand between name and value, and the value.
CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret|signing)[ _-]?key|auth(?:orization)?|credentials?|key)"""
    r"""["'`]?[ \t]*(?:[:=]>?|\bis\b)[ \t]*(?:(?:bearer|basic)[ \t]+)?["'`]?([^\s"'`<>]+)""",
    re.I | re.A,
)
#: Values from so many characters on are judged; those without a digit or without a letter are prose or numbers, and
#: those with :// addresses.
LEAST_LENGTH, LEAST_COST = 8, 10.0
UNIT, WALK = 8, 4
CHOICE, YEARS = log10(5), log10(200)
DATE, PARTED = YEARS + log10(366), log10(4)
#: Letters that signs and digits often stand for.
USUAL = str.maketrans("4@83610!5$7", "aabegoiisst")
ROWS = ["`1234567890-=", "\tqwertyuiop[]\\", "\tasdfghjkl;'", "\tzxcvbnm,./"]
KEY = {k: (r, c) for r, row in enumerate(ROWS) for c, k in enumerate(row) if k != "\t"}
#: From a key to a neighbour: in its row, or in the rows above and below, which lie half a key aside.
STEPS = {(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)}
MONTH, DAY, YEAR = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])", "(?:19|20)[0-9][0-9]"
DATES = [
    (re.compile(f"(?=({YEAR}{sep}{MONTH}{sep}{DAY}|{DAY}{sep}{MONTH}{sep}{YEAR}|{MONTH}{sep}{DAY}{sep}{YEAR}))"), DATE + PARTED * (sep != ""))
    for sep in ("", "[-/._]")
] + [(re.compile(f"(?=({YEAR}))"), YEARS)]


def word_costs(path: str) -> dict[str, float]:
    """Logarithm of the rank of each whole word of letters in a vocabulary that is ordered by frequency."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    whole = [w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    words = [w for w in whole if len(w) >= 3 and w.isascii() and w.isalpha()]
    return {w: log10(rank + 2) for rank, w in enumerate(words)}


def _case_cost(segment: str) -> float:
    upper, lower = sum(c.isupper() for c in segment), sum(c.islower() for c in segment)
    if not upper:
        return 0.0
    if not lower or (upper == 1 and segment[0].isupper()):
        return log10(2)
    return log10(sum(comb(upper + lower, k) for k in range(1, min(upper, lower) + 1)))


def _alphabet(value: str) -> float:
    """Logarithm of the size of the classes of characters that the value holds: digits, small and capital letters, the rest."""
    sizes = (10 * any(c.isdecimal() for c in value), 26 * any(c.islower() for c in value), 26 * any(c.isupper() for c in value))
    return log10(sum(sizes) + 33 * any(not c.isalnum() for c in value) or 33)


class GuessCost:
    """Least logarithm of guesses for a value."""

    def __init__(self, words: dict[str, float]):
        self.words, self.longest = words, max(map(len, words), default=0)

    def segments(self, value: str) -> dict[int, list[tuple[int, float]]]:
        """(end, cost) of the segments that begin at each place, but for brute-force spans."""
        n, each, low = len(value), _alphabet(value), "".join(c.lower() if c.isascii() else c for c in value)
        plain, found = low.translate(USUAL), {}

        def add(i: int, j: int, cost: float) -> None:
            found.setdefault(i, []).append((j, cost))

        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                if (cost := self.words.get(plain[i:j])) is not None:
                    replaced = sum(a != b for a, b in zip(low[i:j], plain[i:j], strict=True))
                    add(i, j, cost + replaced * log10(2) + _case_cost(value[i:j]))
        for pattern, cost in DATES:
            for m in pattern.finditer(value):
                add(m.start(1), m.end(1), cost)
        for unit in range(1, UNIT + 1):
            run = 0  # places from here on that equal the one a unit later
            for i in range(n - unit - 1, -1, -1):
                run = run + 1 if value[i] == value[i + unit] else 0
                times = run // unit + 1
                if times >= 2 and times * unit >= 3:
                    add(i, i + times * unit, unit * each + log10(times))
        steps = [None] * n
        for i in range(n - 1):
            a, b = KEY.get(low[i]), KEY.get(low[i + 1])
            step = (b[0] - a[0], b[1] - a[1]) if a and b else None
            steps[i] = step if step in STEPS else None
        end, turns = n, 0
        for i in range(n - 1, -1, -1):
            if steps[i] is None:
                end, turns = i + 1, 0
                continue
            turns += i + 1 < end - 1 and steps[i] != steps[i + 1]
            if end - i >= WALK:
                add(i, end, log10(len(KEY)) + (turns + 1) * log10(len(STEPS)) + log10(end - i) + _case_cost(value[i:end]))
        return found

    def __call__(self, value: str) -> float:
        n, each, found = len(value), _alphabet(value), self.segments(value)
        best, brute = [0.0] + [float("inf")] * n, float("inf")  # up to each place; with a brute-force span at its end
        for i in range(n):
            best[i] = min(best[i], brute)
            for j, cost in found.get(i, ()):
                best[j] = min(best[j], best[i] + CHOICE + cost)
            brute = min(brute, best[i] + CHOICE) + each
        return min(best[n], brute)


class Scanner:
    """Spans (kind, start, end, cost) of a text."""

    def __init__(self, path: str, least_cost: float):
        self.cost, self.least = GuessCost(word_costs(path)), least_cost

    def base(self, text: str) -> list[tuple]:
        spans = [
            ("assign", m.start(), m.end(), self.cost(m[2])) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH
        ]
        spans += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
        return spans + [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]

    def spans(self, text: str | None) -> list[tuple]:
        """All spans, by start, then kind."""
        text = text or ""
        spans = self.base(text)
        taken = list(spans)
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".,;:!?)]}")
            a, b = m.start(1), m.start(1) + len(value)
            if len(value) < LEAST_LENGTH or not (any(map(str.isdecimal, value)) and any(map(str.isalpha, value))) or "://" in value:
                continue
            if any(start < b and a < end for _, start, end, _ in taken):
                continue
            cost = self.cost(value)
            if cost >= self.least:
                spans.append(("guess", a, b, cost))
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


_SCANNERS: dict[tuple[str, float], Scanner] = {}


def scanner(path: str, least_cost: float) -> Scanner:
    """This worker's scanner for a dictionary."""
    if (path, least_cost) not in _SCANNERS:
        _SCANNERS[path, least_cost] = Scanner(path, least_cost)
    return _SCANNERS[path, least_cost]


def find_secrets(docs: DataFrame, path: str, least_cost: float = LEAST_COST) -> DataFrame:
    """doc_id and the spans of each document, by start, then kind; ``path`` is a vocabulary that ranks words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(path, least_cost)
        for batch in batches:
            for part in common.slices(batch):
                found = [own.spans(t) for t in part["text"].to_pylist()]
                spans = [[dict(zip(("kind", "start", "end", "cost"), s, strict=True)) for s in f] for f in found]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(spans, kind)], ["doc_id", "spans"])

    common.prepared(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,cost:double>>"
    )


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
