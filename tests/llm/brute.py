"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

from wayfare.llm.guess_cost import CHOICE, _alphabet


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def components(nodes: list, links: list[tuple]) -> dict:
    parent = {n: n for n in nodes}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text: str | None) -> set:
    w = words(text, lower=True)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_documents(docs: list[tuple]) -> list[tuple]:
    """(doc_id, shingles, component, kept) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in docs]
    links = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if docs[i][0] is not None and docs[j][0] is not None and sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    of = components(range(len(docs)), links)
    low: dict = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            low[of[i]] = min(doc, low.get(of[i], doc))
    found = [low.get(of[i]) for i in range(len(docs))]
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(docs, sets, found, strict=True)]


def without_repeats(docs: list[tuple], window: int = 20) -> list[tuple]:
    """(doc_id, words, removed, kept text) of rows with different ids."""
    seen, out = set(), {}
    for doc, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            here = tuple(w[s : s + window])
            if here in seen:
                gone[s : s + window] = [True] * window
            seen.add(here)
        out[doc] = (doc, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return [out[d] if d is not None else (None, len(words(t)), 0, b" ".join(words(t)).decode()) for d, t in docs]


def without_known(docs: list[tuple], reference: list, window: int = 20) -> list[tuple]:
    """(doc_id, words, removed, kept text) of rows (doc_id, text) beside the reference's texts."""
    known = {tuple(w[s : s + window]) for w in map(words, reference) for s in range(len(w) - window + 1)}
    out = []
    for doc, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if tuple(w[s : s + window]) in known:
                gone[s : s + window] = [True] * window
        out.append((doc, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def ppm(docs: list[tuple], order: int) -> list[float]:
    """Scores less the class mark, of rows (text, trains, class)."""
    counts: dict = defaultdict(Counter)

    def symbols(word):
        return (257, *(b + 1 for b in word), 33) if word is not None else (257, 258)

    def contexts(f, i, k):
        return [("class", k, f[max(0, i - order) : i]), *(f[i - o : i] for o in range(min(i, order - 1), -1, -1))]

    for text, trains, k in docs:
        for word in [*words(text, lower=True), None] if trains else []:
            f = symbols(word)
            for i in range(1, len(f)):
                for c in contexts(f, i, k):
                    counts[c][f[i]] += 1

    @lru_cache(None)
    def score(word, k):
        f, out = symbols(word), 0.0
        for i in range(1, len(f)):
            excluded: set = set()
            for c in contexts(f, i, k):
                rest = {s: n for s, n in counts.get(c, {}).items() if s not in excluded}
                if not rest:
                    continue
                n, d = sum(rest.values()), len(rest)
                if f[i] in rest:
                    out += math.log10(2 * rest[f[i]] / (2 * n + d))
                    break
                out += math.log10(d / (2 * n + d))
                excluded |= set(rest)
            else:
                out -= math.log10(257 - len(excluded))
        return out

    return [sum(score(w, k) for w in [*words(t, lower=True), None]) for t, _, k in docs]


def prefix_tree(rows: list[tuple]) -> set[tuple]:
    """Nodes of rows (conv_id, turn, role, text); no equal turns in one conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(int(c / 20) * 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)

    def saved(node):
        return (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0

    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.add(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(m) == len(node) + 1 for m in below),
                sum(not any(len(x) == len(m) + 1 and x[:-1] == m for x in members) for m in below),
                sum(map(saved, below)),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return out


def hard_negatives(rows: list[tuple], anchors: list[tuple], scale: int = 256) -> list[tuple]:
    """Result rows for rows (vec_id, vector, label)."""

    def whole(v):
        return [math.floor(scale * float(x)) for x in v]

    use = [(i, whole(v), y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, v, y in anchors:
        scored = [(sum(p * q for p, q in zip(whole(v), w, strict=True)), i, z) for i, w, z in use if i != a and len(w) == len(v)]
        positives = sorted(((-s, i) for s, i, z in scored if z == y))[:5]
        for p, i in positives:
            negatives = sorted((-s, j) for s, j, z in scored if z != y and 80 * -p <= 100 * s <= 100 * -p)[:5]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(negatives)]
    return sorted(out)


def least_cost(cost, value: str) -> float:
    """Least cost over all ways to cut a value, tried one by one."""
    segments, each = cost.segments(value), _alphabet(value)

    @lru_cache(None)
    def rest(i: int, brute: bool) -> float:
        """From place i on; ``brute`` if a brute-force span reaches up to here."""
        if i == len(value):
            return 0.0
        ways = [CHOICE + c + rest(j, False) for j, c in segments.get(i, [])]
        return min([*ways, (0.0 if brute else CHOICE) + each + rest(i + 1, True)])

    return rest(0, False)


def base_spans(text: str | None) -> list[tuple]:
    """(start, kind, end) of the fixed patterns, found letter by letter."""
    text = text or ""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    out, i = [], 0
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    while i < len(text):
        found = None
        for name in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if not lower.startswith(name, i):
                continue
            k = i + len(name)
            k += text[k : k + 1] in ("'", '"') and bool(text[k : k + 1])
            while text[k : k + 1] == " ":
                k += 1
            if text[k : k + 1] not in (":", "=") or not text[k : k + 1]:
                continue
            k += 1
            while text[k : k + 1] == " ":
                k += 1
            k += text[k : k + 1] in ("'", '"') and bool(text[k : k + 1])
            end = k
            while end < len(text) and text[end] in value:
                end += 1
            if end > k:
                found = (k, end)
                break
        if found:
            if found[1] - found[0] >= 12:
                out.append((i, 0, found[1]))
            i = found[1]
        else:
            i += 1
    for kind, start, letters, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), (2, "", "0123456789abcdef", 16)):
        i = 0
        while i < len(text):
            end = i + len(start)
            if not text.startswith(start, i):
                i += 1
                continue
            while end < len(text) and text[end] in letters:
                end += 1
            if end > i + len(start) and end - i >= least:
                out.append((i, kind, end))
            i = max(end, i + 1) if end > i + len(start) else i + 1
    return sorted(out)
