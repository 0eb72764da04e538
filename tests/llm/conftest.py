from __future__ import annotations

import random

import pytest

#: Columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, start int, n int, places string, line string, score double, kept boolean, block long, _id long, _key string, _drop int, _lines string, _places long, _firsts array<int>, carried_0 long, n_lines long"


def _prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["tion", "er", "Ou", "née", "st", "ble", "12", "ß", "the"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) + r.choice(["", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list[tuple]:
    """(doc_id, text): copies, near copies, shared passages and lines, ties, odd and long texts."""
    base = [_prose(k, 60 + 7 * k) for k in range(12)]
    rows = list(enumerate(base))
    for k in range(8):
        changed = base[3].split(" ")
        changed[10 + 5 * k] = f"edit{k}"
        rows.append((20 + k, " ".join(changed)))
    rows += [(40 + k, base[5]) for k in range(3)]
    rows += [(50 + k, f"{_prose(100 + k, 30)} {base[7]} {_prose(200 + k, 30)}") for k in range(4)]
    rows += [(60 + k, f"{_prose(300 + k, 12)}\nRequest {k} took {17 * k} ms on host h{k}\nAll rights reserved here.\n{_prose(400 + k, 12)}") for k in range(9)]
    rows += [(70, None), (71, ""), (72, " \n\t "), (73, "one two three"), (74, "ONE two\nthree"), (75, "x" * 5000), (76, "a " * 300)]
    rows += [(77, "don't <|endoftext|> İ ǰ J̌ 日本語 🙂 \x1c\x85   12½"), (78, _prose(9, 20000))]
    rows += [(None, base[2]), (None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t) if t else None, 1, 2, 3, "p", "l", 0.5, True, 4, 5, "k", 6, "l", 7, [8], 9, 10) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
