"""Near copies, repeated passages, line templates and near vectors against brute force."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.test_tokens import key
from wayfare.llm import known_passages, minhash, subspace_join, substrings
from wayfare.llm.components import components
from wayfare.llm.known_passages import remove_known
from wayfare.llm.line_templates import SQL, drop_recurring_lines
from wayfare.llm.minhash import near_documents, one_of_each
from wayfare.llm.substrings import remove_repeats
from wayfare.llm.subspace_join import near_vectors


def test_components(spark):
    links = [(5, 3), (3, 9), (9, 1), (20, 21), (21, 22), (30, 30), (7, 8), (8, 7), *((100, k) for k in range(101, 140))]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = brute.components(sorted({x for p in links for x in p} - {30}), links[:5] + links[6:])
    assert got == want


def test_near_documents(docs, texts):
    got = near_documents(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = [(*r[:3], r[3]) for r in brute.near_documents(texts)]
    want = [(d, n, c, True if d is None else k) for d, n, c, k in want]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_near_documents_in_many_tiles(docs, texts, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 150)
    got = near_documents(docs).select("doc_id", "component_id").collect()
    want = [(r[0], r[2]) for r in brute.near_documents(texts)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def _short_sets(n, rare=20):
    """Sets of 26 shingles of 40 that most share, and some of their own."""
    random = np.random.default_rng(11)
    return [np.unique(np.r_[random.choice(40, rare, False), 1000 + random.integers(0, 3 * n, 26 - rare)]).astype(np.uint64) for _ in range(n)]


def test_tile_of_many_short_documents_is_counted_in_strips():
    sets = _short_sets(12_000)
    tile = pa.table({"node": pa.array(range(len(sets)), pa.int64()), "elements": pa.array([x.tobytes() for x in sets], pa.binary())})
    tracemalloc.start()
    try:
        minhash._linked(tile)
        assert tracemalloc.get_traced_memory()[1] < 300e6  # all pairs at once: 576 MB, and 1152 MB in between
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("strip", [1, 700, 1 << 22])
@pytest.mark.parametrize("rare", [3, 20])
def test_shared_counts_of_strips(strip, rare, monkeypatch):
    monkeypatch.setattr(minhash, "STRIP", strip)
    sets = _short_sets(150, rare)
    strips = list(minhash._shared_counts(np.concatenate(sets), np.array([len(x) for x in sets])))
    assert max(c.size for _, c in strips) <= max(strip, len(sets))
    got = np.vstack([c for _, c in strips])
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert np.array_equal(np.triu(got, 1), np.triu(want, 1))


def test_tiles_are_bounded_by_documents(spark, monkeypatch):
    sets = _short_sets(300)
    rows = [(k, k % 3 if k < 150 else 9, 15_000 if k >= 150 else 5_000, x.tobytes()) for k, x in enumerate(sets)]
    monkeypatch.setattr(minhash, "TILE", 5_000)
    tiles = []
    confirm = minhash._confirm
    monkeypatch.setattr(minhash, "_confirm", lambda s, keys: tiles.append(s.groupBy(*keys).count().agg({"count": "max"}).first()[0]) or confirm(s, keys))
    minhash.confirmed_links(spark.createDataFrame(rows, "node long, part long, size long, elements binary"))
    assert len(tiles) == 3 and max(tiles) <= 2 * 2 * 5_000 // minhash.LEAST


def _bands_of(sets):
    return minhash.band_keys(minhash.signatures(np.concatenate(sets), np.array([len(x) for x in sets])))


def test_planted_pairs_near_the_threshold_meet():
    """2,000 pairs of similarity 0.75 to 0.80, of short and long sets."""
    random = np.random.default_rng(21)
    sets = []
    for _ in range(2000):
        n, similarity = int(random.integers(40, 400)), random.uniform(0.75, 0.80)
        both = int(np.ceil(similarity * 2 * n / (1 + similarity)))
        own = random.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        sets += [own[:n], np.concatenate([own[:both], own[n:]])]
        assert 0.75 <= both / (2 * n - both) < 0.83
    keys = _bands_of(sets)
    assert (keys[::2] == keys[1::2]).any(axis=1).mean() >= 0.999


def test_shared_boilerplate_alone_makes_few_candidates():
    """20,000 documents with a fifth of their shingles in common, and nothing else."""
    random = np.random.default_rng(22)
    common_part = random.integers(0, 2**63, 30, dtype=np.uint64)
    sets = [np.concatenate([common_part, random.integers(0, 2**63, 120, dtype=np.uint64)]) for _ in range(20_000)]
    keys = _bands_of(sets)
    _, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    meets = (counts[at].reshape(keys.shape) > 1).any(axis=1)
    assert meets.mean() < 0.04  # bands of three rows: a fifth


def test_one_of_each_keeps_columns(docs, texts):
    kept = one_of_each(docs.union(docs))
    assert kept.columns == docs.columns
    want = sorted(r[0] for r in brute.near_documents(texts) if r[0] is not None and r[3])
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None) == want


def test_removed_repeats(docs, texts):
    got = remove_repeats(docs, layout=False).select("doc_id", "n_words", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.without_repeats(texts), key=key)


def test_frequent_anchors_and_equal_rows(docs, texts, monkeypatch):
    monkeypatch.setattr("wayfare.llm.substrings.FREQUENT", 1)
    got = remove_repeats(docs.union(docs), layout=False).select("doc_id", "n_words", "n_removed", "text").collect()
    want = brute.without_repeats(texts)
    assert sorted(map(tuple, got), key=key) == sorted(want + want, key=key)


def test_removed_repeats_of_many_shards(docs, texts, monkeypatch):
    monkeypatch.setattr("wayfare.llm.substrings.SHARD", 200)
    got = remove_repeats(docs, layout=False).select("doc_id", "n_words", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.without_repeats(texts), key=key)


@pytest.fixture(scope="module")
def reference(texts):
    """Texts of which documents hold all, a stretch, or 19 words; overlapping, repeated, short, empty and null ones."""
    w = [t.split() if t else [] for _, t in texts]
    rows = [texts[7][1], texts[7][1], " ".join(w[9][5:40]), " ".join(w[9][30:70]), " ".join(w[11][3:22]), " ".join([*w[1][4:24], "end"])]
    return [*rows, " ".join(w[-3][9000:13000]), "a " * 30, "one two three", "", None]


@pytest.mark.parametrize(("piece", "shard", "at_once"), [(10_000, 100_000, 4), (7, 60, 3)])
def test_known_passages(spark, docs, texts, reference, piece, shard, at_once, monkeypatch):
    for name, value in (("PIECE", piece), ("SHARD", shard), ("AT_ONCE", at_once)):
        monkeypatch.setattr(known_passages, name, value)
    if shard == 60:
        reference = [" ".join(r.split()[:400]) if r else r for r in reference]
    table = spark.createDataFrame([(r,) for r in reference], "text string")
    got = remove_known(docs.union(docs), table, layout=False)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    want = brute.without_known(texts, reference)
    assert sum(r[2] > 0 for r in want) > 5
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "text").collect()), key=key) == sorted(want + want, key=key)


def test_known_passages_keep_the_layout_and_refuse_more_than_the_bound(spark, docs, no_docs, texts, reference):
    table = spark.createDataFrame([(r,) for r in reference], "text string")
    rows = {r["doc_id"]: r for r in remove_known(docs, table).filter("doc_id IS NOT NULL").collect()}
    for (doc, text), want in zip(texts, brute.without_known(texts, reference), strict=True):
        if doc is not None:
            assert rows[doc]["text"] == text if not want[2] else rows[doc]["text"].split() == want[3].split()
    assert remove_known(no_docs, table).count() == 0
    assert remove_known(docs, no_docs).agg({"n_removed": "sum"}).first()[0] == 0
    with pytest.raises(ValueError, match="more than the 100 "):
        remove_known(docs, table, most_words=100)


def test_layout_stays(docs, texts):
    rows = {r["doc_id"]: r for r in remove_repeats(docs).filter("doc_id IS NOT NULL").collect()}
    for doc, text in texts:
        if doc is not None and rows[doc]["n_removed"] == 0:
            assert rows[doc]["text"] == text
        elif doc is not None:
            assert rows[doc]["text"].split() == brute.without_repeats(texts)[[d for d, _ in texts].index(doc)][3].split()


def test_line_templates(docs, texts, con):
    known = docs.filter("doc_id IS NOT NULL")
    con.register("d", known.select("doc_id", "text").toPandas())
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM d")
    try:
        want = {r[0]: r[1:3] for r in con.sql(SQL).fetchall()}
    finally:
        con.execute("DROP VIEW temp.documents")
    got = drop_recurring_lines(docs)
    assert got.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_dropped"]
    rows = {r["doc_id"]: r for r in got.filter("doc_id IS NOT NULL").collect()}
    assert {d: (r["n_lines"], r["n_dropped"]) for d, r in rows.items()} == want
    assert "rights" in rows[60]["text"] and "rights" not in rows[61]["text"] and "Request" not in rows[61]["text"]
    assert rows[70]["text"] is None and rows[72]["text"] == " \n\t "


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    base = r.standard_normal((60, 24))
    near = base[:20] + 0.05 * r.standard_normal((20, 24))
    rows = [(k, v.tolist()) for k, v in enumerate(np.vstack([base, near, base[:5], base[:5] * 3]).astype(np.float32))]
    rows += [(200, None), (201, []), (202, [0.0] * 24), (203, [float("nan")] * 24), (204, [None, *[1.0] * 23]), (205, [float("inf")] * 24)]
    return [*rows, (206, [1.0, 0.0]), (207, [1.0, 0.01]), (None, [1.0, 0.0])]


@pytest.mark.parametrize(("cell", "homes", "guests"), [(4096, 8192, 32768), (4, 5, 7)])
def test_near_vectors(spark, vectors, cell, homes, guests, monkeypatch):
    for name, value in (("CELL", cell), ("HOMES", homes), ("GUESTS", guests)):
        monkeypatch.setattr(subspace_join, name, value)
    got = near_vectors(spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<float>, n int, other string"))
    ok = {i: np.array(v, np.float64) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    links = [(a, b) for a in ok for b in ok if a < b and cos(ok[a], ok[b])]
    of = brute.components([i for i, _ in vectors if i is not None], links)
    n = {i: sum(i in p for p in links) for i in of}
    want = [(i, n.get(i, 0), of.get(i), i is None or of[i] == i) for i, _ in vectors]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_near_vectors_of_doubles(spark):
    """Pairs on either side of 0.95 by less than a float tells apart, and components beyond the range of floats."""
    at = lambda c, k: [0.0] * (2 * k) + [c, float(np.sqrt(1 - c * c))] + [0.0] * (6 - 2 * k)
    rows = [(0, at(1.0, 0)), (1, at(0.95 + 1e-10, 0)), (2, at(1.0, 1)), (3, at(0.95 - 1e-10, 1))]
    rows += [(4, [0.0] * 4 + [1e300, 2e300, 0.0, 0.0]), (5, [0.0] * 4 + [1e-300, 2e-300, 0.0, 0.0])]
    rows += [(6, [0.0] * 6 + [1.0, 0.0]), (7, [0.0] * 6 + [1.0, 1e-12])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("vec_id", "n_links", "component_id")
    assert sorted(map(tuple, got.collect())) == [(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6)]


def test_empty_tables(spark, no_docs):
    assert near_documents(no_docs).count() == 0
    assert one_of_each(no_docs).count() == 0
    assert remove_repeats(no_docs).count() == 0
    assert drop_recurring_lines(no_docs).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_removed_words_are_those_under_a_repeated_window():
    places = [{"start": 2, "n": 3}, {"start": 30, "n": 2}]
    firsts = [{"start": 2, "mask": 0b101}, {"start": 30, "mask": 0b11}]
    gone = substrings.removed_words(60, places, firsts)
    assert np.flatnonzero(gone).tolist() == list(range(3, 23))
    words = [b"w%d" % i for i in range(60)]
    assert substrings.kept_text(b" \n".join(words), gone, False, words) == b" ".join(words[:3] + words[23:])
