"""LM scores, quality, top-k and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import brute
from wayfare.llm import common, ppm, quality
from wayfare.llm.queries import ORACLE_SQL, QUERIES
from wayfare.llm.top_k import top_k


@pytest.mark.parametrize("block", [1 << 25, 20_000])
def test_ppm_equals_a_dictionary_trie(spark, docs, texts, block, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK", block)
    got = {r["doc_id"]: r for r in ppm.score_documents(docs).filter("doc_id IS NOT NULL").collect()}
    train = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for d, _ in texts]
    shares = ppm.histograms(*common.buffers(pa.array([t for _, t in texts])))
    ranked = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "k int, doc_id long, text string")
    order = [r["k"] for r in ranked.selectExpr("k", "xxhash64(doc_id, text) AS h").orderBy("h", "k").collect() if train[r["k"]]]
    classes = ppm.nearest(shares, ppm.class_centres(shares[order].astype(np.float32).astype(np.float64)))
    want = brute.ppm([(t, tr, int(c)) for (_, t), tr, c in zip(texts, train, classes, strict=True)], ppm.ORDER)
    for (doc, _), score in zip(texts, want, strict=True):
        if doc is not None:
            assert got[doc]["score"] == pytest.approx(score - np.log10(ppm.CLASSES), rel=1e-9)
    assert ppm.score_documents(docs.limit(0)).count() == 0


def test_classes_are_fitted_on_all_training_documents(spark):
    """6,000 texts, more than were sampled before: each centre is of all of them, however rows are dealt."""
    random = np.random.default_rng(4)
    texts = ["".join(random.choice(list("abcdefgh "), 60)) for _ in range(6000)]
    texts[::900] = ["".join(random.choice(list("日本語の文字"), 20)) for _ in texts[::900]]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    got = ppm.fitted_centres(table.repartition(5))
    shares = ppm.histograms(*common.buffers(pa.array(texts))).astype(np.float32).astype(np.float64)
    assert np.array_equal(got, ppm.class_centres(shares))
    assert np.array_equal(got, ppm.fitted_centres(table.repartition(2)))
    assert (got[:, 0xE6] > 0).any()  # a byte of seven texts only counts in some centre


def test_base_score(docs, texts):
    tokens = [[*brute.words(t, lower=True), None] for _, t in texts]
    train = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for d, _ in texts]
    counts: dict = {}
    for w, t in zip(tokens, train, strict=True):
        for x in w if t else []:
            counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in ppm.score_documents(docs).filter("doc_id IS NOT NULL").collect()}
    for (doc, _), w, t in zip(texts, tokens, train, strict=True):
        if doc is not None:
            r = got[doc]
            assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (not t, len(w), n)
            assert r["n_known"] == sum(counts.get(x, 0) > 0 for x in w)
            assert r["base_score"] == pytest.approx(sum(np.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w), rel=1e-9)


def test_ppm_beats_the_base_on_held_out_documents(spark):
    scores = QUERIES["op2_ppm"](spark, "/root/testdata/sf0.01").filter("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert scores[0] > scores[1]


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op6_quality"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_sum_of_squares_identity():
    machine = quality.Machine()
    random = np.random.default_rng(1)
    machine.weight = random.normal(size=quality.SIZE).astype(np.float32)
    machine.vector = random.normal(0, 0.3, (quality.SIZE, quality.RANK)).astype(np.float32)
    index, value = np.array([3, 70, 900, 11], np.int32), np.array([0.5, -1, 0.25, 2], np.float32)
    pairs = sum(value[i] * value[j] * machine.vector[index[i]] @ machine.vector[index[j]] for i in range(4) for j in range(i))
    want = machine.weight[index] @ value + pairs
    assert machine.scores(index, value, np.array([4]))[0] == pytest.approx(1 / (1 + np.exp(-want)), rel=1e-4)


def test_quality_of_odd_texts(docs, no_docs, spark):
    labels = spark.createDataFrame([(0, 1), (1, 1), (60, 0), (61, 0), (62, 0), (2, None), (None, 1), (60, 0)], "doc_id long, quality int")
    machine = quality.fit_quality(docs, labels)
    assert quality.score_quality(docs, machine).filter("score BETWEEN 0 AND 1").count() == docs.count()
    assert quality.good_documents(docs, machine, -1).columns == docs.columns
    assert quality.good_documents(docs, machine, -1).count() == docs.count()
    assert quality.score_quality(no_docs, quality.fit_quality(no_docs, labels.limit(0))).count() == 0
    unfitted = quality.fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs.drop("n_chars"), unfitted).collect()} == {0.5}


@pytest.mark.parametrize("block", [2048, 2])
def test_top_k(spark, block, monkeypatch):
    monkeypatch.setattr("wayfare.llm.top_k.BLOCK", block)
    random = np.random.default_rng(5)
    rows = [(k, random.standard_normal(6).astype(np.float32).tolist()) for k in range(250)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, rows[0][1]), (400, None), (500, [float("nan")] * 6), (600, [1.0]), (700, [2.0]), (None, rows[0][1])]
    rows += [(k, rows[0][1]) for k in range(310, 330)]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    got = sorted(map(tuple, top_k(vectors, vectors.filter("vec_id % 100 = 0")).collect()))
    whole = {i: np.floor(1024 * np.array(v, np.float64)) for i, v in rows if i is not None and v and np.isfinite(v).all()}
    want = []
    for q in [i for i in whole if i % 100 == 0]:
        scored = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, no_docs, sf_dir):
    columns = docs.columns
    for rows in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            if name != "packing":
                assert out.columns == columns
                rows = common.saved(out, "stage")
        assert out.columns[0] == "doc_id" and (out.count() == 0) == (rows.count() == 0)


def test_queries_with_sql(spark, con, sf_dir):
    from tests.compare import compare_tables

    assert len(QUERIES) == 13
    for name, sql in ORACLE_SQL.items():
        assert compare_tables(QUERIES[name](spark, sf_dir).toPandas(), con.sql(sql).df()) == ""
