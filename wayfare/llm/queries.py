"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.byte_bpe import encode_decode
from wayfare.llm.common import documents, held_out, table
from wayfare.llm import line_templates
from wayfare.llm.guess_cost import as_text, find_secrets
from wayfare.llm.kronecker import hard_negatives
from wayfare.llm.minhash import near_documents
from wayfare.llm.packing import pack
from wayfare.llm.ppm import score_documents
from wayfare.llm.prefix_tree import prefix_tree, turn_sequences, with_shared_starts
from wayfare.llm.quality import fit_quality, score_quality
from wayfare.llm.substrings import remove_repeats
from wayfare.llm.subspace_join import near_vectors
from wayfare.llm.token_counts import token_counts
from wayfare.llm.top_k import top_k


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = encode_decode(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(documents(spark, sf_dir)).drop("text_key")


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring_lines(documents(spark, sf_dir))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(documents(spark, sf_dir), layout=False)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree(with_shared_starts(turn_sequences(table(spark, sf_dir, "conversations"))))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))
    counts = [f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS LONG) AS n_{k}" for k in ("assign", "access", "hex")]
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *map(F.expr, counts),
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    vectors = vectors.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ppm": op2_ppm,
    "op3_top_k": op3_top_k,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_minhash": op7_minhash,
    "op8_line_templates": op8_line_templates,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_substrings": op10_substrings,
    "op11_prefix_tree": op11_prefix_tree,
    "op12_secrets": op12_secrets,
    "op13_hard_negatives": op13_hard_negatives,
}

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

#: crc32 of the id's digits, bit by bit; every node is the list of its turns' digests. The root has no parent: whole numbers
#: with nulls come as doubles from both sides of the comparison.
PREFIX_TREE_SQL = r"""
WITH ids AS (
  SELECT conv_id, xor(list_reduce(
      list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda crc, b: list_reduce(
        list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))),
    4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k, digest, words
  FROM (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL)
),
rebuilt AS (
  SELECT ids.conv_id, 0 AS part, t.k, t.digest, t.words
  FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 20 AND t.k <= ids.h
  UNION ALL
  SELECT ids.conv_id, 1, t.k, t.digest, t.words FROM ids JOIN t ON t.conv_id = ids.conv_id AND t.k > ids.h
),
conv AS (
  SELECT ids.conv_id, coalesce(p, []) AS p, w
  FROM ids LEFT JOIN (
    SELECT conv_id, list(digest ORDER BY part, k) AS p, list(words ORDER BY part, k) AS w FROM rebuilt GROUP BY conv_id
  ) USING (conv_id)
),
member AS (SELECT conv_id, p, w, unnest(range(0, len(p) + 1)) AS depth FROM conv),
node AS (
  SELECT p[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * coalesce(any_value(w[depth]), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(p) = depth), '')) AS ends_sha256
  FROM member GROUP BY ALL
),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
kin AS (SELECT node, depth, saved, unnest(range(0, depth + 1)) AS above FROM node),
below AS (
  SELECT kin.node[1:above] AS node, count(*) FILTER (children.n IS NULL) AS n_leaves, sum(saved) AS saved_tokens
  FROM kin LEFT JOIN children ON children.node = kin.node GROUP BY ALL
)
SELECT node.conv_id, node.depth, CAST(parent.conv_id AS DOUBLE) AS parent_conv_id, node.n_convs, coalesce(children.n, 0) AS n_children,
  below.n_leaves, CAST(below.saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node
JOIN below ON below.node = node.node
LEFT JOIN children ON children.node = node.node
LEFT JOIN node AS parent ON node.depth > 0 AND parent.depth = node.depth - 1 AND parent.node = node.node[1:node.depth - 1]
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.c, v.c) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id AND len(a.c) = len(v.c)
  WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op3_top_k": TOP_K_SQL,
    "op8_line_templates": line_templates.SQL,
    "op11_prefix_tree": PREFIX_TREE_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
