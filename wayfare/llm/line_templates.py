"""Line dedup: a log-template tree of fixed depth, with DataFrame functions only.

A line goes down the tree by its number of tokens and its first ``DEPTH`` tokens, where a token with a digit
counts as variable. In a leaf, a token stays fixed where ``min_docs`` documents have it at that place;
other places are variable. Lines of a leaf with the same fixed tokens share a template. A template recurs if
``min_docs`` documents have it and at least half of its places are fixed. Recurring lines are dropped from all
documents but the one with the smallest id, so one copy of each stays. Documents with equal texts count once here: whole
copies are left to document dedup.

A first pass over all lines finds the leaves that enough documents share; only lines of these go on.
Counts combine in the map tasks, and no line, leaf or template is gathered in one row.

A column n_lines or n_dropped of the input is replaced. Null text: stays null, has no lines. Empty lines and lines of white space stay. A null id is a document of its own
for each text; it is never the smallest, unless there is no other. Repeated rows get the same
result. Very long texts: every line of them counts; a text's lines are one array while its own row is made. An empty table
gives an empty one. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm import common
from wayfare.llm.common import saved

DEPTH, MIN_DOCS, SPACES = 3, 5, " \t\r\f\x0b"
#: Tasks that the lines of one template are dealt to.
SALTS = 16


def _text_key() -> Column:
    return F.xxhash64("text")


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line with tokens: id and key of its document, place, tokens, and its leaf."""
    lines = docs.filter("text IS NOT NULL").select("doc_id", _text_key().alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.trim("line", F.lit(SPACES))).filter("line <> ''")
    lines = lines.withColumn("tokens", F.split("line", f"[{SPACES}]+"))
    head = F.transform(F.slice("tokens", 1, DEPTH), lambda t: F.when(t.rlike("[0-9]"), "<*>").otherwise(t))
    return lines.select("doc_id", "text_key", "pos", "tokens", F.xxhash64(F.size("tokens"), head).alias("leaf"))


def _shared(rows: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Keys that occur in at least so many different texts."""
    once = rows.groupBy(*keys, "text_key").agg(F.min("doc_id").alias("first"))
    counted = once.groupBy(*keys).agg(F.count("*").alias("docs"), F.min("first").alias("first"))
    return counted.filter(F.col("docs") >= min_docs).drop("docs")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_key and pos of the lines to drop."""
    lines = _lines(docs)
    leaves = saved(_shared(lines.drop("tokens"), ["leaf"], min_docs).drop("first"), "leaves")
    lines = saved(lines.join(leaves, "leaf"), "leaf-lines")
    tokens = lines.select("doc_id", "text_key", "pos", "leaf", F.posexplode("tokens").alias("i", "token"))
    tokens = tokens.withColumn("variable", F.col("token").rlike("[0-9]"))
    fixed = _shared(tokens.filter("NOT variable"), ["leaf", "i", "token"], min_docs)
    fixed = fixed.select("leaf", "i", "token", F.lit(True).alias("fixed"))
    templates = (
        tokens.join(fixed, ["leaf", "i", "token"], "left")
        .withColumn("fixed", F.coalesce("fixed", F.lit(False)))
        .groupBy("doc_id", "text_key", "pos", "leaf")
        .agg(
            F.expr("bit_xor(if(fixed, xxhash64(i, token), 0))").alias("template"),
            F.count_if("fixed").alias("n_fixed"),
            F.count("*").alias("n"),
        )
        .filter(F.col("n_fixed") * 2 >= F.col("n"))
        .select("doc_id", "text_key", "pos", "leaf", "template")
    )
    templates = saved(templates, "templates")
    # one template may be on a large share of all lines: these meet copies of its row, by the text they are of
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    recurring = _shared(templates, ["leaf", "template"], min_docs).select("*", salts)
    salted = templates.withColumn("salt", F.expr(f"CAST(pmod(text_key, {SALTS}) AS INT)"))
    later = salted.join(recurring, ["leaf", "template", "salt"]).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    return later.select("doc_id", "text_key", "pos")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their text less the recurring lines, and the number of lines before and dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    names, docs = docs.columns, common.carried(docs)
    dropped = recurring_lines(docs.select("doc_id", "text"), min_docs).groupBy("doc_id", "text_key")
    dropped = dropped.agg(F.collect_set("pos").alias("_drop"))
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_drop")
    found = docs.join(dropped, docs["doc_id"].eqNullSafe(F.col("_id")) & (_text_key() == F.col("_key")), "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    kept = F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(kept)
    result = found.withColumn("_lines", lines).select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns), count("_lines"), count("_drop")
    )
    return result.toDF(*names, "n_lines", "n_dropped")


SQL = f"""
WITH lines AS (
  SELECT doc_id, text, pos,
    regexp_split_to_array(trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)), '[ \\t\\r\\f\\v]+') AS tokens
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL)
  WHERE trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> ''
),
leafed AS (
  SELECT *, [len(tokens)::VARCHAR] || [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN tokens[1:{DEPTH}]] AS leaf
  FROM lines
),
leaves AS (SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT text) >= {MIN_DOCS}),
toks AS (
  SELECT doc_id, text, pos, leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i
  FROM leafed WHERE leaf IN (SELECT leaf FROM leaves)
),
fixed AS (
  SELECT leaf, i, token FROM toks WHERE NOT regexp_matches(token, '[0-9]')
  GROUP BY leaf, i, token HAVING count(DISTINCT text) >= {MIN_DOCS}
),
templates AS (
  SELECT t.doc_id, t.text, t.pos, t.leaf, list(f.token ORDER BY t.i) AS template
  FROM toks t LEFT JOIN fixed f ON t.leaf = f.leaf AND t.i = f.i AND t.token = f.token
  GROUP BY t.doc_id, t.text, t.pos, t.leaf
  HAVING 2 * count(f.token) >= count(*)
),
recurring AS (
  SELECT leaf, template, min(doc_id) AS first_doc FROM templates
  GROUP BY leaf, template HAVING count(DISTINCT text) >= {MIN_DOCS}
),
dropped AS (
  SELECT DISTINCT t.doc_id, t.pos FROM templates t JOIN recurring r ON t.leaf = r.leaf AND t.template = r.template
  WHERE t.doc_id <> r.first_doc
),
every AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
)
SELECT e.doc_id, count(*) AS n_lines, count(d.pos) AS n_dropped,
  sha256(coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE d.pos IS NULL), '')) AS kept_sha256
FROM every e LEFT JOIN dropped d ON e.doc_id = d.doc_id AND e.pos = d.pos
GROUP BY e.doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
