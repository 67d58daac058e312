"""Queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.llm.common import table
from custvalue.llm.decontaminate import contamination
from custvalue.llm.language import identify_languages
from custvalue.llm.lsh_forest import minhash_components
from custvalue.llm.merkle import verified_manifest
from custvalue.llm.mixing import mix
from custvalue.llm.pii import personal_data
from custvalue.llm.prefix_trie import prefix_trie, rebased, turn_sequences
from custvalue.llm.quality import quality_scores
from custvalue.llm.sharding import shard_documents
from custvalue.llm.shards import materialise
from custvalue.llm.simhash import simhash_components
from custvalue.llm.spotsigs import fingerprints
from custvalue.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and benchmark items of every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(coalesce(" + _FOLDED + ", ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL["op7_benchmark_decontamination"] = f"""
WITH iw AS (SELECT item_id::VARCHAR AS item, {_WORDS.format("text")} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[a:a + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM iw WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
spots AS (
  SELECT doc_id, a, size, array_to_string(w[a:a + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS a
        FROM d, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)),
hits AS (SELECT doc_id, a, s.size, item FROM spots s JOIN wins USING (win)),
per AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(a, a + size)) AS p FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trained quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with its text, once per pass of its source, with weight and training position."""
    return mix(table(spark, sf_dir, "documents"))


@query
def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents in training order: the files are written; one manifest row per record."""
    return materialise(table(spark, sf_dir, "documents"))


@query
def op8_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of even row counts."""
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code length."""
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by maximal scoring segments."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprint of every document and of its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each with its first turns taken from the start of its twenty."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    seqs = rebased(turn_sequences(table(spark, sf_dir, "conversations")), every=20, head=head, most=3)
    return prefix_trie(seqs).drop("turn_key")


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, roots and proof of every document; documents whose id's CRC-32 divides by 7 are
    verified with one character too many in ``n_chars``."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return verified_manifest(table(spark, sf_dir, "documents"), chosen, more)


@query
def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of every document, by an LSH forest."""
    return minhash_components(table(spark, sf_dir, "documents"), size=2, percent=80)


# CRC-32 of a decimal number: the reversed polynomial, bit by bit over its digits
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, "
    "list_transform(string_split(({0})::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
    "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))")


def _leaf(n_chars: str) -> str:
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(strlen(lang) || ':' || lang, '-') AS tree, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_CRC.format("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS false_leaf
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot,
         count(*) OVER (PARTITION BY tree) AS n
  FROM d),
low AS (
  SELECT tree, lang, 0 AS level, slot, leaf AS hash, n FROM leaves
  UNION ALL
  SELECT tree, any_value(lang), any_value(level) + 1, slot // 2, sha256(string_agg(hash, '' ORDER BY slot)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, slot // 2),
subroots AS (
  SELECT tree, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n_trees,
         level AS height
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place AS slot, subroot AS hash, n_trees AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, slot // 2, sha256(string_agg(hash, '' ORDER BY slot)), (any_value(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY slot // 2),
way AS (
  SELECT l.doc_id, l.leaf, coalesce(l.false_leaf, l.leaf) AS start, l.tree, l.slot AS leaf_slot, s.subroot, s.place, s.height,
         r.hash AS root, r.level AS top
  FROM leaves l JOIN subroots s USING (tree), (SELECT hash, level FROM high WHERE n = 1) r),
steps AS (
  SELECT w.tree, w.leaf_slot, l AS step, (w.leaf_slot >> l) & 1 AS odd, sib.hash AS sibling
  FROM (SELECT *, unnest(range(height)) AS l FROM way) w
  LEFT JOIN low sib ON sib.tree = w.tree AND sib.level = l AND sib.slot = xor(w.leaf_slot >> l, 1)
  UNION ALL
  SELECT w.tree, w.leaf_slot, w.height + l, (w.place >> l) & 1, sib.hash
  FROM (SELECT *, unnest(range(top)) AS l FROM way) w
  LEFT JOIN high sib ON sib.level = l AND sib.slot = xor(w.place >> l, 1)),
folds AS (
  SELECT tree, leaf_slot, 0 AS step, start AS hash FROM way
  UNION ALL
  SELECT f.tree, f.leaf_slot, f.step + 1,
         sha256(CASE WHEN s.sibling IS NULL THEN f.hash WHEN s.odd = 1 THEN s.sibling || f.hash ELSE f.hash || s.sibling END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.leaf_slot = f.leaf_slot AND s.step = f.step),
proofs AS (
  SELECT tree, leaf_slot, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY ALL)
SELECT w.doc_id, w.leaf, w.subroot, w.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.hash AS folded_root, f.hash = w.root AS verified
FROM way w LEFT JOIN proofs p USING (tree, leaf_slot)
JOIN folds f ON f.tree = w.tree AND f.leaf_slot = w.leaf_slot AND f.step = w.height + w.top
"""

SQL["op11_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(w ORDER BY turn NULLS FIRST, k) AS ws,
         {_CRC.format("conv_id")} % 4 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ks[1:c.h], []), c.ks[c.h + 1:]) AS ks,
         list_concat(coalesce(b.ws[1:c.h], []), c.ws[c.h + 1:]) AS ws
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (
  SELECT conv_id, d, ks[1:d] AS path, ws[d] AS w, d = len(ks) AS ends
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM r)),
n AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(w), 0) AS w,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM p GROUP BY path),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)),
below AS (
  SELECT path[1:a] AS path, sum((n_convs - 1) * w)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, below.n_leaves, below.saved_tokens,
       sha256(m.ended) AS ends_sha256
FROM m JOIN below USING (path) LEFT JOIN m up ON m.depth > 0 AND up.path = m.path[1:m.depth - 1]
"""

_SPLIT = "regexp_extract_all(coalesce(" + _FOLDED.format("text") + ", ''), '[^\\x20\\x09-\\x0D]+')"
SQL["op13_minhash_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS grams FROM d),
keys AS (SELECT min(doc_id) AS k, list_sort(grams) AS grams, len(any_value(grams)) AS n FROM s WHERE len(grams) > 0 GROUP BY ALL),
tokens AS (SELECT k, n, unnest(grams) AS g FROM keys),
rare AS (SELECT g, count(*) AS f FROM tokens GROUP BY g),
ranked AS (
  SELECT k, n, g, row_number() OVER (PARTITION BY k ORDER BY f, g) AS place FROM tokens JOIN rare USING (g)),
heads AS (SELECT k, n, g FROM ranked WHERE place <= n - (4 * n + 4) // 5 + 1),
cand AS (SELECT DISTINCT a.k AS a, b.k AS b FROM heads a JOIN heads b USING (g)
         WHERE a.k < b.k AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)),
links AS (
  SELECT a, b FROM (SELECT c.a, c.b, len(list_intersect(x.grams, y.grams)) AS i, x.n + y.n AS t
                    FROM cand c JOIN keys x ON x.k = c.a JOIN keys y ON y.k = c.b)
  WHERE 100 * i >= 80 * (t - i)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT k AS a, k AS b FROM keys UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
comp AS (SELECT a AS k, min(b) AS component_id FROM reach GROUP BY a),
by_doc AS (SELECT s.doc_id, c.component_id FROM s JOIN keys ON keys.grams = list_sort(s.grams) JOIN comp c USING (k))
SELECT s.doc_id, len(s.grams) AS n_shingles, coalesce(b.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(b.component_id, s.doc_id) AS kept
FROM s LEFT JOIN by_doc b USING (doc_id)
"""
