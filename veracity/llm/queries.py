"""Registered queries of this subpackage: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the whole of its tables, applies one operator with production parameters and derives
the agreed columns from the operator's output. ``ORACLE`` has DuckDB SQL where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.chat import format_conversations, loss_text, parsed
from veracity.llm.cuckoo import exact_duplicates
from veracity.llm.decontam import benchmark_hits, contaminated, hit_words
from veracity.llm.jaccard import jaccard_groups
from veracity.llm.langid import identify_languages
from veracity.llm.licenses import scan_licenses
from veracity.llm.line_dedup import dedup_lines
from veracity.llm.main_text import extract_main_text
from veracity.llm.negatives import mine_hard_negatives, whole_vectors
from veracity.llm.packing import pack_documents
from veracity.llm.prefix_trie import prefix_trie, turn_sequences
from veracity.llm.token_counts import count_tokens
from veracity.llm.urls import filter_urls
from veracity.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_token_counts")
def op1(spark, sf_dir):
    out = count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


@register("op2_exact_dedup", r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)""")
def op2(spark, sf_dir):
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l),
d AS (SELECT w, min((doc_id, no)) AS first_at FROM w WHERE len(w) > 0 GROUP BY w),
v AS (
  SELECT first_at, i, list_concat(w[1:i - 1], w[i + 1:]) AS rest
  FROM d, unnest(generate_series(1, len(w))) AS t(i) WHERE len(w) >= 5),
near AS (
  SELECT a.first_at FROM v a JOIN v b ON a.rest = b.rest AND a.i = b.i AND b.first_at < a.first_at
  UNION SELECT a.first_at FROM v a JOIN d b ON a.rest = b.w AND len(b.w) >= 5 AND b.first_at < a.first_at
  UNION SELECT b.first_at FROM v a JOIN d b ON a.rest = b.w AND len(b.w) >= 5 AND a.first_at < b.first_at),
k AS (
  SELECT doc_id, no, line, len(w) = 0 OR ((doc_id, no) IN (SELECT first_at FROM d)
         AND (doc_id, no) NOT IN (SELECT first_at FROM near)) AS stays FROM w),
g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays), '') AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN g USING (doc_id)"""


@register("op3_line_dedup", LINES_SQL)
def op3(spark, sf_dir):
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                      n_lines_col="n_lines", n_dropped_col="n_dropped")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def packed(docs: DataFrame, **options) -> DataFrame:
    """Pieces of the packed documents with a digest of their ids in place of the ids."""
    out = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), **options)
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register("op4_sum_of_squares_packing")
def op4(spark, sf_dir):
    return packed(read_table(spark, sf_dir, "documents"))


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
l AS (
  SELECT *, 12 + length(role) + 1 + length(text) + 11
         + CASE WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|')
           THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id"""


@register("op5_chat_formatting", CHAT_SQL)
def op5(spark, sf_dir):
    conflict = "<|im_end|><|im_start|>assistant ok"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", conflict), (-1, 1, "assistant", conflict)], rows.schema)
    out = format_conversations(rows.unionByName(own))
    turns = out.select("*", parsed(F.col("formatted")).alias("turns"), loss_text().alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@register("op6_license_scans")
def op6(spark, sf_dir):
    return scan_licenses(read_table(spark, sf_dir, "documents"))


@register("op7_ngram_jaccard_join")
def op7(spark, sf_dir):
    return jaccard_groups(read_table(spark, sf_dir, "documents"), size=5, pct=80)


@register("op8_language_id")
def op8(spark, sf_dir):
    return identify_languages(read_table(spark, sf_dir, "documents"))


# Host, path and verdict of the rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@register("op9_url_filters")
def op9(spark, sf_dir):
    return filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


@register("op10_benchmark_decontamination")
def op10(spark, sf_dir):
    out = benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      contaminated().alias("contaminated"))


MAIN_TEXT_SQL = r"""
WITH a AS (
  SELECT page_id, url, unnest([0] || generate_series(1, len(x))) AS no, unnest([''] || x) AS block
  FROM (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
                                                   '</?(?:p|h1)[^>]*>') AS x FROM pages)),
t AS (
  SELECT *, trim(regexp_replace(
    replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(block, '<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'),
            '&(quot|#34);', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''), '&#39;', ''''), '[\s\x0B\x85\xA0]+', ' ', 'g')) AS s FROM a),
g AS (SELECT page_id, url, no, regexp_replace(s, '&amp;?', '&', 'g') AS s FROM t)
SELECT page_id, url, coalesce(string_agg(s, chr(10) ORDER BY no) FILTER (s <> ''), '') AS text,
       length(coalesce(string_agg(s, chr(10) ORDER BY no) FILTER (s <> ''), ''))::BIGINT AS n_chars
FROM g GROUP BY page_id, url"""


@register("op11_html_extraction", MAIN_TEXT_SQL)
def op11(spark, sf_dir):
    out = extract_main_text(read_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same,
         list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


@register("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = whole_vectors(rows, "vec_id", label, "embedding", 256.0)
    return mine_hard_negatives(vectors, vectors.where(F.col("id") % 100 == 0))


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (
  SELECT *, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
              lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
              lambda acc, v: CASE WHEN v >= 0 THEN xor(acc, v)
                                  WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) AS crc
  FROM t),
r AS (
  SELECT c.conv_id, coalesce(b.turns, [])[1:h] || c.turns[h + 1:] AS turns
  FROM (SELECT *, xor(crc, 4294967295) % 4 AS h FROM c) c LEFT JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 20),
m AS (SELECT conv_id, len(turns) AS n, unnest(generate_series(0, len(turns))) AS d, turns FROM r),
v AS (
  SELECT d, turns[1:d] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends
  FROM m GROUP BY d, turns[1:d]),
w AS (
  SELECT v.*, p.conv_id AS parent, (SELECT count(*) FROM v k WHERE k.d = v.d + 1 AND k.path[1:v.d] = v.path) AS children,
         CASE WHEN v.d = 0 THEN 0 ELSE (v.n_convs - 1) * len(list_filter(
           regexp_split_to_array(v.path[v.d].t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS cost
  FROM v LEFT JOIN v p ON p.d = v.d - 1 AND p.path = v.path[1:v.d - 1]),
a AS (SELECT cost, children, path, unnest(generate_series(0, d)) AS up FROM w),
s AS (
  SELECT up AS d, path[1:up] AS path, sum(cost)::BIGINT AS saved_tokens, count(*) FILTER (children = 0) AS n_leaves
  FROM a GROUP BY up, path[1:up])
SELECT w.conv_id, w.d::BIGINT AS depth, w.parent AS parent_conv_id, w.n_convs, w.children AS n_children, s.n_leaves,
       s.saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (d, path)"""


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """``turns(conv, tokens)`` with the first crc32(conv) % most tokens taken from the first of its group."""
    heads = turns.where(F.col("conv") % group == 0).select(
        F.col("conv").alias("base"), F.slice("tokens", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    rows = turns.select("conv", "tokens", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    rows = rows.join(heads, "base", "left")
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.slice("tokens", 1, 0))
    return rows.select("conv", F.concat(head, F.slice("tokens", F.col("h") + 1, F.size("tokens"))).alias("tokens"))


@register("op13_conversation_prefix_trie", TRIE_SQL)
def op13(spark, sf_dir):
    turns = rebuilt(turn_sequences(read_table(spark, sf_dir, "conversations")))
    out = prefix_trie(turns, "conv", "tokens")
    return out.select(
        F.col("id").alias("conv_id"), "depth", F.col("parent_id").alias("parent_conv_id"), F.col("n_members").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
