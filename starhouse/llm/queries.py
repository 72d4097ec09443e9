"""The registered queries of the subpackage, each over its whole table, and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm import (
    bpe, chat_format, conversation_trie, decontaminate, language, line_dedup, ngram_join, quality, suffix_dedup, token_counts,
    url_filter, warc, whitening,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: The rules of the query; the operator takes any table of (host, path, action).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: A conversation of control strings that the query formats beside the table's.
PLANTED_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.similar_groups(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.train(docs, ~held_out)
    found = language.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    found = url_filter.judge_urls(_table(spark, folder, "pages"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archive_and_read(_table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), RANKS, PATTERN)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, folder, "documents"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans",
                        F.lower(F.hex("kept")).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"), RANKS, PATTERN,
                                     fields=("source", "lang", "text"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "words_left",
                        F.size("removed_lines").cast("bigint").alias("n_removed_lines"))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(_table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(_table(spark, folder, "conversations"))


def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    planted = spark.createDataFrame(PLANTED_TURNS, "conv_id long, turn long, role string, text string")
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = chat_format.format_conversations(turns.union(planted), RANKS, PATTERN)
    return chat_format.read_back(found).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
        "n_windows", "n_over_budget")


QUERIES = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_language_id, op3_url_filters, op4_warc, op5_byte_bpe,
              op6_decontamination, op7_line_dedup, op8_suffix_array_dedup, op9_token_counts,
              op10_quality_rules, op11_embedding_whitening,
              op12_conversation_trie, op13_chat_formatting)
}

_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[\x20\x09-\x0D]"
_NO_BLANK = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLDED.format('text')}, '{_NO_BLANK}') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END)) AS shingles
  FROM w),
classes AS (
  SELECT min(doc_id) AS head, shingles, len(shingles) AS n FROM s
  WHERE len(shingles) > 0 GROUP BY shingles),
e AS (SELECT head, n, unnest(shingles) AS shingle FROM classes),
p AS (
  SELECT a.head AS a, b.head AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.head < b.head
  GROUP BY ALL),
links AS (SELECT a, b FROM p WHERE 100 * shared >= 75 * (na + nb - shared)),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT head AS doc, head AS other FROM classes
  UNION SELECT r.doc, b.b FROM reach r JOIN pairs b ON r.other = b.a),
component AS (SELECT doc, min(other) AS component_id FROM reach GROUP BY doc)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles,
       coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN classes k ON k.shingles = s.shingles
LEFT JOIN component c ON c.doc = k.head""",
    "op3_url_filters": r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j AS (
  SELECT u.*, h || p AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS place
  FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE place = 1""",
    "op6_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS piece
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
        FROM b WHERE len(words) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS piece
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d)
  CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE i + n - 1 <= len(words)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.piece = bw.piece),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id),
p AS (
  SELECT doc_id, words, words[i] AS term, i
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
f AS (SELECT term, count(*) AS n FROM p GROUP BY term),
bag AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, chr(1)) AS item, list_sort(list_distinct(string_split(piece, ' '))) AS terms
  FROM bw),
rare AS (
  SELECT item, terms, arg_min(term, (coalesce(f.n, 0), term)) AS term
  FROM (SELECT item, terms, unnest(terms) AS term FROM bag) LEFT JOIN f USING (term) GROUP BY ALL),
around AS (
  SELECT DISTINCT doc_id, item, terms, i, words FROM rare JOIN p USING (term)
  WHERE list_has_all(words[greatest(1, i - 14):i + 14], terms)),
near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near
  FROM (SELECT *, unnest(range(greatest(1, i - 14), i + 1)) AS s FROM around)
  WHERE list_has_all(words[s:s + 14], terms) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)""",
    "op7_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
k AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op10_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_NO_BLANK}') AS words FROM documents),
lines AS (
  SELECT doc_id, source, text, line, {_FOLDED.format("regexp_replace(line, '^" + _BLANK + "+|" + _BLANK + "+$', '', 'g')")} AS key,
         len(regexp_extract_all(line, '{_NO_BLANK}')) AS n
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '{_NO_BLANK}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM lines GROUP BY doc_id),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS piece
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (
  SELECT doc_id, count(DISTINCT place) AS n_rep
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, piece) AS times FROM win)
        WHERE times > 1) GROUP BY doc_id),
content AS (
  SELECT doc_id, source, list_sort(list(key || chr(1) || total)) AS body
  FROM (SELECT doc_id, source, key, sum(n) AS total FROM lines GROUP BY ALL) GROUP BY ALL),
body AS (SELECT w.doc_id, w.source, coalesce(c.body, CAST([] AS VARCHAR[])) AS body
         FROM w LEFT JOIN content c USING (doc_id)),
hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM body GROUP BY source),
common AS (
  SELECT lines.source, key FROM lines JOIN body USING (doc_id)
  JOIN hosts ON hosts.source IS NOT DISTINCT FROM lines.source GROUP BY lines.source, key
  HAVING count(DISTINCT doc_id) >= 10 AND count(DISTINCT body) >= 3
     AND count(DISTINCT doc_id) * 100 >= max(docs) * 10),
lost AS (
  SELECT doc_id, sum(n) AS n_lost, count(*) AS n_removed FROM lines JOIN common
  ON common.key = lines.key AND common.source IS NOT DISTINCT FROM lines.source GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words,
         (len(words) - coalesce(n_lost, 0))::BIGINT AS words_left,
         coalesce(n_removed, 0)::BIGINT AS n_removed_lines
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * words_left >= 25 * n_words AS kept, words_left, n_removed_lines
FROM v""",
    "op12_conversation_trie": rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT c, count(*) AS size, c - c % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                 lambda r, _: xor(r >> 1, (r & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM t GROUP BY c),
r AS (
  SELECT c.c, t.place AS depth, role, text FROM c JOIN t ON t.c = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.c, least(c.h, coalesce(b.size, 0)) + t.place - c.h, role, text
  FROM c JOIN t ON t.c = c.c LEFT JOIN c AS b ON b.c = c.base WHERE t.place > c.h),
s AS (
  SELECT c, depth, string_agg(md5(md5(role) || md5(text)), ',') OVER (PARTITION BY c ORDER BY depth) AS prefix,
         len(regexp_extract_all(text, '{_NO_BLANK}')) AS words FROM r
  UNION ALL SELECT c, 0, '', 0 FROM c),
n AS (
  SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words
  FROM s GROUP BY ALL),
p AS (
  SELECT n.*, up.conv_id AS parent, up.prefix AS parent_prefix
  FROM n LEFT JOIN s ON s.c = n.conv_id AND s.depth = n.depth - 1
  LEFT JOIN n AS up ON up.depth = s.depth AND up.prefix = s.prefix),
k AS (SELECT depth - 1 AS depth, parent_prefix AS prefix, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY ALL),
v AS (SELECT p.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved
      FROM p LEFT JOIN k USING (depth, prefix)),
a AS (
  SELECT s.depth, s.prefix, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM v JOIN s ON s.c = v.conv_id AND s.depth <= v.depth GROUP BY ALL),
last AS (SELECT c, max(depth) AS depth FROM s GROUP BY c),
e AS (SELECT depth, prefix, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends FROM s JOIN last USING (c, depth) GROUP BY ALL)
SELECT conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM v JOIN a USING (depth, prefix) LEFT JOIN e USING (depth, prefix)""",
}
