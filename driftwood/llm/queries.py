"""One query per operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontam, licenses, packing, pieces, pii, probminhash, repeats, secrets, toxicity, trie, whitening
from .common import read_table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_secrets")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return secrets.secret_digests(secrets.find_secrets(read_table(spark, sf_dir, "documents")))


CHAT_PROBE = "\\### Assistant: </turn> ok"  # the two turns of conversation -7


@query("op5_chat", """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(role, '~', '~0'), '<|', '<~1') AS r, replace(replace(text, '~', '~0'), '<|', '<~1') AS t,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(t) + CASE WHEN role IS NOT DISTINCT FROM before THEN 8 ELSE 8 + length(r) + 8 + 8 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and the probe conversation -7, formatted and read back."""
    convs = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).selectExpr("CAST(-7 AS BIGINT) AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role").withColumn(
        "text", chat.F.lit(CHAT_PROBE))
    return chat.chat_digests(chat.format_chat(convs.unionByName(probe)))


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    return pii.pii_digests(pii.find_pii(read_table(spark, sf_dir, "documents")))


# Windows as joined words.
LEAK_SQL = r"""
WITH item_words AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, item_id, w, least(10, len(w)) AS n FROM item_words WHERE len(w) > 0),
doc_words AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
runs AS (
  SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words CROSS JOIN (SELECT DISTINCT n FROM sized))),
found AS (SELECT r.row, r.i, r.n, w.item_id FROM runs r JOIN windows w ON w.n = r.n AND w.run = r.run),
hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS place FROM found) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row),
-- The longest match: pairs of words on one diagonal, in stretches of pairs that are long enough for a window.
item_pairs AS (SELECT item, j, w[j] || ' ' || w[j + 1] AS pair FROM (SELECT item, w, unnest(range(1, len(w))) AS j FROM sized)),
doc_pairs AS (SELECT row, i, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT row, w, unnest(range(1, len(w))) AS i FROM doc_words)),
both_have AS (SELECT row, i, item, j FROM doc_pairs JOIN item_pairs USING (pair)),
stretches AS (
  SELECT row, min(i) AS a, count(*) + 1 AS size
  FROM (SELECT row, i, i - row_number() OVER (PARTITION BY row ORDER BY i) AS run FROM (SELECT DISTINCT row, i FROM both_have)) GROUP BY row, run),
matches AS (
  SELECT row, min(i) AS a, count(*) + 1 AS size
  FROM (SELECT row, item, i, i - j AS diagonal, i - row_number() OVER (PARTITION BY row, item, i - j ORDER BY i) AS run FROM both_have) GROUP BY row, item, diagonal, run),
shortest AS (SELECT min(n) AS n FROM sized),
streamed AS (
  SELECT m.row, m.size FROM matches m JOIN stretches s ON s.row = m.row AND m.a >= s.a AND m.a < s.a + s.size CROSS JOIN shortest WHERE s.size >= shortest.n
  UNION ALL
  SELECT row, 1 FROM (SELECT row, unnest(w) AS word FROM doc_words CROSS JOIN shortest WHERE n = 1) JOIN (SELECT DISTINCT unnest(w) AS word FROM sized) USING (word)),
longest AS (SELECT row, max(size) AS longest FROM streamed GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM doc_words LEFT JOIN hit USING (row) LEFT JOIN named USING (row) LEFT JOIN longest USING (row)
"""


@query("op9_decontam", LEAK_SQL)
def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of ``benchmark`` in every whole text of ``documents``."""
    found = decontam.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return decontam.leak_digests(found)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learnt from the labels that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op4_licenses", licenses.duckdb_sql())
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences and licence notices in every whole text of ``documents``."""
    return licenses.find_licenses(read_table(spark, sf_dir, "documents"))


@query("op2_ann")
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all ``embeddings`` for every row whose id is divisible by 20."""
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbors(rows, rows.where("vec_id % 20 = 0"), k=20)


@query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every row of ``documents``."""
    return probminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


# Bytes as hex digits; strings at all places by their digests, from parts of 1,000 places.
REPEAT_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT row, c, substr(h, 2 * c + 1, 2398) AS part FROM (SELECT row, h, unnest(range(0, length(h) // 2 - 199, 1000)) AS c FROM d)),
starts AS (SELECT row, c + k AS i, md5(substr(part, 2 * k + 1, 400)) AS key FROM (SELECT row, c, part, unnest(range(length(part) // 2 - 199)) AS k FROM parts)),
again AS (SELECT row, i FROM starts JOIN (SELECT key FROM starts GROUP BY key HAVING count(*) > 1) USING (key)),
cut AS (SELECT row, i, i - lag(i) OVER (PARTITION BY row ORDER BY i) <= 200 AS joined FROM again),
runs AS (
  SELECT row, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT row, i, count(*) FILTER (joined IS NOT TRUE) OVER (PARTITION BY row ORDER BY i) AS run FROM cut) GROUP BY row, run),
kept AS (
  SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM (SELECT row, a, b, h, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS before FROM runs JOIN d USING (row)) GROUP BY row)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""


@query("op8_repeats", REPEAT_SQL)
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of ``documents`` without repeated 200-byte strings."""
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable ``embeddings`` projected on their covariance's eight leading eigenvectors."""
    rows = read_table(spark, sf_dir, "embeddings")
    return whitening.component_rows(whitening.whiten(rows, whitening.fit_whitening(rows)))


# crc32 of a text of digits, with a table from the polynomial; conversations are rebuilt and keyed by the digests of their prefixes.
TRIE_SQL = """
WITH RECURSIVE table8(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM table8 WHERE k < 8),
crc_table AS (SELECT i, v FROM table8 WHERE k = 8),
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM numbered),
crc(conv_id, s, place, c) AS (
  SELECT conv_id, s, 1, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT c.conv_id, c.s, c.place + 1, xor(t.v, c.c // 256)
  FROM crc c JOIN crc_table t ON t.i = xor(c.c % 256, CAST(ascii(substr(c.s, c.place, 1)) AS BIGINT)) WHERE c.place <= length(c.s)),
convs AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE place = length(s) + 1),
turns AS (
  SELECT n.conv_id, n.pos, role, text FROM numbered n JOIN convs USING (conv_id) WHERE pos > h
  UNION ALL
  SELECT c.conv_id, n.pos, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 WHERE n.pos <= c.h),
ranked AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, md5(length(role) || ':' || role || text) AS t, strlen(text) AS bytes FROM turns),
chained AS (SELECT conv_id, depth, bytes, list(t) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM ranked),
prefixes AS (
  SELECT conv_id, CAST(depth AS BIGINT) AS depth, bytes, md5(array_to_string(path, '')) AS key,
         CASE WHEN depth = 1 THEN 'root' ELSE md5(array_to_string(path[1:depth - 1], '')) END AS parent FROM chained
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM convs),
nodes AS (SELECT key, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n FROM prefixes GROUP BY key),
kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes GROUP BY parent),
-- a node's ancestors and itself are the prefixes of its smallest member up to its depth
below AS (
  SELECT p.key, count(*) FILTER (k.key IS NULL) AS n_leaves, sum((n.n - 1) * n.bytes) AS saved
  FROM nodes n LEFT JOIN kids k ON k.key = n.key JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.key),
ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, key FROM prefixes QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY key)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n JOIN below b ON b.key = n.key LEFT JOIN kids k ON k.key = n.key LEFT JOIN nodes up ON up.key = n.parent LEFT JOIN ends e ON e.key = n.key
"""


@query("op12_trie", TRIE_SQL)
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt ``conversations``."""
    return trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


@query("op13_pieces")
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as pieces, and what they decode to."""
    return pieces.piece_digests(pieces.round_trip(read_table(spark, sf_dir, "documents")))
