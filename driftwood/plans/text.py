"""Phase 4: lexicon, Bloom filter and word gates over ``documents`` lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bloom, gates
from ..session import work_path
from ..sources import documents as docs
from ..sources import lexicon as lx
from ..sources.tables import read_documents, read_table
from .registry import register

M, K, K15 = 2000, 5, 15

# DuckDB fragments ---------------------------------------------------------------------
LEX = """lex AS (SELECT DISTINCT w AS word, CAST((length(w) % 11) - 5 AS INTEGER) AS valence
              FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark))"""
BAD = "bad AS (SELECT word FROM lex WHERE valence <= -4)"


def BITS(m=M, k=K):
    return f"""bits AS (SELECT DISTINCT CAST((('0x' || md5(word || CAST(i AS VARCHAR)))::UHUGEINT % {m}) AS INTEGER) AS pos
               FROM bad, range({k}) t(i))"""


LINES = """lines AS (SELECT doc_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS line_no, unnest(a) AS line
                FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))"""
TOKENS = """tokens AS (SELECT doc_id, line_no, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS word
                 FROM (SELECT doc_id, line_no, string_split(line, ' ') AS t FROM lines))"""


def PROBE(m=M, k=K, src="tokens"):
    return f"""probe AS (SELECT d.word, bool_and(b.pos IS NOT NULL) AS in_filter
       FROM (SELECT DISTINCT word FROM {src}) d, range({k}) t(i)
       LEFT JOIN bits b ON b.pos = CAST((('0x' || md5(d.word || CAST(t.i AS VARCHAR)))::UHUGEINT % {m}) AS INTEGER)
       GROUP BY d.word)"""


def BUILD_SQL(m, k):
    return f"""WITH {LEX}, {BAD}, {BITS(m, k)},
pb AS (SELECT pos // 8 AS b, sum(1 << (7 - pos % 8)) AS v FROM bits GROUP BY 1),
full_bytes AS (SELECT r.range AS b, coalesce(pb.v, 0) AS v FROM range({(m + 7) // 8}) r LEFT JOIN pb ON pb.b = r.range)
SELECT CAST({m} AS INTEGER) AS m, CAST({k} AS INTEGER) AS k, (SELECT count(*) FROM bad) AS n_words,
       (SELECT count(*) FROM bits) AS bits_set,
       (SELECT base64(unhex(string_agg(printf('%02x', v), '' ORDER BY b))) FROM full_bytes) AS bits_b64"""


def _lines(spark, sf_dir):
    return docs.document_lines(read_documents(spark, sf_dir))


def _tokens(spark, sf_dir):
    return docs.line_tokens(_lines(spark, sf_dir))


def _lexicon(spark, sf_dir):
    return lx.lexicon_from_texts(read_table(spark, sf_dir, "benchmark"))


def _bad(spark, sf_dir):
    return lx.bad_words(_lexicon(spark, sf_dir))


def _bits(spark, sf_dir, m=M, k=K):
    """Build -> save -> reload -> decode: probes read the persisted artifact."""
    path = bloom.save(bloom.build(_bad(spark, sf_dir), m, k), work_path(spark, "bloom"))
    return bloom.set_bits(bloom.reload(spark, path))


@register("first_token", f"""
WITH {LINES} SELECT doc_id, line_no, string_split(line, ' ')[1] AS words FROM lines""")
def first_token(spark, sf_dir):
    return docs.first_token(_lines(spark, sf_dir))


@register("tokenize_explode", f"WITH {LINES}, {TOKENS} SELECT * FROM tokens")
def tokenize_explode(spark, sf_dir):
    return _tokens(spark, sf_dir)


@register("lexicon_scan", f"WITH {LEX} SELECT word, valence FROM lex WHERE NOT regexp_matches(word, '[\\n\\r]')")
def lexicon_scan(spark, sf_dir):
    path = lx.land_lexicon_tsv(lx.plain_words(_lexicon(spark, sf_dir)), work_path(spark, "lexicon-tsv"))
    return lx.scan_lexicon(spark, path)


@register("lexicon_bad_words", f"WITH {LEX}, {BAD} SELECT word FROM bad")
def lexicon_bad_words(spark, sf_dir):
    return _bad(spark, sf_dir)


@register("exact_semi", f"""
WITH {LEX}, {BAD}, {LINES}, {TOKENS} SELECT * FROM tokens WHERE word IN (SELECT word FROM bad)""")
def exact_semi(spark, sf_dir):
    return gates.exact_semi(_tokens(spark, sf_dir), _bad(spark, sf_dir))


@register("exact_anti", f"""
WITH {LEX}, {BAD}, {LINES}, {TOKENS} SELECT * FROM tokens WHERE word NOT IN (SELECT word FROM bad)""")
def exact_anti(spark, sf_dir):
    return gates.exact_anti(_tokens(spark, sf_dir), _bad(spark, sf_dir))


@register("bloom_positions", f"""
WITH {LEX}, {BAD} SELECT word, CAST(i AS INTEGER) AS i,
  CAST((('0x' || md5(word || CAST(i AS VARCHAR)))::UHUGEINT % {M}) AS INTEGER) AS pos FROM bad, range({K}) t(i)""")
def bloom_positions(spark, sf_dir):
    return bloom.positions(_bad(spark, sf_dir), M, K)


@register("bloom_build", BUILD_SQL(M, K))
def bloom_build(spark, sf_dir):
    return bloom.build(_bad(spark, sf_dir), M, K)


@register("bloom_build_k15", BUILD_SQL(M, K15))
def bloom_build_k15(spark, sf_dir):
    return bloom.build(_bad(spark, sf_dir), M, K15)


@register("bloom_save", BUILD_SQL(M, K))
def bloom_save(spark, sf_dir):
    """Build, persist, and read the artifact back (parameters travel with the bits)."""
    path = bloom.save(bloom.build(_bad(spark, sf_dir), M, K), work_path(spark, "bloom"))
    return bloom.reload(spark, path)


@register("bloom_merge", f"SELECT m, k, bits_set, bits_b64 FROM ({BUILD_SQL(M, K)})")
def bloom_merge(spark, sf_dir):
    """Half of the listed words in a saved filter, the other half OR-ed into it: equal to a rebuild, bit for bit."""
    bad, half = _bad(spark, sf_dir), F.pmod(F.xxhash64("word"), F.lit(2))
    path = work_path(spark, "bloom-bitmaps")
    bloom.build_bitmaps(bad.filter(half == 0), M, K).write.parquet(path)
    merged = bloom.merge_bitmaps(spark.read.parquet(path), bloom.build_bitmaps(bad.filter(half == 1), M, K))
    return bloom.pack(bloom.bitmap_positions(merged), M, K, F.lit(None).cast("bigint")).select("m", "k", "bits_set", "bits_b64")


@register("bloom_reload_text", f"WITH {LEX}, {BAD}, {BITS()} SELECT pos FROM bits")
def bloom_reload_text(spark, sf_dir):
    """Set-bit positions of a text artifact that stores the Base64 line only."""
    path = bloom.save_text(bloom.build(_bad(spark, sf_dir), M, K), work_path(spark, "bloom-text"))
    return bloom.set_bits(bloom.reload_text(spark, path, M, K))


@register("bloom_reload", f"WITH {LEX}, {BAD}, {BITS()} SELECT pos FROM bits")
def bloom_reload(spark, sf_dir):
    """Set-bit positions decoded from the saved Base64 artifact."""
    path = bloom.save(bloom.build(_bad(spark, sf_dir), M, K), work_path(spark, "bloom"))
    return bloom.set_bits(bloom.reload(spark, path))


@register("bloom_probe", f"WITH {LEX}, {BAD}, {BITS()}, {LINES}, {TOKENS}, {PROBE()} SELECT word, in_filter FROM probe")
def bloom_probe(spark, sf_dir):
    return bloom.probe(_tokens(spark, sf_dir), _bits(spark, sf_dir), M, K)


@register("bloom_verdict", f"""
WITH {LEX}, {BAD}, {BITS()}, {LINES}, {TOKENS}, {PROBE()}
SELECT t.doc_id, t.line_no, t.pos, t.word, CASE WHEN p.in_filter THEN 'BAD' ELSE 'GOOD' END AS verdict
FROM tokens t JOIN probe p ON p.word = t.word""")
def bloom_verdict(spark, sf_dir):
    return bloom.verdict(_tokens(spark, sf_dir), _bits(spark, sf_dir), M, K)


@register("bloom_fp_audit", f"""
WITH {LEX}, {BAD}, {BITS()}, {LINES}, {TOKENS}, {PROBE()},
j AS (SELECT p.word, p.in_filter, (b.word IS NOT NULL) AS listed FROM probe p LEFT JOIN bad b ON b.word = p.word)
SELECT count(*) AS n_words, sum(CAST(in_filter AS BIGINT)) AS n_positive, sum(CAST(listed AS BIGINT)) AS n_listed,
       sum(CAST(in_filter AND NOT listed AS BIGINT)) AS false_positives,
       sum(CAST(listed AND NOT in_filter AS BIGINT)) AS false_negatives,
       CAST(sum(CAST(in_filter AND NOT listed AS BIGINT)) AS DOUBLE) / CAST(count(*) - sum(CAST(listed AS BIGINT)) AS DOUBLE)
         AS fp_rate FROM j""")
def bloom_fp_audit(spark, sf_dir):
    return bloom.fp_audit(_tokens(spark, sf_dir), _bits(spark, sf_dir), _bad(spark, sf_dir), M, K)


@register("sentence_gate", f"""
WITH {LEX}, {BAD}, {BITS()}, {LINES}, {TOKENS}, {PROBE()},
badl AS (SELECT DISTINCT t.doc_id, t.line_no FROM tokens t JOIN probe p ON p.word = t.word WHERE p.in_filter)
SELECT l.* FROM lines l WHERE NOT EXISTS (SELECT 1 FROM badl b WHERE b.doc_id = l.doc_id AND b.line_no = l.line_no)""")
def sentence_gate(spark, sf_dir):
    return gates.sentence_gate(_lines(spark, sf_dir), _bits(spark, sf_dir), M, K)


@register("batch_gate", f"""
WITH {LEX}, {BAD}, {BITS(M, K15)}, {LINES}, {TOKENS}, {PROBE(M, K15)},
badb AS (SELECT DISTINCT t.doc_id AS batch_id FROM tokens t JOIN probe p ON p.word = t.word WHERE p.in_filter)
SELECT doc_id AS batch_id, doc_id, line_no, line FROM lines WHERE doc_id NOT IN (SELECT batch_id FROM badb)""")
def batch_gate(spark, sf_dir):
    """k = 15 (the batch-suppressing variant); one document = one micro-batch."""
    return gates.batch_gate(_lines(spark, sf_dir), _bits(spark, sf_dir, M, K15), "doc_id", M, K15)
