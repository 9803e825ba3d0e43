"""Phase 5: MinHash shingles and signatures of ``documents``."""

from __future__ import annotations

from ..functions.text import WHITESPACE_CLASS
from ..operators import minhash as mh
from ..sources.tables import read_documents
from .registry import register

WORDS = f"""d AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(coalesce(text, 'nan'), '{WHITESPACE_CLASS}+'),
                                                      lambda w: w <> '')) AS words FROM documents)"""
RES = """r AS (SELECT doc_id, list_distinct(list_transform(words, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % 1119)) AS res
      FROM d)"""
SIG = f"""WITH {WORDS}, {RES},
s AS (SELECT doc_id, CASE WHEN len(res) > 0 THEN CAST(list_transform(range(200),
          lambda i: list_min(list_transform(res, lambda x: ((2 * i + 1) * x + 100 * i + 2) % 1119))) AS INTEGER[]) END
          AS signature FROM r)"""


def _docs(spark, sf_dir):
    return read_documents(spark, sf_dir)


@register("shingles", f"WITH {WORDS} SELECT doc_id, unnest(words) AS word FROM d")
def shingles(spark, sf_dir):
    return mh.shingles(_docs(spark, sf_dir))


@register("minhash_signature", f"{SIG} SELECT doc_id, signature FROM s")
def minhash_signature(spark, sf_dir):
    return mh.signatures(_docs(spark, sf_dir))


@register("minhash_long", f"""{SIG}
SELECT doc_id, CAST(generate_subscripts(signature, 1) - 1 AS INTEGER) AS i, unnest(signature) AS minhash FROM s
WHERE signature IS NOT NULL UNION ALL SELECT doc_id, NULL, NULL FROM s WHERE signature IS NULL""")
def minhash_long(spark, sf_dir):
    return mh.signatures_long(_docs(spark, sf_dir))


@register("minhash_review_csv", f"{SIG} SELECT doc_id AS review_id, signature FROM s")
def minhash_review_csv(spark, sf_dir):
    """Signatures of reviews read from a landed header CSV (``Review Text``)."""
    from ..session import work_path
    from ..sources import reviews as rv
    path = rv.land_review_csv(_docs(spark, sf_dir), work_path(spark, "reviews-csv"))
    return mh.signatures(rv.scan_review_csv(spark, path), id_col="review_id")
