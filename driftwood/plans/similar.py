"""Similar documents: band candidates, signature agreement and exact Jaccard of the links."""

from __future__ import annotations

from ..operators import similar
from ..operators.sizing import materialize, settled
from ..sources.tables import read_documents
from .minhash import WORDS
from .registry import register

N = similar.BANDS * similar.ROWS
A = ", ".join(f"{a}::BIGINT" for a in similar.multipliers(N))
KEYS = f"""{WORDS},
v AS (SELECT doc_id, list_distinct(list_transform(words, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {similar.PRIME})) AS xs FROM d),
f AS (SELECT unnest(range({N})) AS i, unnest([{A}]) AS a),
h AS (SELECT doc_id, i, min((a * x + 100 * i + 2) % {similar.PRIME}) AS m FROM (SELECT doc_id, unnest(xs) AS x FROM v) u, f GROUP BY ALL),
k AS (SELECT doc_id, i // {similar.ROWS} AS band, string_agg(CAST(m AS VARCHAR), ',' ORDER BY i) AS key FROM h GROUP BY ALL)"""
LINKS = f"""{KEYS},
heads AS (SELECT band, key, min(doc_id) AS doc_a FROM k GROUP BY ALL HAVING count(DISTINCT doc_id) > 1),
links AS (SELECT DISTINCT doc_a, doc_id AS doc_b FROM k JOIN heads USING (band, key) WHERE doc_id <> doc_a)"""


def _signatures(spark, sf_dir):
    """Written once: each of the plans below reads them several times."""
    return materialize(similar.wide_signatures(read_documents(spark, sf_dir)), "wide-signatures")


@register("lsh_candidates", f"WITH {LINKS} SELECT doc_a, doc_b FROM links")
def lsh_candidates(spark, sf_dir):
    return similar.band_links(_signatures(spark, sf_dir))


@register("minhash_similarity", f"""
WITH {LINKS},
e AS (SELECT doc_a, doc_b, count(*) FILTER (x.m = y.m) AS n_equal, CAST(count(*) FILTER (x.m = y.m) AS DOUBLE) / {float(N)} AS estimate
      FROM links JOIN h x ON x.doc_id = doc_a JOIN h y ON y.doc_id = doc_b AND y.i = x.i GROUP BY ALL)
SELECT *, sqrt(estimate * (1 - estimate) / {float(N)}) AS standard_error FROM e""")
def minhash_similarity(spark, sf_dir):
    s = _signatures(spark, sf_dir)
    return similar.agreement(similar.band_links(s), s)


@register("jaccard_verified", f"""
WITH {KEYS},
links AS (SELECT DISTINCT x.doc_id AS doc_a, y.doc_id AS doc_b FROM k x JOIN k y ON y.band = x.band AND y.key = x.key AND y.doc_id > x.doc_id),
w AS (SELECT doc_id, unnest(words) AS word FROM d),
n AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1),
c AS (SELECT doc_a, doc_b, count(*) AS n_common FROM links JOIN w x ON x.doc_id = doc_a JOIN w y ON y.doc_id = doc_b AND y.word = x.word GROUP BY ALL)
SELECT doc_a, doc_b, coalesce(n_common, 0) AS n_common, p.n + q.n - coalesce(n_common, 0) AS n_union,
       CAST(coalesce(n_common, 0) AS DOUBLE) / CAST(p.n + q.n - coalesce(n_common, 0) AS DOUBLE) AS jaccard
FROM links LEFT JOIN c USING (doc_a, doc_b) JOIN n p ON p.doc_id = doc_a JOIN n q ON q.doc_id = doc_b""")
def jaccard_verified(spark, sf_dir):
    texts = materialize(similar.text_rows(read_documents(spark, sf_dir)), "word-texts")
    rows = materialize(similar.copies(texts), "copies")
    first = similar.first_texts(texts, rows)  # equal texts are compared once
    links = settled(spark, lambda: similar.band_links(materialize(similar.wide_signatures(first, text_col="words"), "wide-signatures"), every=True), "links")
    return similar.of_documents(similar.exact_jaccard(links, first), links, texts, rows)
