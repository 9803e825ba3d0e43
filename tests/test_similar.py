"""Similar documents against all pairs of sets."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.operators import similar
from conftest import SF_MID


def py_signature(text, n=similar.BANDS * similar.ROWS):
    xs = {int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % similar.PRIME for w in ("nan" if text is None else text).split()}
    if not xs:
        return None
    return [min((a * x + 100 * i + 2) % similar.PRIME for x in xs) for i, a in enumerate(similar.multipliers(n))]


def texts_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def jaccard(a, b):
    a, b = set(a.split()), set(b.split())
    return len(a & b) / len(a | b)


def test_signatures_by_hand(spark):
    texts = ["seven grey herons", "a a b", "  ", None, " ".join(f"w{i}" for i in range(10_000)), ""]
    got = {r["doc_id"]: r["signature"] for r in similar.wide_signatures(texts_frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [py_signature(t) for t in texts]


def test_recall_against_all_pairs(spark):
    rng = random.Random(4)
    texts = []
    for g in range(40):
        words = [f"g{g}w{i}" for i in range(100)]
        for _ in range(3):
            w = list(words)
            for _ in range(rng.randrange(12)):
                w[rng.randrange(100)] = f"x{rng.random()}"
            texts.append(" ".join(w))
    true = {(i, j) for i in range(120) for j in range(i + 1, 120) if jaccard(texts[i], texts[j]) >= 0.8}
    docs = texts_frame(spark, texts)
    s = similar.wide_signatures(docs).cache()
    links = similar.band_links(s)
    got = {(r.doc_a, r.doc_b) for r in links.collect()}
    # Links are to the smallest of a bucket: pairs are judged by the classes that links make.
    root = list(range(120))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in sorted(got):
        root[find(b)] = find(a)
    assert sum(find(i) == find(j) for i, j in true) >= 0.98 * len(true) and len(true) > 50
    assert len({(i, j) for i, j in true if (i, j) in got}) >= 0.6 * len(true)
    exact = {(r.doc_a, r.doc_b): r for r in similar.exact_jaccard(links, docs).collect()}
    assert set(exact) == got
    for (a, b), r in exact.items():
        assert r.jaccard == pytest.approx(jaccard(texts[a], texts[b]), abs=1e-15)
    for r in similar.agreement(links, s).collect():
        e = exact[(r.doc_a, r.doc_b)].jaccard
        assert abs(r.estimate - e) < 5 * (e * (1 - e) / 128) ** 0.5 + 1e-9
    s.unpersist()


def test_one_bucket_of_5000_is_linear(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.array([F.lit(7).cast("bigint")] * 128).alias("signature"))
    links = similar.band_links(rows)
    assert links.count() == 4999 and links.filter("doc_a <> 0").count() == 0
    before = similar.band_rows(rows)
    assert before.count() == 5000 * similar.BANDS  # the join's rows: members x bands


def test_documents_without_words_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, " "), (2, ""), (3, None), (4, None), (None, "a b")], "doc_id long, text string")
    links = similar.band_links(similar.wide_signatures(docs))
    assert [tuple(r) for r in links.collect()] == [(3, 4)]
    assert [tuple(r) for r in similar.exact_jaccard(links, docs).collect()] == [(3, 4, 1, 1, 1.0)]
    assert similar.band_links(similar.wide_signatures(docs.limit(0))).collect() == []


def test_long_texts_are_told_apart(spark):
    """Texts that take all values of the short family."""
    a = " ".join(f"a{i}" for i in range(20_000))
    b = " ".join(f"b{i}" for i in range(20_000))
    s = similar.wide_signatures(texts_frame(spark, [a, b])).collect()
    assert sum(x == y for x, y in zip(s[0].signature, s[1].signature)) <= 2


def test_a_real_table_links_only_documents_with_common_words(spark):
    from driftwood.sources.tables import read_documents
    docs = read_documents(spark, SF_MID)
    links = similar.band_links(similar.wide_signatures(docs))
    got = similar.exact_jaccard(links, docs).agg(F.count("*").alias("n"), F.sum((F.col("jaccard") >= 0.8).cast("int")).alias("near")).first()
    assert got.n > 20 and got.near > 20


def test_words_of_linked_documents_are_shuffled_whole(spark):
    """A link moves a document's words as one value, not as a row each; rows under one id count together."""
    docs = spark.createDataFrame([(1, "a b c a"), (2, "b c d"), (2, "c e"), (3, None), (4, "nan\u2003b"), (5, " ")], "doc_id long, text string")
    links = spark.createDataFrame([(1, 2), (1, 4), (2, 3), (3, 4), (1, 5)], "doc_a long, doc_b long")
    out = similar.exact_jaccard(links, docs)
    got = sorted((r.doc_a, r.doc_b, r.n_common, r.n_union) for r in out.collect())
    assert got == [(1, 2, 3, 5), (1, 4, 1, 4), (2, 3, 0, 6), (3, 4, 1, 2)]  # a text without words has no links of its own
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_band_keys_are_the_entries(spark):
    rows = [(1, [5, 6, 7, 8]), (2, [5, 6, 7, 9]), (3, [similar.PRIME - 1] * 4), (4, [5, 6, 8, 7])]
    s = spark.createDataFrame(rows, "doc_id long, signature array<bigint>")
    keys = similar.band_rows(s, 2, 2)
    assert keys.schema["key"].dataType.simpleString() == "struct<k0:bigint>"
    got = sorted((r.band, r.doc_id, r.key.k0) for r in keys.collect())
    assert got == sorted((b, d, v[2 * b] + (v[2 * b + 1] << 31)) for d, v in rows for b in (0, 1))
    assert sorted(tuple(r) for r in similar.band_links(s, 2, 2).collect()) == [(1, 2), (1, 4)]


def band_keys(signature, bands=similar.BANDS, rows=similar.ROWS):
    return {(b, tuple(signature[b * rows:(b + 1) * rows])) for b in range(bands)}


def test_every_pair_of_a_bucket_is_linked_once(spark):
    """Not those with its smallest id alone: 2 and 4 share a band with one another as well; pairs of several bands, and of several blocks."""
    rng = random.Random(8)
    rows = [(1, [5, 6, 7, 8]), (2, [5, 6, 7, 9]), (3, [similar.PRIME - 1] * 4), (4, [5, 6, 8, 7]), (5, None)]
    rows += [(i, [rng.randrange(2) for _ in range(4)]) for i in range(10, 60)]
    rows += [(i, [4, 4, 3, i]) for i in range(1000, 1000 + similar.BLOCK + 100)]
    rows += [(i, [4, 4, 3, i - 50]) for i in range(2000, 2100)]
    links = similar.band_links(spark.createDataFrame(rows, "doc_id long, signature array<bigint>"), 2, 2, every=True)
    got = sorted((r.doc_a, r.doc_b) for r in links.collect())
    keys = [(d, band_keys(s, 2, 2)) for d, s in rows if s]
    assert got == [(a, b) for i, (a, x) in enumerate(keys) for b, y in keys[i + 1:] if x & y]
    assert (2, 4) in got and len(set(got)) == len(got)


def test_links_by_cell_are_verified_as_others(spark):
    """Cells of few links and of many, one of several blocks; a text without words, and one that isn't there, have no links."""
    rng = random.Random(5)
    texts = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 40)))) for i in range(60)] + [(60, "  ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    links = [(a, b, 7, 0, 0) for a in range(30) for b in range(a + 1, 30)] + [(a, b, 9, 0, 1) for a in range(30, 45) for b in range(45, 61)]
    links += [(2 * i, 2 * i + 1, 20 + i, 0, 0) for i in range(15, 30)] + [(3, 999, 50, 0, 0), (1, 2, 51, 0, 0)]
    cells = spark.createDataFrame(links, "doc_a long, doc_b long, bucket long, lo int, hi int")
    got = sorted(tuple(r) for r in similar.exact_jaccard(cells, docs).collect())
    want = sorted(tuple(r) for r in similar.exact_jaccard(cells.select("doc_a", "doc_b").distinct(), docs).collect())
    assert sorted(set(got)) == want
    words = {i: set(t.split()) for i, t in texts}
    pairs = sorted((a, b) for a, b, *_ in links if b != 999 and words[a] and words[b])
    assert [r[:2] for r in got] == pairs
    assert all(r[2:] == (len(words[r[0]] & words[r[1]]), len(words[r[0]] | words[r[1]]), jaccard(texts[r[0]][1], texts[r[1]][1])) for r in got)


@pytest.mark.parametrize("dense", [1, 10_000])
def test_common_words_by_products_and_by_marks(monkeypatch, dense):
    monkeypatch.setattr(similar, "DENSE", dense)
    monkeypatch.setattr(similar, "WIDTH", 7)
    rng = random.Random(dense)
    sets = [sorted(rng.sample(range(50), rng.randrange(1, 30))) for _ in range(12)]
    pairs = [(a, b) for a in range(12) for b in range(a + 1, 12)]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    x, y = np.array(pairs).T
    got = similar._common(x, y, np.arange(len(x)) // 20, np.concatenate(sets), at, 50)
    assert got.tolist() == [len(set(sets[a]) & set(sets[b])) for a, b in pairs]


def verified_by_hand(rows):
    """All pairs of documents of which two rows share a band; rows that share an id count together."""
    of = {}
    for d, t in rows:
        if d is not None and py_signature(t):
            of.setdefault(d, []).append((set(("nan" if t is None else t).split()), band_keys(py_signature(t))))
    out = []
    for a in sorted(of):
        for b in sorted(of):
            if a < b and set().union(*(k for _, k in of[a])) & set().union(*(k for _, k in of[b])):
                common = sum(len(v & w) for v, _ in of[a] for w, _ in of[b])
                union = sum(len(v) for v, _ in of[a]) + sum(len(w) for w, _ in of[b]) - common
                out.append((a, b, common, union, common / union if union else float("inf")))
    return out


def test_jaccard_verified_has_every_pair_of_a_bucket(spark, tmp_path):
    """Edits of one text, none of them linked through the smallest id alone; copies; rows that share an id, with one text and with several;
    rows without an id, a text or words."""
    from driftwood.plans import QUERIES
    rng = random.Random(3)
    rows, words = [], [f"g{i}" for i in range(80)]
    for i in range(40):
        w = list(words)
        for _ in range(rng.randrange(1, 25)):
            w[rng.randrange(80)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, "three grey herons") for i in range(30)] + [(130, "herons  grey three")]
    rows += [(3, rows[3][1]), (4, rows[20][1]), (100, "three grey herons"), (102, "three grey herons wade"), (102, "a b")]
    rows += [(103, "x y z"), (200, "x y z"), (201, None), (202, None), (203, " "), (None, "three grey herons"), (None, None), (-5, rows[7][1])]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["jaccard_verified"](spark, str(tmp_path)).collect())
    want = verified_by_hand(rows)
    assert [r[:4] for r in got] == [r[:4] for r in want] and [r[4] for r in got] == [r[4] for r in want]
    first = {(r.doc_a, r.doc_b) for r in QUERIES["lsh_candidates"](spark, str(tmp_path)).collect()}
    assert first < {r[:2] for r in got}  # the links to the smallest ids, and the others


def test_a_union_of_no_words_is_no_error(spark, tmp_path):
    """Rows that share an id count together: two documents that have one text twice each."""
    from driftwood.plans import ORACLE, QUERIES
    import duckdb
    spark.createDataFrame([(1, "a b"), (1, "b a"), (2, "a b"), (2, "a b"), (3, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["jaccard_verified"](spark, str(tmp_path)).collect())
    assert got == [(1, 2, 8, 0, float("inf")), (1, 3, 4, 2, 2.0), (2, 3, 4, 2, 2.0)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.sql(ORACLE["jaccard_verified"]).fetchall())


def test_jaccard_verified_of_an_empty_table(spark, tmp_path):
    from driftwood.plans import QUERIES
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["jaccard_verified"](spark, str(tmp_path))
    assert out.columns == ["doc_a", "doc_b", "n_common", "n_union", "jaccard"] and out.collect() == []
