"""MinHash: brute force, invariances, relational twin."""

import hashlib

from pyspark.sql import functions as F

from driftwood.operators import minhash as mh
from driftwood.sources.tables import read_table
from conftest import SF_SMALL


def py_signature(text, n=200, m=1119):
    words = set(("nan" if text is None else text).split())
    if not words:
        return None
    xs = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in words]
    return [min(((2 * i + 1) * x + 100 * i + 2) % m for x in xs) for i in range(n)]


def test_bruteforce_on_hand_texts(spark):
    texts = ["seven grey herons stand in the shallow water", "a a a b", "  ", None, "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["signature"] for r in mh.signatures(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_signature(t), t
    assert got[2] is None          # whitespace only
    assert got[3] == py_signature("nan")


def test_order_and_repetition_invariance(spark):
    df = spark.createDataFrame([(0, "b a c"), (1, "c c a b a")], "doc_id long, text string")
    s = [r["signature"] for r in mh.signatures(df).orderBy("doc_id").collect()]
    assert s[0] == s[1]


def test_vectorized_equals_relational_on_documents(spark):
    d = read_table(spark, SF_SMALL, "documents")
    a = {r["doc_id"]: r["signature"] for r in mh.signatures(d).collect()}
    b = {r["doc_id"]: r["signature"] for r in mh.signatures_relational(d).collect()}
    assert a == b and len(a) == d.count()
    sample = d.orderBy("doc_id").limit(5).collect()
    for r in sample:
        assert a[r["doc_id"]] == py_signature(r["text"])


def test_long_report_keeps_texts_without_words(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "  ")], "doc_id long, text string")
    got = mh.signatures_long(df).collect()
    assert {r["doc_id"] for r in got} == {1, 2} and [(r["i"], r["minhash"]) for r in got if r["doc_id"] == 2] == [(None, None)]
