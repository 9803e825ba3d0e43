"""Toxicity: held-out accuracy on the tables, the model's parts, odd inputs."""

import numpy as np
import pytest

from driftwood.llm import toxicity
from driftwood.llm.queries import op7_toxicity
from llm_helpers import SF_MID, by_id

SF_LARGE = "/root/testdata/sf0.1"


def quality(spark, sf):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    # At this size only English toxic texts differ from ordinary ones.
    english = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id").collect()}
    rows = [r for r in op7_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels and r.doc_id in english]
    y, p = np.array([labels[r.doc_id] for r in rows]), np.array([r.predicted for r in rows])
    s = np.array([r.score for r in rows])
    rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    return p[y == 1].mean(), p[y == 0].mean(), auc


def test_held_out_accuracy(spark):
    recall, false, auc = quality(spark, SF_LARGE)
    assert recall >= 0.85 and false <= 0.01 and auc >= 0.88, (recall, false, auc)


def test_query_rows(spark):
    import zlib
    ids = [r.doc_id for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id").collect()]
    got = by_id(op7_toxicity(spark, SF_MID))
    assert sorted(got) == sorted(ids)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


@pytest.fixture(scope="module")
def model():
    import random
    rng = random.Random(3)
    plain = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "paper"]
    texts = [" ".join(rng.choices(plain, k=80) + rng.choices(["vilewordish", "nastything"], k=4 * (i % 4 == 0)) + rng.choices(plain, k=40)) for i in range(160)]
    return toxicity.fit_texts(texts, [int(i % 4 == 0) for i in range(160)])


def test_model_separates_and_handles_odd_texts(model):
    score = model.scorer()
    assert score("river stone " * 30 + "nastything cloud") > 0.5 > 0.2 > score("river stone " * 30)
    assert score("") == pytest.approx(score(" \n")) and score("") < 0.3
    assert score("river " * 200_000 + "vilewordish nastything vilewordish " + "stone " * 200_000) > score("river " * 400_000)
    assert b"nastything"[:8] in model.toxic and b"nasty" not in model.ordinary


def test_rows_nulls_and_extra_columns(spark, model):
    df = spark.createDataFrame([(1, None, 5.0), (1, "", 5.0), (None, "nastything vilewordish river", 1.0), (2, "river", 2.0), (2, "river", 2.0)],
                               "doc_id bigint, text string, score double")
    got = toxicity.score_toxicity(df, model).collect()
    assert len(got) == 5 and got[0].score == got[1].score
    kept = toxicity.drop_toxic(df, model)
    assert kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in df.collect() if r.doc_id is not None]))
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


def test_labels_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(i, 0) for i in range(20)] + [(None, 1), (3, None), (99, None)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, one)).collect()} == {0.0}


def test_toxic_words_late_in_a_text_without_blanks(rng):
    ordinary = "".join(f" word{i}" for i in range(300)).encode()
    toxic = b"vilestinsult nastyabuse filthyslur"
    distance = toxicity.Distance(toxic, ordinary)
    plain = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß漢", k=100_000))
    hit = "vilestinsultnastyabusefilthyslur"
    none = distance.features(plain)[0]
    for at in (0, 20_000, 40_000, 99_990):
        assert distance.features(plain[:at] + hit + plain[at:])[0] >= none + 8, at
    parts = toxicity.pieces(plain.encode())
    assert max(map(len, parts)) <= toxicity.WINDOW_BYTES and all(p.decode() for p in parts)
