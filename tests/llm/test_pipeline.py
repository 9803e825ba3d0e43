"""The pipeline's stages, each against a plain computation on its own input, and odd rows through all of them."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from driftwood.llm import packing, toxicity
from llm_helpers import SF_SMALL
from test_decontam import brute
from test_pii import plain
from test_probminhash import classes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, sf_dir, tmp):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, out[-1], sf_dir)
        got.write.parquet(f"{tmp}/{name}")
        out.append(spark.read.parquet(f"{tmp}/{name}"))
    return out


def table(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_on_a_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    start, calm, single, clean, masked, packed = stages(spark, docs, SF_SMALL, tmp_path)
    for df in (calm, single, clean, masked):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in docs.schema] and df.columns == COLUMNS
    rows = [table(df) for df in (start, calm, single, clean, masked)]
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    score = model.scorer()
    assert rows[1] == {i: r for i, r in rows[0].items() if score(r.text) < 0.3}
    kept = {first for _, first in classes([(i, r.text) for i, r in sorted(rows[1].items())])}
    assert rows[2] == {i: rows[1][i] for i in kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    hits = brute([(i, r.text) for i, r in rows[2].items()], items)
    assert set(rows[3]) == {i for i, (n, hit, *_) in hits.items() if hit <= 0.5 * n}
    assert all(rows[3][i] == rows[2][i] for i in rows[3] if not hits[i][1])
    assert not any(h[4] for h in brute([(i, r.text) for i, r in rows[3].items()], items).values())
    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        assert r == rows[3][i] if not plain(rows[3][i].text) else not plain(r.text) and r.n_chars == len(r.text)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    lengths = {}
    for r in packed.collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows[4].items()}


def test_run_gives_the_stages_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = stages(spark, docs, SF_SMALL, tmp_path)[-1].select("doc_id", "piece", "length", "ids_crc32").collect()
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(want)


def test_odd_rows_and_empty_table(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words without an id", "en", None, 24), (3, "twice", "en", "s", 5),
            (3, "twice", "en", "s", 5), (4, "long " * 100_000, "en", "s", 500_000)]
    out = stages(spark, spark.createDataFrame(rows, schema), SF_SMALL, tmp_path / "a")
    assert sorted(map(str, (r.doc_id for r in out[4].collect()))) == ["1", "3", "4", "None"]
    ids = np.zeros(1, dtype="<u4")
    assert {(r.doc_id, r.length, r.ids_crc32) for r in out[5].collect() if r.doc_id == 1} == {(1, 1, zlib.crc32(ids.tobytes()))}
    empty = stages(spark, spark.createDataFrame([], schema), SF_SMALL, tmp_path / "b")
    assert [df.count() for df in empty] == [0] * 6
