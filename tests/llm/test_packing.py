"""Packing: ids against the tokenizer itself, gapless sequences, few of them."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from driftwood.llm import packing
from driftwood.llm.queries import op10_packing
from llm_helpers import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(packing.tokenizer_path())
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in sorted(by_doc[doc], key=lambda r: r.piece)]
        assert got == [(k, s, len(ids[s:s + size]), zlib.crc32(ids[s:s + size].tobytes())) for k, s in enumerate(range(0, len(ids), size))]
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence), math.ceil(sum(r.length for r in rows) / size)


def test_queries_on_tables(spark, tokenizer):
    for sf in (SF_SMALL, SF_MID):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        used, least = check(op10_packing(spark, sf).collect(), texts, tokenizer, packing.SIZE)
        assert used <= least * 1.01 + 1


def test_odd_texts(spark, tokenizer, rng):
    bits = ["don't", "I'LL", "x²", "½", "é", "é", "́", "İ", "ΣΑΣ", "ß", "日本語", "😀", "a.b", "--", "12", "\t", "\n", "  ", " ", " ", "\x1c", " ",
            "<|endoftext|>", "<|startoftext|>x", "…", "_", "Word,", "The", "'s", "s'", "\r\n", "ÀÉ", "×"]
    texts = {i: "".join(rng.choice(bits) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(60))) for i in range(200)}
    texts |= {900: None, 901: "", 902: " ", 903: "word " * 20_000, 904: "x" * 50_000}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id bigint, text string, offset int")
    check(packing.pack_documents(df).collect(), texts, tokenizer, packing.SIZE)
    check(packing.pack_documents(df, size=16).collect(), texts, tokenizer, 16)


def test_repeated_rows_nulls_and_no_rows(spark):
    schema = "doc_id bigint, text string"
    rows = packing.pack_documents(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (None, None)], schema), size=8).collect()
    assert sorted(r.length for r in rows) == [1, 3, 3, 3]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack_documents(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 64, 512, 2048])
def test_plan_uses_every_piece_once(rng, size):
    for shape in (lambda: rng.randrange(1, size + 1), lambda: max(1, min(size, int(rng.lognormvariate(math.log(size / 4 + 1), 0.8)))), lambda: size):
        h = defaultdict(int)
        for _ in range(3000):
            h[shape()] += 1
        plan = packing.plan_packing(dict(h), size)
        used = defaultdict(int)
        for lengths, times in plan:
            assert 0 < sum(lengths) <= size and times > 0
            for n in lengths:
                used[n] += times
        assert used == h
        least = math.ceil(sum(n * c for n, c in h.items()) / size)
        big = sum(c for n, c in h.items() if 2 * n > size)
        assert sum(t for _, t in plan) <= max(least, big) * 1.03 + 2
    assert packing.plan_packing({}, size) == []


def test_fitted_counts_are_non_negative_and_close():
    counts = np.zeros(65)
    counts[[40, 24, 32, 16]] = (100, 100, 50, 0)
    pats = packing.patterns(np.array([16, 24, 32, 40]), 64)
    x = packing.fit_counts(pats, counts, 64, steps=2000)
    made = np.bincount(pats.ravel(), np.repeat(x, 3), 65)
    assert (x >= 0).all() and np.abs(made - counts)[1:].max() < 3
