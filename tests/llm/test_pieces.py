"""Pieces against the sentencepiece library, id by id."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from driftwood.llm import pieces
from driftwood.llm.queries import op13_pieces
from llm_helpers import SF_SMALL, by_id

SCHEMA = "doc_id bigint, text string, ids string, packed string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.piece_path())


def agree(library, texts):
    encoder, decoder = pieces.Encoder(pieces.piece_path()), pieces.Decoder(pieces.piece_path())
    got = [np.frombuffer(raw, dtype="<u4").tolist() for raw in encoder.encode(texts)]
    for text, ids, want in zip(texts, got, library.encode(texts, add_bos=True, add_eos=True)):
        assert ids == want, text[:200]
        assert decoder.decode(ids) == library.decode(want), text[:200]


def test_blanks_bytes_and_control_strings(library):
    agree(library, ["", " ", "   ", "a", "  two  blanks ", "line\nend\r\n\ttab", "▁sign ▁▁x", "<s></s><unk><0x41>", "\x00\x01", "1234567890", "é́ 日本語 😀 \U0010ffff",
                    "-" * 100, "!” «x», .’ …]", "word" * 60])


def test_long_words_and_texts(library):
    rng = random.Random(1)
    agree(library, ["a" * 30_000, " " * 5_001, "日本語中文" * 3_000, "=-" * 4_000, "the cat " * 60_000, "".join(rng.choice("abcdething") for _ in range(50_000)),
                    "x" * (pieces.LONG + 1) + " " + "th" * pieces.LONG])


def test_random_texts(library):
    rng = random.Random(2)
    names = pieces.Vocabulary(pieces.piece_path()).names
    agree(library, ["".join(rng.choice("ab cde  \n\t1.,-(é日本😀▁́ñthe") for _ in range(rng.randrange(80))) for _ in range(2000)]
          + ["".join(rng.choice(names) for _ in range(rng.randrange(30))) for _ in range(2000)]
          + ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1F9FF)])) for _ in range(200)) for _ in range(100)])


def test_decoding_of_any_ids(library):
    rng = random.Random(3)
    decoder = pieces.Decoder(pieces.piece_path())
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(1, 3), rng.randrange(3, 259), rng.randrange(259, 280), rng.randrange(259, 32000)]) for _ in range(rng.randrange(12))]
        # The library takes the blank off a first piece; bytes before it are not a first piece here.
        ids = [400] + ids
        assert decoder.decode(ids) == library.decode(ids), ids


def test_a_full_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 50)
    rng = random.Random(4)
    agree(library, [" ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(40)) for _ in range(50)])


def test_tables_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None, "i", "p"), (1, "", "i", "p"), (None, "x y", "i", "p"), (2, "x y", "i", "p"), (2, "x y", "i", "p")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.doc_id), r.ids) for r in pieces.encode(df).collect())
    xy = library.encode("x y", add_bos=True, add_eos=True)
    assert got == [("1", [1, 2]), ("1", [1, 2]), ("2", xy), ("2", xy), ("None", xy)]
    assert sorted(r.text for r in pieces.decode(pieces.encode(df)).collect()) == ["", "", "x y", "x y", "x y"]
    assert pieces.encode(df, ends=False).where("doc_id = 2").first().ids == xy[1:-1]
    odd = spark.createDataFrame([(1, None), (2, [1, None, 400])], "doc_id int, ids array<int>")
    assert [r.text for r in pieces.decode(odd).orderBy("doc_id").collect()] == ["", library.decode([400])]
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces.encode(empty).collect() == [] == pieces.decode(pieces.encode(empty)).collect()


def test_query(spark, library):
    docs = by_id(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = by_id(op13_pieces(spark, SF_SMALL))
    assert set(got) == set(docs)
    for i, d in docs.items():
        ids = library.encode(d.text, add_bos=True, add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
