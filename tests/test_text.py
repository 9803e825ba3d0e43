"""Tokenizers, lexicon round trip, gates."""

import pytest
from pyspark.sql import functions as F

from driftwood.functions.text import single_space_tokens, whitespace_tokens
from driftwood.operators import bloom, gates
from driftwood.session import work_path
from driftwood.sources import documents as docs
from driftwood.sources import lexicon as lx
from driftwood.sources.tables import read_table
from conftest import SF_SMALL, rows


def test_single_space_tokens_keep_empties(spark):
    df = spark.createDataFrame([("a  b",), ("",)], "t string")
    got = [r["x"] for r in df.select(single_space_tokens(F.col("t")).alias("x")).collect()]
    assert got == [["a", "", "b"], [""]]


def test_whitespace_tokens_match_python_split(spark):
    texts = ["a b\tc\nd", "  lead and trail  ", "nbsp\xa0sep　ideo", "x\x1cy\x85z", "", "   ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["x"] for r in df.select(whitespace_tokens(F.col("t")).alias("x")).collect()]
    assert got == [("nan" if t is None else t).split() for t in texts]


def test_lexicon_tsv_round_trip(spark):
    lex = lx.lexicon_from_texts(read_table(spark, SF_SMALL, "benchmark"))
    plain = lx.plain_words(lex)
    path = lx.land_lexicon_tsv(plain, work_path(spark, "t-lex"))
    assert rows(lx.scan_lexicon(spark, path)) == rows(plain) and lx.lexicon_rejects(spark, path).count() == 0
    assert 0 < lex.count() - plain.count() < plain.count()


def test_lexicon_file_of_another_writer(spark):
    lines = ["word\t-5", "\t3", '"quoted\t1', "\ttabbed\t2", " blank \t4", "\x0bq\t-4", "no tab", "bad\tx", ""]
    path = work_path(spark, "t-lex2")
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    got = {(r.word, r.valence) for r in lx.scan_lexicon(spark, path).collect()}
    assert got == {("word", -5), ("", 3), ('"quoted', 1), ("\ttabbed", 2), (" blank ", 4), ("\x0bq", -4)}
    assert sorted(r.line for r in lx.lexicon_rejects(spark, path).collect()) == ["", "bad\tx", "no tab"]


def test_review_csv_keeps_empty_and_blanks(spark):
    from driftwood.sources import reviews as rv
    texts = ["", None, "  lead", "trail  ", 'q"uo"te', "two\nlines", "a,b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.review_id: r.text for r in rv.scan_review_csv(spark, rv.land_review_csv(df, work_path(spark, "t-rev"))).collect()}
    assert got == dict(enumerate(texts))


@pytest.fixture(scope="module")
def setup(spark):
    bad = lx.bad_words(lx.lexicon_from_texts(read_table(spark, SF_SMALL, "benchmark")))
    lines = docs.document_lines(read_table(spark, SF_SMALL, "documents"))
    return bad, lines


def test_batch_gate_is_all_or_nothing_and_subset_of_sentence_gate(spark, setup):
    bad, lines = setup
    bits = bloom.set_bits(bloom.build(bad, 2000, 5))
    batch = F.floor(F.col("doc_id") / 7)
    passed = gates.batch_gate(lines, bits, batch, 2000, 5)
    per_batch_in = lines.groupBy(batch.alias("batch_id")).count()
    per_batch_out = passed.groupBy("batch_id").count()
    j = per_batch_out.join(per_batch_in, "batch_id").collect()
    assert all(r[1] == r[2] for r in j)  # a passing batch passes whole
    sent = gates.sentence_gate(lines, bits, 2000, 5)
    keys = ["doc_id", "line_no"]
    assert passed.select(*keys).subtract(sent.select(*keys)).count() == 0


def test_exact_semi_and_anti_partition_tokens(spark, setup):
    bad, lines = setup
    toks = docs.line_tokens(lines)
    assert gates.exact_semi(toks, bad).count() + gates.exact_anti(toks, bad).count() == toks.count()
