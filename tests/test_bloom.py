"""Bloom filter: hand vector, byte layout against a brute-force packer, no false
negatives, save/reload identity, padding repair, k = 5 and 15."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from driftwood.functions.hashing import md5_mod
from driftwood.operators import bloom
from driftwood.session import work_path
from driftwood.sources import lexicon as lx
from driftwood.sources.tables import read_table
from conftest import SF_SMALL


def py_positions(word, m, k):
    """Positions from the digest's bytes, folded from the left."""
    out = []
    for i in range(k):
        rest = 0
        for byte in hashlib.md5(f"{word}{i}".encode()).digest():
            rest = (256 * rest + byte) % m
        out.append(rest)
    return out


def py_pack(words, m, k):
    bits = bytearray((m + 7) // 8)
    for w in words:
        for p in py_positions(w, m, k):
            bits[p // 8] |= 0x80 >> (p % 8)
    return base64.b64encode(bytes(bits)).decode()


def test_md5_position_hand_vector(spark):
    r = spark.range(1).select(md5_mod(F.lit("abc0"), 2000).alias("p")).collect()[0]["p"]
    assert r == 1823 == py_positions("abc", 2000, 1)[0]


@pytest.fixture(scope="module")
def bad(spark):
    return lx.bad_words(lx.lexicon_from_texts(read_table(spark, SF_SMALL, "benchmark")))


@pytest.mark.parametrize("k", [5, 15])
def test_build_matches_bruteforce_packing(spark, bad, k):
    words = [r["word"] for r in bad.collect()]
    art = bloom.build(bad, 2000, k).collect()[0]
    assert art["bits_b64"] == py_pack(words, 2000, k)
    assert art["n_words"] == len(words)
    assert art["bits_set"] == len({p for w in words for p in py_positions(w, 2000, k)})


@pytest.mark.parametrize("m", [13, 2000, 2003])
def test_odd_sizes_trim_and_reload(spark, bad, m):
    art = bloom.build(bad, m, 5)
    path = bloom.save(art, work_path(spark, "t-bloom"))
    back = bloom.set_bits(bloom.reload(spark, path))
    words = [r["word"] for r in bad.collect()]
    expect = sorted({p for w in words for p in py_positions(w, m, 5)})
    assert sorted(r["pos"] for r in back.collect()) == expect


def test_no_false_negatives_and_probe_equals_python(spark, bad):
    bits = bloom.set_bits(bloom.build(bad, 2000, 5))
    words = [r["word"] for r in bad.collect()]
    probe_words = spark.createDataFrame([(w,) for w in words + ["zzz", "", "a b", "héllo"]], "word string")
    got = {r["word"]: r["in_filter"] for r in bloom.probe(probe_words, bits, 2000, 5).collect()}
    assert all(got[w] for w in words)
    setbits = {p for w in words for p in py_positions(w, 2000, 5)}
    for w in ["zzz", "", "a b", "héllo"]:
        assert got[w] == all(p in setbits for p in py_positions(w, 2000, 5))


def test_large_filter_in_linear_time(spark):
    words = spark.range(2000).selectExpr("CAST(id AS STRING) AS word")
    art = bloom.build(words, 1_000_003, 3)
    row = art.collect()[0]
    back = bloom.set_bits(bloom.reload(spark, bloom.save(art, work_path(spark, "t-bloom-large"))))
    want = bloom.positions(words, 1_000_003, 3, "word").select("pos").distinct()
    assert row["bits_set"] == want.count() == back.count() and back.exceptAll(want.select(F.col("pos").cast("int"))).count() == 0


def test_padding_repair(spark):
    df = spark.createDataFrame([("YWI",), ("YWJj",), ("YQ",)], "s string")
    out = [r["d"] for r in df.select(F.unbase64(bloom.fix_padding(F.col("s"))).alias("d")).collect()]
    assert [bytes(x) for x in out] == [b"ab", b"abc", b"a"]


def test_empty_word_list_builds_an_empty_filter(spark):
    empty = spark.createDataFrame([], "word string")
    art = bloom.build(empty, 2000, 5).collect()[0]
    assert art["bits_set"] == 0 and art["n_words"] == 0
    assert base64.b64decode(art["bits_b64"]) == bytes(250)


def test_merged_bitmaps_equal_a_rebuild(spark):
    words = spark.range(3000).selectExpr("concat('w', id) AS word")
    for m, k in ((2000, 5), (1 << 17, 3), (70_001, 2)):
        parts = [bloom.build_bitmaps(words.filter(f"hash(word) % 3 = {r}"), m, k) for r in (-2, -1, 0, 1, 2)] + [bloom.build_bitmaps(words.limit(0), m, k)]
        merged = bloom.merge_bitmaps(*parts)
        whole = bloom.build(words, m, k).first()
        assert bloom.pack(bloom.bitmap_positions(merged), m, k, F.lit(0)).first().bits_b64 == whole.bits_b64
        assert bloom.bits_set(merged).first().bits_set == whole.bits_set
        assert bloom.merge_bitmaps(merged, merged).exceptAll(merged).count() == 0  # OR of itself


def test_a_large_filter_takes_new_words(spark):
    m, k = 1 << 24, 7
    old = bloom.build_bitmaps(spark.range(20_000).selectExpr("concat('old', id) AS word"), m, k)
    new = spark.range(500).selectExpr("concat('new', id) AS word")
    merged = bloom.merge_bitmaps(old, bloom.build_bitmaps(new, m, k))
    pos = bloom.bitmap_positions(merged)
    assert bloom.probe(new, pos, m, k).filter("in_filter").count() == 500
    assert bloom.probe(spark.range(500).selectExpr("concat('other', id) AS word"), pos, m, k).filter("in_filter").count() == 0
    assert merged.count() <= m // bloom.BITMAP_BITS


def test_text_artifact_with_the_callers_parameters(spark, tmp_path):
    words = spark.createDataFrame([("one",), ("two",)], "word string")
    art = bloom.build(words, 2000, 5)
    path = bloom.save_text(art, f"{tmp_path}/bits")
    got = {r.pos for r in bloom.set_bits(bloom.reload_text(spark, path, 2000, 5)).collect()}
    assert got == {r.pos for r in bloom.set_bits(art).collect()} and got
    line = art.first().bits_b64.rstrip("=")
    spark.createDataFrame([(f"  {line} ",), ("",)], "value string").coalesce(1).write.text(f"{tmp_path}/loose")
    assert {r.pos for r in bloom.set_bits(bloom.reload_text(spark, f"{tmp_path}/loose", 2000, 5)).collect()} == got
