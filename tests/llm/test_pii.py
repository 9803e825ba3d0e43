"""Anchor expansion against the plain patterns, and masking."""

import re

from driftwood.llm import pii
from driftwood.llm.queries import op6_pii
from llm_helpers import SF_SMALL, by_id, sha


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def digits(s):
    return "".join(c for c in s if c.isdigit())


PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15))


def plain(text):
    return [(k, m.start(), m.end()) for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m.group())]


def check(text, r):
    want = plain(text)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[0] == k for w in want) for k in pii.BASE), text[:200]
    assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want)), text[:200]
    assert [s for s in r.spans.split(",") if s and s.split(":")[0] in pii.BASE] == [f"{k}:{a}:{b}" for k, a, b in want]


def test_generated_texts(spark, rng):
    bits = ["@", ".", "a", "bc", "-", "+", "+1", " ", "(", ")", "1", "22", "255", "256", "0", "000", "4111111111111111", "4111 1111-1111 1111",
            "x@y.z", "é", "😀", "\n", "%", "_", "10.0.0.1", "+49 (30) 1234567", "  ", "--", "79927398713"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(1500)]
    texts += [None, "", "a@b@c.d@e.f", "1.2.3.4.5.6.7.8.9", "9" * 6000 + ".1.1.1", "0" * 300 + "1.2.3.4", "a" * 3000 + "@b.c", "5" * 3000, "+1" + " " * 3000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, n_email string")
    got = by_id(pii.pii_digests(pii.find_pii(df)))
    for i, t in enumerate(texts):
        if t is not None and "9999" in t:  # int() of so many digits is refused by Python itself
            assert got[i].n_ip == 0
            continue
        check(t, got[i])


def test_very_long_texts_take_linear_time(spark):
    texts = ["a" * 2_000_000 + "@b.c", "5" * 2_000_000, "+1" + " " * 2_000_000, "@" * 500_000, "1." * 500_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = by_id(pii.pii_digests(pii.find_pii(df)))
    assert [(got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) for i in range(5)] == [
        (1, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 125_000, 0, 0)]


def test_query_on_the_table(spark):
    texts = by_id(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = by_id(op6_pii(spark, SF_SMALL))
    assert set(got) == set(texts)
    for i, r in got.items():
        check(texts[i].text, r)


def test_added_kinds(spark):
    text = "IBAN: DE89 3704 0044 0532 0130 00, Iban DE00370400440532013000; ssn 078-05-1120; see https://bob:hunter2@example.com/x and https://example.com/"
    r = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    added = {(s.kind, text[s.start:s.end]) for s in r.spans if s.kind not in pii.BASE}
    assert added == {("account", "DE89 3704 0044 0532 0130 00"), ("account", "078-05-1120"), ("url", "bob:hunter2@example.com")}


def test_mask(spark):
    rows = [(1, "mail a@b.cd now", 15, "k"), (2, None, 0, None), (3, "", 0, ""), (4, "clean", 5, "z"), (4, "clean", 5, "z"), (5, "to +49 30 1234567 or 10.1.2.3", 28, "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, spans string")
    got = sorted((tuple(r) for r in pii.mask_pii(df, length_col="n_chars").collect()), key=str)
    assert got == sorted([(1, "mail [EMAIL] now", 16, "k"), (2, None, 0, None), (3, "", 0, ""), (4, "clean", 5, "z"), (4, "clean", 5, "z"),
                          (5, "to [PHONE] or [IP]", 18, "q")], key=str)
    assert pii.mask_pii(df.limit(0)).count() == 0
    again = pii.find_pii(pii.mask_pii(df)).collect()
    assert all(not r.spans for r in again)


def test_empty_and_repeated_rows(spark):
    schema = "doc_id bigint, text string"
    assert pii.pii_digests(pii.find_pii(spark.createDataFrame([], schema))).count() == 0
    assert [len(r.spans) for r in pii.find_pii(spark.createDataFrame([(None, "a@b.c")] * 3, schema)).collect()] == [1, 1, 1]


def test_cues_and_schemes_in_any_case():
    scan = pii.AnchorScanner().scan
    for cue, number in (("Social Security Number: ", "123-45-6789"), ("Tax ID ", "123456789"), ("Customer ID: ", "12345678"),
                        ("tAX Id ", "123456789"), ("sSN ", "123-45-6789"), ("account ", "12345678")):
        for before in ("", "é漢😀 ", "İİ "):  # the last one's lower case is longer
            text = before + cue + number
            assert ("account", len(text) - len(number), len(text)) in scan(text), text
    assert ("url", 8, 17) in scan("HttPS://u:p@a.com")


def test_account_numbers_end_where_their_country_says():
    from driftwood.llm.pii import AnchorScanner
    texts = {"IBAN: DE89 3704 0044 0532 0130 00 BIC": ["DE89 3704 0044 0532 0130 00"], "iban de89370400440532013000, and": ["de89370400440532013000"],
             "IBAN GB82 WEST 1234 5698 7654 32 ABC": ["GB82 WEST 1234 5698 7654 32"], "IBAN DE89 3704 0044 0532 0130 01 BIC": [],
             "IBAN FR1420041010050500013M02606": ["FR1420041010050500013M02606"]}
    for text, want in texts.items():
        assert [text[a:b] for kind, a, b in AnchorScanner().scan(text) if kind == "account"] == want, text


def test_contract_columns_come_first(spark):
    from driftwood.llm import pii
    out = pii.pii_digests(pii.find_pii(spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")))
    assert out.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
