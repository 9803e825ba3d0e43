"""Secret spans against the plain patterns, and the novelty measure on known cases."""

import base64
import hashlib
import re

from driftwood.llm import secrets
from driftwood.llm.queries import op1_secrets
from llm_helpers import SF_SMALL, by_id, sha

PLAIN = (("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
         ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
         ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24))


def plain(text):
    spans = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m)]
    return [(name, a, b) for a, _, name, b in sorted(spans)]


def check(rows):
    for text, r in rows:
        want = plain(text)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[0] == k for w in want) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want))
        kept = [s for s in r.spans.split(",") if s and not s.startswith("novel:")]
        assert kept == [f"{k}:{a}:{b}" for k, a, b in want]


def test_base_spans_on_generated_texts(spark, rng):
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "ſecret", "toKen", " ", "  ", ":", "=", "'", '"', "AKIA", "AKIAAKIA", "ABCDEFGH12345678",
            "0123456789abcdef", "deadbeefdeadbeef", "é", "😀", "abc12", "abcdef", "\n", "Z_9.+/=-", "F"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(400)]
    texts += [None, "", "token = secret=abcdef", "token: secret: abcdef1", "AKIA" + "Z" * 15, "AKIA" + "Z" * 16, "x" * 500_000 + "password: hunter22"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    got = by_id(secrets.secret_digests(secrets.find_secrets(df)))
    check([(t, got[i]) for i, t in enumerate(texts)])


def test_query_on_the_table(spark):
    texts = by_id(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = by_id(op1_secrets(spark, SF_SMALL))
    assert set(got) == set(texts)
    check([(texts[i].text, r) for i, r in got.items()])


def spans_of(spark, text):
    return {(s.kind, text[s.start:s.end]) for s in secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first().spans}


def test_novelty(spark):
    key = base64.b64encode(hashlib.sha256(b"seed").digest()).decode().rstrip("=")
    assert ("novel", key) in spans_of(spark, f"private signing material, auth = \"{key}\" and so on")
    assert not spans_of(spark, f"an ordinary sentence that only happens to hold {key} far from anything")
    assert not spans_of(spark, "session class handlerFactory2_ConnectionManagerInterface2 and more")  # dictionary words
    assert not spans_of(spark, f"{key} earlier, then bearer {key} repeats its surroundings") - {("novel", key)} - set()


def test_empty_and_repeated_rows(spark):
    schema = "doc_id bigint, text string"
    assert secrets.secret_digests(secrets.find_secrets(spark.createDataFrame([], schema))).count() == 0
    rows = secrets.find_secrets(spark.createDataFrame([(None, "token=abcdef")] * 3, schema)).collect()
    assert len(rows) == 3 and all(len(r.spans) == 1 for r in rows)


def test_letters_only_keys_and_what_base_spans_leave(spark):
    from driftwood.llm import secrets
    scanner = secrets.NoveltyScanner()
    key = "qZxWvKjRtPmNbLcHgFyDsA"
    novel = lambda text: [text[a:b] for kind, a, b, _ in scanner.scan(text) if kind == "novel"]
    assert novel(f'the api key was "{key}" then') == [key]
    assert novel('the api key was "configurationManagerFactory" then') == []
    assert novel("ordinary words " * 50) == []
    out = secrets.secret_digests(secrets.find_secrets(spark.createDataFrame([(1, f"token={key}")], "doc_id long, text string")))
    assert out.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def test_uncovered_parts():
    from driftwood.llm.secrets import uncovered
    covered = [(10, 20), (30, 40)]
    at = (covered, [10, 30], [20, 40])
    assert uncovered(50, 70, *at) == [(50, 70)] and uncovered(20, 30, *at) == [(20, 30)]
    assert uncovered(0, 70, *at) == [(40, 70)] and uncovered(12, 18, *at) == [] and uncovered(15, 60, *at) == [(40, 60)]
