"""Window hits against brute force over the words themselves, and the cleaning."""

import re

from driftwood.llm import decontam
from driftwood.llm.queries import op9_decontam
from llm_helpers import SF_SMALL, by_id, sha

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= of
        names = sorted({str(i) for i in found if i is not None})
        out[doc] = (len(w), len(hit), len(names), sha(",".join(names)), bool(hit))
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def check(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, hits string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, items string")
    got = rows(decontam.leak_digests(decontam.find_leaks(d, b, **more)))
    assert got == brute(docs, items)
    return got


def texts(rng, n, vocabulary, most):
    return [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(rng.randrange(most)))) for i in range(n)]


def test_small_vocabulary_many_overlaps(spark, rng):
    v = ["a", "B", "ab"]
    items = texts(rng, 25, v, 30) + [(90, None), (91, ""), (92, "..."), (5, "a a a a a a a a a a a b"), (None, "b b b b b b b b b b b b")]
    check(spark, texts(rng, 120, v, 80) + [(900, None), (901, ""), (902, " , ")], items)


def test_long_items_only_and_planted_passages(spark, rng):
    v = [f"w{i}" for i in range(40)] + ["é", "日本", "x9"]
    items = [(i, " ".join(rng.choices(v, k=rng.randrange(10, 40)))) for i in range(15)]
    docs = []
    for i in range(80):
        w = rng.choices(v, k=60)
        if i % 2:
            s = items[i % 15][1].split()
            a = rng.randrange(len(s))
            w[20:20] = s[a:a + rng.randrange(1, 20)]
        docs.append((i, (" ".join(w)).upper() if i % 3 else " ".join(w)))
    check(spark, docs, items)
    check(spark, docs, items, shard_words=30)


def test_one_word_items_empty_tables(spark):
    docs = [(1, "yes no Yes maybe"), (2, "never")]
    check(spark, docs, [(7, "YES"), (8, "no yes"), (7, "maybe")])
    check(spark, docs, [])
    check(spark, [], [(1, "a")])


def test_query_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = rows(op9_decontam(spark, SF_SMALL))
    assert got == brute(docs, items) and any(r[4] for r in got.values())


def test_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(12))
    check(spark, [(1, "zz " * 300_000 + item + " yy" * 300_000), (2, "q1 q2 " * 50_000)], [(1, item)])


def test_remove(spark, rng):
    item = " ".join(f"q{i}" for i in range(14))
    clean = "nothing to see here, move on " * 4
    docs = [(1, f"{clean}. {item}! {clean}", 0, "k"), (2, clean, 111, "k"), (3, None, 5, None), (4, item, 1, "k"), (2, clean, 111, "k"),
            (5, f"{clean} q0 q1 q2 {item} q3 q4 q5 q6 q7 q8 q9 q10 q11 {clean}", 0, "k")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars bigint, items string")
    b = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = decontam.remove_leaks(d, b, length_col="n_chars")
    assert out.schema.simpleString() == d.schema.simpleString()
    got = sorted(out.collect(), key=str)
    assert sorted(r.doc_id for r in got) == [1, 2, 2, 3, 5]
    for r in got:
        if r.doc_id in (2, 3):
            assert tuple(r) in docs
        else:
            assert "q13" not in r.text and r.n_chars == len(r.text) and r.text.count("nothing") == 8
    assert not any(r.contaminated for r in decontam.leak_digests(decontam.find_leaks(out, b)).collect())
    assert decontam.remove_leaks(d, b.limit(0)).count() == len(docs)
    two = b.union(b.selectExpr("item_id + 1", "'see here'"))
    parts = [decontam.remove_leaks(d, two, shard_words=n, length_col="n_chars").collect() for n in (5, 1000)]
    assert sorted(map(str, parts[0])) == sorted(map(str, parts[1]))
    assert not any("see here" in (r.text or "") for r in parts[0]) and {r.doc_id for r in parts[0]} == {1, 2, 3, 5}


def test_automaton_matches_every_substring(rng):
    items = [(i, " ".join(rng.choices("ab", k=8))) for i in range(6)]
    a = decontam.WindowAutomaton(items, window=3)
    runs = {tuple(t.split()[i:j]) for _, t in items for i in range(8) for j in range(i + 1, 9)}
    for _ in range(200):
        doc = rng.choices("abc", k=30)
        longest = max((j - i for i in range(30) for j in range(i + 1, 31) if tuple(doc[i:j]) in runs), default=0)
        assert a.matches([w.encode() for w in doc])[2] == (longest if longest >= 3 else 0)  # shorter than any window: not streamed
