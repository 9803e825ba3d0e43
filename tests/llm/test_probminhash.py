"""Near duplicates against brute force over all pairs that share a shingle."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from driftwood.llm import probminhash as pm
from driftwood.llm.graph import components
from driftwood.llm.queries import op3_minhash
from llm_helpers import SF_MID

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(a, b):
    ta, tb = sum(a.values()), sum(b.values())
    p, q = {x: c / ta for x, c in a.items()}, {x: c / tb for x, c in b.items()}
    return sum(1 / sum(max(p.get(y, 0) / p[x], q.get(y, 0) / q[x]) for y in p.keys() | q.keys()) for x in p.keys() & q.keys())


def jaccard_bound(a, b):
    """No pair below this overlap can reach 0.8: cheap filter for the exact sum."""
    return sum(min(a[x] / sum(a.values()), b[x] / sum(b.values())) for x in a.keys() & b.keys())


def classes(docs):
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(i, j):
        parent[max(find(i), find(j))] = min(find(i), find(j))
    sets, seen, by = [shingles(t) for _, t in docs], {}, defaultdict(list)
    hashed = [pm.weighted_shingles(t or "") for _, t in docs]  # test_similarity_is_exact compares the measure itself
    for i, (_, t) in enumerate(docs):
        if (t or "") in seen:
            join(seen[t or ""], i)
        else:
            seen[t or ""] = i
            for s in sets[i]:
                by[s].append(i)
    for i in seen.values():
        near = {j for s in sets[i] for j in by[s] if j < i}
        for j in near:
            if jaccard_bound(sets[i], sets[j]) >= 0.79 and pm.probability_jaccard(hashed[i], hashed[j]) >= 0.8 - 1e-9:
                join(i, j)
    first = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        first[r] = d if first.get(r) is None else first[r] if d is None else min(first[r], d)
    return sorted(((d, first[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, digest string")
    return sorted(((r.doc_id, r.class_id) for r in pm.near_duplicates(df).collect()), key=str)


def test_query_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.class_id) for r in op3_minhash(spark, SF_MID).collect()), key=str)
    assert got == classes(docs) and any(a != b for a, b in got)


def changed(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_groups_passages_and_odd_rows(spark, rng):
    v = [f"w{i}" for i in range(3000)]
    docs, passage = [], rng.choices(v, k=60)
    for g in range(12):  # groups of near copies with a passage that all groups share
        words = rng.choices(v, k=90) + passage + rng.choices(v, k=90)
        docs += [changed(rng, words, rng.randrange(0, 9)) for _ in range(rng.randrange(1, 12))]
    docs += [" ".join(rng.choices(v, k=20) + passage * 3) for _ in range(40)]
    docs += ["same words here", "Same, words HERE!", "same words here", "other"] + [None, "", "...", "..."] + ["one two three four", "one two three four five"]
    hot = rng.choices(v, k=300)
    docs += [" ".join(hot)] * 60 + [changed(rng, hot, 2) for _ in range(60)]
    docs += [("lorem ipsum dolor sit amet " * 30).strip(), ("lorem ipsum dolor sit amet " * 31).strip(), "z " * 200_000, "z " * 200_001]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(docs)] + [(7, docs[7]), (7, docs[7]), (7, docs[30])]
    rng.shuffle(rows)
    assert run(spark, rows) == classes(rows)


def edited(words, places, tag):
    """Each of the places changed to a word of its own: five shingles less in common each."""
    w = list(words)
    for p in places:
        w[p] = f"{tag}at{p}"
    return " ".join(w)


@pytest.mark.parametrize("n", [50, 1000])
def test_variants_of_one_original(spark, rng, n):
    # 0.82 to the original, about 0.68 to one another: they are linked through the original alone.
    words = [f"w{i}" for i in range(204)]
    docs = [" ".join(words)] + [edited(words, rng.sample(range(4, 200, 5), 4), f"v{k}") for k in range(n)]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    sets = [pm.weighted_shingles(d) for d in docs]
    assert all(pm.probability_jaccard(sets[0], s) >= 0.8 for s in sets) and pm.probability_jaccard(sets[1], sets[2]) < 0.8
    assert {c for _, c in run(spark, rows)} == {0}


def test_pairs_among_form_letters(spark, rng):
    # Letters at 0.74 to one another, each with one copy at 0.85.
    words, docs = [f"w{i}" for i in range(204)], []
    for k in range(100):
        letter = words[:50] + [f"own{k}x{i}" for i in range(26)] + words[76:]
        docs += [" ".join(letter), edited(letter, [10, 20, 30], f"c{k}")]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    sets = [pm.weighted_shingles(d) for d in docs]
    near = {(i, j) for i in range(200) for j in range(i + 1, 200) if pm.probability_jaccard(sets[i], sets[j]) >= 0.8}
    assert near == {(i, i + 1) for i in range(0, 200, 2)}
    assert run(spark, rows) == [(i, i - i % 2) for i in sorted(range(200), key=lambda i: str((i, i - i % 2)))]


def letters(rng, n, pairs):
    """n letters at 0.74 to one another; the first ``pairs`` have a copy each at 0.85."""
    words, docs = [f"w{i}" for i in range(204)], []
    for k in range(n):
        letter = words[:50] + [f"own{k}x{i}" for i in range(26)] + words[76:]
        docs.append(" ".join(letter))
        if k < pairs:
            docs.append(edited(letter, [10, 20, 30], f"c{k}"))
    return docs


def test_crowds_lose_few_links_and_rows_stay_few(spark, rng, monkeypatch):
    made = []
    real = pm.staged
    monkeypatch.setattr(pm, "staged", lambda df, name: (lambda t: (made.append((name, t.count())), t)[1])(real(df, name)))
    rows = {}
    for n in (200, 2000):
        made.clear()
        docs = letters(rng, n, n // 4)
        got = dict(run(spark, list(enumerate(docs))))
        linked = sum(got[2 * k + 1] == 2 * k for k in range(n // 4))
        assert linked >= 0.95 * (n // 4), (n, linked)
        assert len(set(got.values())) >= len(docs) - n // 4  # no letter is joined to another one
        rows[n] = max(c for name, c in made if name in ("pairs", "candidates"))
    assert rows[2000] <= 12 * rows[200]  # ten times the members


def test_a_narrow_window_loses_no_link(spark, rng, monkeypatch):
    monkeypatch.setattr(pm, "WINDOW", 2)  # so that most pairs of a bucket never stand near each other
    monkeypatch.setattr(pm, "BLOCK", 20, raising=False)  # several blocks
    docs = letters(rng, 120, 40)
    own = [f"z{k}" for k in range(200)]
    docs += [" ".join(["w%d" % i for i in range(100)] + [f"{x}at{k}" for x in own]) for k in range(20)]  # words of their own: no partner
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    assert run(spark, rows) == classes(rows)


def test_members_with_words_of_their_own_are_not_compared(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words + [f"own{k}x{i}" for i in range(40)]) for k in range(5)] + [" ".join(words + [f"p{i}" for i in range(40)] + [x]) for x in "ab"]
    crowd = spark.createDataFrame([(1, 0, k, 200, k) for k in range(7)], "band long, at int, node long, n long, component long")
    nodes = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    assert sorted(r.node for r in pm.may_be_near(crowd, nodes, 0.8).collect()) == [5, 6]


def test_cells_get_a_kilobyte_for_each_member_of_a_bucket(spark, rng, monkeypatch):
    n, bands = 600, 8
    nodes = spark.createDataFrame(list(enumerate(letters(rng, n - 2, 2))), "node long, text string")
    crowd = spark.createDataFrame([(100 + at, at, k, n, k) for k in range(n) for at in range(bands)], "band long, at int, node long, n long, component long")
    sent = []
    real = pm.near_in_cells

    def cells(rows, similarity):
        sent.append(sum(len(r.sketch) for r in rows.select("sketch").collect()))
        return real(rows, similarity)
    monkeypatch.setattr(pm, "near_in_cells", cells)
    found = [(r.u, r.v) for r in pm.crowd_pairs(crowd, nodes).collect()]
    assert len(found) == len(set(found)) and {(0, 1), (2, 3)} <= set(found)
    assert sent[0] <= 1024 * n * bands


def test_packed_sketches_estimate_similarity():
    base = [f"w{i}" for i in range(404)]
    sets = [pm.weighted_shingles(" ".join(base))] + [pm.weighted_shingles(edited(base, range(4, 4 + 5 * n, 5), "x")) for n in range(0, 60, 3)]
    two = pm.packed(pm.sketches(sets, pm.CROWD_SKETCH)).view("uint64")
    seen = pm.packed_estimates(np.repeat(two[:1], len(two) - 1, axis=0), two[1:])
    true = [pm.probability_jaccard(sets[0], x) for x in sets[1:]]
    assert seen[0] == 1 and np.abs(seen - true).max() < 0.04
    assert pm.least_estimate(0.8, pm.CROWD_SKETCH, pm.CROWD_ERRORS, pm.CROWD_VALUES) == pytest.approx(0.8 - 4 * (0.85 * 0.15 / 4096) ** 0.5 / 0.75)


def test_nothing_new_linked_leaves_the_components_alone(spark, monkeypatch):
    texts = spark.createDataFrame([(0, "a b c d e f"), (1, "a b c d e f"), (2, "k l m n o p")], "node long, text string")
    linked = spark.createDataFrame([(1, 0)], "node long, component long")
    calls = []
    real = pm.components
    monkeypatch.setattr(pm, "components", lambda edges: (calls.append(1), real(edges))[1])
    pairs = spark.createDataFrame([(2, 0, 0.8)], "v long, u long, estimate double")
    assert [tuple(r) for r in pm.join_best(linked, pairs, texts, 0.8).collect()] == [(1, 0)] and not calls


def test_fewer_pairs_than_texts_are_verified_at_once(spark, monkeypatch):
    base = [f"w{k}" for k in range(100)]
    far, near = edited(base, range(4, 100, 9), "y"), edited(base, [50], "z")
    texts = spark.createDataFrame([(0, " ".join(base)), (1, " ".join(base) + " end"), (2, near), (3, far), (4, far + " end"), (9, near + " end")], "node bigint, text string")
    linked = spark.createDataFrame([(1, 0), (4, 3), (9, 2)], "node bigint, component bigint")
    # The best estimates of two components are those of pairs that aren't near duplicates.
    left = [(1, 3, 0.95), (0, 3, 0.9), (0, 4, 0.85), (4, 9, 0.84), (1, 9, 0.82)]
    calls, rows = [], []
    links, real = pm.join_links, pm.components
    monkeypatch.setattr(pm, "join_links", lambda *a: (calls.append(a[1].count()), links(*a))[1])
    monkeypatch.setattr(pm, "components", lambda edges: (rows.append(edges.count()), real(edges))[1])
    out = pm.join_best(linked, spark.createDataFrame(left, "u bigint, v bigint, estimate double"), texts, 0.8)
    assert {r.node: r.component for r in out.collect()} == {1: 0, 2: 0, 9: 0, 4: 3}
    assert calls == [5] and rows == [1]  # one pass; only new links are searched for components
    # More pairs than texts: the best of every two components first, in rounds.
    calls.clear()
    out = pm.join_best(linked, spark.createDataFrame(left, "u bigint, v bigint, estimate double"), texts.where("node IN (0, 1, 3, 9)"), 0.8)
    assert calls[0] == 3 and {r.node: r.component for r in out.collect()} == {1: 0, 2: 0, 9: 0, 4: 3}


def test_texts_of_few_shingles_are_sketched_in_few_steps(monkeypatch):
    steps, real = [], pm.mix
    sets = [pm.weighted_shingles(t) for t in ("a b c d e f", "a b c d e f g", "x " * 30 + "y", "", "a b")]
    monkeypatch.setattr(pm, "mix", lambda x: (steps.append(x.size), real(x))[1])
    sign = pm.signatures(sets, pm.CROWD_SKETCH)
    assert len(steps) < 500 and max(steps) <= 2 * pm.DRAWS  # one step a turn: some 20,000
    for (shingles, _), row in zip(sets, sign):
        assert set(row.tolist()) == (set(shingles.tolist()) or {0})
    assert (np.concatenate([pm.signatures([s], pm.CROWD_SKETCH) for s in sets]) == sign).all()
    # Registers by the definition: the earliest arrival of all, turn after turn.
    monkeypatch.setattr(pm, "mix", real)
    (items, counts), first = sets[1], {}
    time = np.zeros(len(items))
    for turn in range(1, 400):
        step = np.array([2 * turn, 2 * turn + 1], dtype=np.uint64) * pm._ODD
        time = time - np.log(((real(items + step[0]) >> np.uint64(11)).astype(float) + 1) / 9007199254740992.0) / counts
        for at, when, item in zip((real(items + step[1]) % np.uint64(48)).tolist(), time.tolist(), items.tolist()):
            first[at] = min(first.get(at, (when, item)), (when, item))
    assert pm.signatures([sets[1]], 48)[0].tolist() == [first[at][1] for at in range(48)]


def test_repeated_rows_and_null_ids_are_one_text(spark, rng, monkeypatch):
    base = [f"q{i}" for i in range(120)]
    near = [" ".join(base), changed(rng, base, 1)]
    pairs = []
    real = pm.verify
    monkeypatch.setattr(pm, "verify", lambda both, similarity: (pairs.append(both.count()), real(both, similarity))[1])
    rows = [(i, near[i]) for i in (0, 1) for _ in range(1000)] + [(None, t) for t in near for _ in range(500)]
    assert {c for _, c in run(spark, rows)} == {0} and sum(pairs) == 1


def test_a_column_may_be_called_as_the_key(spark):
    df = spark.createDataFrame([(1, "a b c", "x", "y"), (2, "a b c", "x", "y")], "doc_id bigint, text string, key string, __key string")
    assert [tuple(r) for r in pm.drop_near_duplicates(df).collect()] == [(1, "a b c", "x", "y")]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_drop(spark, rng):
    base = [f"q{i}" for i in range(100)]
    docs = [(5, " ".join(base), "a"), (3, " ".join(base), "b"), (9, changed(rng, base, 1), "c"), (4, "alone here", "d"), (4, "alone here", "d"),
            (None, None, "e"), (None, "lonely null id", "f"), (11, "", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, component string")
    out = pm.drop_near_duplicates(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert sorted(((r.doc_id, r.component) for r in out.collect()), key=str) == sorted([(3, "b"), (4, "d"), (None, "f"), (11, None)], key=str)
    assert pm.drop_near_duplicates(df.limit(0)).count() == 0


def test_similarity_is_exact(rng):
    for _ in range(100):
        texts = [" ".join(rng.choices("abc", k=rng.randrange(1, 25))) for _ in range(2)]
        got = pm.probability_jaccard(*map(pm.weighted_shingles, texts))
        assert got == pytest.approx(similarity(*map(shingles, texts)), abs=1e-12)


def test_registers_estimate_similarity(rng):
    seen, true = [], []
    for _ in range(60):
        words = rng.choices([f"w{i}" for i in range(50)], k=rng.randrange(10, 200))
        a, b = " ".join(words), changed(rng, words, rng.randrange(4))
        s = pm.signatures([pm.weighted_shingles(a), pm.weighted_shingles(b), pm.weighted_shingles("single")])
        seen.append((s[0] == s[1]).mean())
        true.append(similarity(shingles(a), shingles(b)))
    assert abs(np.mean(seen) - np.mean(true)) < 0.03 and np.abs(np.array(seen) - true).max() < 0.2


def test_word_hashes_at_chunk_ends():
    words = [f"w{i % 997}" for i in range(400_000)]
    h = pm.word_hashes(" ".join(words).encode())
    assert len(h) == len(words) and len(set(h.tolist())) == 997 and (h[:997] == h[997:1994]).all()


def test_components(spark, rng):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(200, 260)] + [(300, 301), (301, 300), (5, 5)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {i: 0 for i in range(1, 61)} | {k: 100 for k in range(200, 260)} | {301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_stars_are_components_at_once(spark, monkeypatch):
    from driftwood.llm import graph
    staged = []
    real = graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, name: (staged.append(name), real(df, name))[1])
    stars = [(k, 5) for k in range(10, 40)] + [(3, k) for k in range(50, 60)]
    assert {r.node: r.component for r in components(spark.createDataFrame(stars, "u bigint, v bigint")).collect()} == {max(e): min(e) for e in stars}
    assert len(staged) == 1
    two = [(9, 1), (9, 2), (2, 0)]  # a node between two stars
    assert {r.node: r.component for r in components(spark.createDataFrame(two, "u bigint, v bigint")).collect()} == {9: 0, 1: 0, 2: 0}
