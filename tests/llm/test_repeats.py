"""Repeated passages against brute force over all 200-byte strings."""

import hashlib
from collections import Counter

import pytest

from driftwood.llm import repeats
from driftwood.llm.queries import op8_repeats
from llm_helpers import SF_MID


def brute(docs):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for (d, _), r in zip(docs, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if seen[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, **how):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, ref int, block int")
    return sorted((tuple(r) for r in repeats.remove_repeats(df, **how).collect()), key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeéß", k=rng.randrange(1, 9))) for _ in range(n))


def test_edges_copies_and_odd_texts(spark, rng):
    shared = [words(rng, 80) for _ in range(5)]
    docs = []
    for i in range(90):
        parts = [words(rng, rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [s[a:a + rng.randrange(100, 400)], words(rng, rng.randrange(0, 20))]
        docs.append("".join(parts))
    for i in range(20):  # near copies: one letter changed
        t = list(docs[i])
        if t:
            t[rng.randrange(len(t))] = "#"
        docs.append("".join(t))
    docs += [docs[3]] * 5 + [None, "", "x" * 199, "x" * 200, "y" * 200, "y" * 201, "ab" * 150, "z" * 3000, "z" * 150 + "q" + "z" * 150, "é" * 100, "é" * 100]
    docs += [shared[0][:200], "k" + shared[0][:200], shared[0][:199] + "!"]
    rows = [(i if i % 40 else None, t) for i, t in enumerate(docs)] + [(2, docs[2]), (2, docs[2]), (2, docs[9])]
    assert run(spark, rows) == brute(rows)


def test_query_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op8_repeats(spark, SF_MID).collect()), key=str)
    assert got == brute(docs) and any(r[2] for r in got)


@pytest.mark.parametrize("segment", [64, 1000])
def test_segments_change_nothing(spark, rng, segment):
    text = words(rng, 400)
    docs = [(1, text), (2, words(rng, 30) + text[300:1200] + words(rng, 30)), (3, "w" * 900), (4, text[5:])]
    want = brute(docs)
    old = repeats.SEGMENT
    try:
        repeats.SEGMENT = segment
        states = {}
        ranks = [(d, repeats.anchors(memory(t))) for d, t in docs]
        assert all(sum(s) == len(t.encode()) - repeats.GRAM - repeats.SPAN + 2 for (_, (_, _, s)), (_, t) in zip(ranks, docs))
        import numpy as np
        ref = np.concatenate([np.full(len(a[0]), d) for d, a in ranks])
        index = np.concatenate([np.arange(len(a[0])) for _, a in ranks])
        state = repeats.judge(ref, index, *(np.concatenate([a[k] for _, a in ranks]) for k in (0, 1)))
        seen, found = Counter(), {}
        for d, t in docs:
            raw, a = memory(t), dict(ranks)[d]
            settled, at = repeats.windows(raw, state[ref == d], a[2])
            found[d] = (raw, settled, at, repeats.window_ranks(raw, at).tolist())
            seen.update(found[d][3])
        got = []
        for d, (raw, settled, at, rank) in found.items():
            settled[[p for p, r in zip(at.tolist(), rank) if seen[r] > 1]] = True
            gone = repeats.covered(settled, len(raw))
            got.append((d, len(raw), int(gone.sum())))
        assert got == [r[:3] for r in want]
    finally:
        repeats.SEGMENT = old


def memory(text):
    import numpy as np
    return np.frombuffer(text.encode(), dtype=np.uint8)


@pytest.mark.parametrize("hot, chunk", [(1, 2_000), (2, 1 << 20), (repeats.HOT, repeats.CHUNK_BYTES)])
def test_frequent_anchors_are_thinned_without_loss(spark, rng, hot, chunk):
    passage, tail = words(rng, 60), words(rng, 30)
    docs = [words(rng, 8) + passage + words(rng, 8) for _ in range(120)]  # one passage, other surroundings each time
    docs += [words(rng, 4) + passage[:260] + tail + words(rng, 4) for _ in range(30)]
    docs += [docs[0], docs[0][5:], "-" * 20_000, "+" + "-" * 700 + "+", "-=" * 900, passage, "", None]
    docs += [words(rng, 60) for _ in range(20)]
    rng.shuffle(docs)
    rows = list(enumerate(docs)) + [(0, docs[0])]
    assert run(spark, rows, hot=hot, chunk=chunk) == brute(rows)


def test_a_chunk_sends_few_rows_of_one_rank(rng):
    import numpy as np
    rank = np.array([rng.choice([7, 7, 7, 9, rng.randrange(10**6)]) for _ in range(30_000)], dtype=np.uint64)
    stretch = np.array([rng.choice([0, 1, 2, rng.randrange(1, 10**6)]) for _ in range(30_000)], dtype=np.uint64)
    on, decided, state = repeats.sift(rank, stretch, repeats.HOT)
    assert sorted([*on.tolist(), *decided.tolist()]) == list(range(30_000))
    assert np.unique(rank[on], return_counts=True)[1].max() <= 2 * (repeats.HOT + 1)
    for r in (7, 9):  # other chunks still learn that the rank is mixed; each kind sent on or decided has a row to be compared with
        assert len(set(stretch[on][rank[on] == r].tolist()) - {0}) >= 2
        kinds = set(stretch[rank == r].tolist()) - {0}
        compared = set(stretch[on][rank[on] == r].tolist()) | set(stretch[decided][(rank[decided] == r) & (state != repeats.SETTLED)].tolist())
        assert kinds <= compared
    assert repeats.sift(rank[:0], stretch[:0], 1)[0].size == 0
    run_of_dashes = repeats.anchors(memory("-" * 100_000))
    assert len(repeats.sift(*run_of_dashes[:2], repeats.HOT)[0]) <= 2 * (repeats.HOT + 1)


def test_empty_table(spark):
    assert run(spark, []) == []
