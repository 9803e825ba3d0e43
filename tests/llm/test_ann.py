"""Neighbours against brute force: recall, exact scores, ties, odd vectors."""

import numpy as np

from driftwood.llm import ann
from driftwood.llm.queries import op2_ann

SCHEMA = "vec_id bigint, embedding array<float>, rank string"


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def brute(rows, asked, k):
    out = {}
    for q in asked:
        scores = sorted((-float((rows[q] * v).sum()), i) for i, v in rows.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def check(got, rows, asked, k=20):
    want, hits, total = brute(rows, asked, k), 0, 0
    assert set(got) == set(want)
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert len({i for _, i, _ in found}) == len(found) and q not in {i for _, i, _ in found}
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert abs(s - float((rows[q] * rows[i]).sum())) <= 1e-12 * max(1, abs(s))
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
        total += len(want[q])
    return hits / total


def test_recall_on_tables(spark):
    for sf in ("sf0.01", "sf0.1"):
        table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
        rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in table}
        assert check(results(op2_ann(spark, f"/root/testdata/{sf}")), rows, [i for i in rows if i % 20 == 0]) >= 0.9


def test_many_blocks_lengths_and_copies(spark):
    rng = np.random.default_rng(5)
    x = np.float32(rng.standard_normal((1500, 16)) * rng.lognormal(0, 0.5, (1500, 1)))
    x[300:700] = x[3]  # a large group of copies
    rows = {i: v.astype(float) for i, v in enumerate(x)}
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], SCHEMA)
    got = results(ann.nearest_neighbors(df, df.where("vec_id % 20 = 0"), block_rows=300, block_queries=20))
    assert check(got, rows, range(0, 1500, 20)) >= 0.9
    assert [i for _, i, _ in got[320]][:3] == [3, 300, 301] or rows[3] @ rows[3] < max(rows[3] @ v for v in x)


def test_odd_rows(spark):
    good = [(20, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [2.0, 1.0]), (3, [2.0, 1.0]), (40, [3e38, 0.0])]
    bad = [(4, None), (60, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in good + bad], SCHEMA)
    got = results(ann.nearest_neighbors(df, df.where("vec_id % 20 = 0"), k=3))
    assert set(got) == {20, 40}
    assert [i for _, i, _ in got[20]] == [40, 3, 1]
    assert [i for _, i, _ in got[40]] == [3, 20, 1]
    alone = df.where("vec_id = 20")
    assert results(ann.nearest_neighbors(alone, alone)) == {}
    assert results(ann.nearest_neighbors(df.limit(0), df.limit(0))) == {}
