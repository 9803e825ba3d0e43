"""Whitening against numpy's eigendecomposition, exact integers against Python's."""

import random

import numpy as np
import pytest

from driftwood.llm import whitening
from driftwood.llm.eigen import leading_eigenpairs
from driftwood.llm.queries import op11_whitening
from llm_helpers import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<double>, whitened string"


def run(spark, rows):
    df = spark.createDataFrame([(i, v, "w") for i, v in rows], SCHEMA)
    models = whitening.fit_whitening(df)
    return models, whitening.component_rows(whitening.whiten(df, models)).collect()


def brute(vectors, k=8):
    x = np.floor(np.array(vectors, dtype=float) * 1024).astype(object) + 100000
    x = np.array([[int(v) for v in row] for row in x], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = n * x - s
    z = (y / n).astype(float)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return [int((row * row).sum()) for row in y], z @ axes / np.sqrt(values), values / np.trace(z.T @ z / n)


@pytest.mark.parametrize("case", ["plain", "equal", "cluster", "rank one", "graded", "zero", "single", "big"])
def test_eigenpairs(case):
    rng = np.random.default_rng(3)
    n = {"single": 1, "big": 150}.get(case, 40)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {"equal": np.ones(n), "cluster": 1 + 1e-13 * np.arange(n), "rank one": np.r_[5.0, np.zeros(n - 1)], "graded": 10.0 ** -np.arange(n, dtype=float),
              "zero": np.zeros(n)}.get(case, rng.random(n))
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, axes = leading_eigenpairs(a, 8)
    k, size = min(8, n), np.max(np.abs(a)) or 1.0
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-14 * n * size)
    assert np.max(np.abs(a @ axes - axes * got)) <= 1e-14 * n * size
    assert np.max(np.abs(axes.T @ axes - np.eye(k))) <= 1e-13 * n


def test_query_matches_numpy(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, white, share = brute([r.embedding for r in rows])
    got = {}
    for r in op11_whitening(spark, SF_SMALL).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows) and all(sorted(g) == list(range(1, 9)) for g in got.values())
    mine = np.array([[got[r.vec_id][k].whitened for k in range(1, 9)] for r in rows])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.max(np.abs(mine - white * sign)) < 1e-9
    one = got[rows[0].vec_id]
    assert one[1].n == len(rows) and one[1].identity_error < 1e-9
    assert np.allclose([one[k].explained for k in range(1, 9)], share, rtol=1e-9)
    assert [got[r.vec_id][1].deviation for r in rows] == deviation


def test_unusable_vectors_repeats_and_dimensions(spark):
    rng = random.Random(5)
    good = [(i % 7 if i else None, [rng.gauss(0, 1) for _ in range(3)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1e300, 0.0, 0.0])]
    models, out = run(spark, good + bad + [(200, [1.0, 2.0])])
    assert sorted(models) == [2, 3] and models[3].n == 40
    assert {r.vec_id for r in out} == {g[0] for g in good} | {200}
    assert len(out) == 40 * 3 + 2
    deviation, white, _ = brute([v for _, v in good])
    want = sorted((i if i is not None else -1, d) for (i, _), d in zip(good, deviation))
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.deviation) for r in out if r.component == 1 and r.vec_id != 200) == want
    # One vector has no variance: projected to 0.
    assert [(r.whitened, r.explained, r.identity_error) for r in out if r.vec_id == 200] == [(0.0, 0.0, 0.0)] * 2
    assert all(r.identity_error < 1e-9 for r in out)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2 ** 40 + i), -float(3 ** 20) * i]) for i in range(6)]
    df = spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)
    models = whitening.fit_whitening(df)
    deviation, _, _ = brute([v for _, v in rows], 2)
    got = {r.vec_id: r for r in whitening.whiten(df, models).collect()}
    assert [int(got[i].deviation) for i in range(6)] == deviation
    flat = {r.vec_id: r.deviation for r in whitening.component_rows(whitening.whiten(df, models)).collect()}
    assert [flat[i] for i in range(6)] == [d if d < 2 ** 63 else None for d in deviation]


def test_few_vectors_and_empty_table(spark):
    _, out = run(spark, [(1, [0.5] * 10), (2, [0.5] * 9 + [0.25])])
    assert sorted((r.component, abs(round(r.whitened, 9))) for r in out if r.vec_id == 1) == [(1, 1.0)] + [(k, 0.0) for k in range(2, 9)]
    assert run(spark, []) == ({}, [])
    assert run(spark, [(1, None), (2, [])]) == ({}, [])
