"""Whitening against a dense eigendecomposition, and odd tables."""

import math

import numpy as np
import pytest

from gavelkit.llm import whitening
from gavelkit.llm.queries import QUERIES

ROWS = "vec_id bigint, embedding array<float>, x string, n int, component string, id int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in rows], ROWS)


def brute(vectors, k=4):
    x = np.floor(256 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return x, n, s, e, v, np.trace(c.T @ c / n)


def check(out, ids, vectors, k=4):
    x, n, s, e, v, trace = brute(vectors, k)
    got = {}
    for r in out:
        got.setdefault(r.vec_id, {})[r.component] = r
    for i, row in zip(ids, x, strict=True):
        assert set(got[i]) == set(range(1, min(k, x.shape[1]) + 1))
        for c, r in got[i].items():
            assert r.n == n and int(r.deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True))
            assert math.isclose(r.explained, e[c - 1] / trace, rel_tol=1e-9)
            want = (row - s / n) @ v[:, c - 1] / math.sqrt(e[c - 1])
            assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-7, abs_tol=1e-7) and r.identity_error < 1e-9
    for c in range(min(k, x.shape[1])):  # one sign for all rows
        signs = {np.sign(got[i][c + 1].whitened * ((row - s / n) @ v[:, c])) for i, row in zip(ids, x, strict=True)} - {0}
        assert len(signs) == 1


def test_equals_eigendecomposition(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(400, 12)) @ np.diag(10.0 ** -np.linspace(0, 2, 12)) + 5
    vectors = [*base.tolist(), *base[:50].tolist(), *([base[7].tolist()] * 300)]
    rows = list(enumerate(vectors))
    odd = [(9001, None), (9002, [None] * 12), (9003, [float("nan")] * 12), (9004, [float("-inf")] + [0.0] * 11), (9005, [1.0] * 3), (9006, [])]
    out = whitening.whitened(table(spark, rows + odd)).collect()
    assert len(out) == 4 * len(rows)
    check(out, [i for i, _ in rows], vectors)


def test_ill_scaled_columns(spark):
    r = np.random.default_rng(5)
    shared = r.normal(size=(300, 1))
    vectors = np.hstack([1e4 * shared, 1e4 * shared + r.normal(size=(300, 1)), 0.01 * r.normal(size=(300, 2))]).tolist()
    out = whitening.whitened(table(spark, list(enumerate(vectors)))).collect()
    x, n, s, e, v, trace = brute(vectors)
    for r_ in out:
        assert math.isclose(r_.explained, e[r_.component - 1] / trace, rel_tol=1e-4)
        assert r_.identity_error < 1e-6


def test_no_variance_and_few_dimensions(spark):
    same = whitening.whitened(table(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained == 0 and r.n == 1 and int(r.deviation) == 0 for r in same)
    flat = whitening.whitened(table(spark, [(k, [float(k), 7.0, float(-k)]) for k in range(9)])).collect()
    by = {(r.vec_id, r.component): r for r in flat}
    assert len(flat) == 27 and math.isclose(by[0, 1].explained, 1.0) and all(by[k, c].whitened is None for k in range(9) for c in (2, 3))
    assert math.isclose(sum(by[k, 1].whitened ** 2 for k in range(9)) / 9, 1.0) and by[0, 1].identity_error < 1e-9
    wide = whitening.whitened(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.5, 0.5])])).collect()
    assert len(wide) == 6 and all(r.deviation is None or r.deviation > 0 for r in wide)


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        out = whitening.whitened(table(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.collect() == []


def test_query_equals_eigendecomposition(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    good = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    out = QUERIES["op13_whitening"](spark, sf_dir)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check(out.collect(), [i for i, _ in good], [v for _, v in good])


@pytest.mark.parametrize("d", [1, 5])
def test_triangular_solve(d):
    r = np.random.default_rng(d)
    upper = np.triu(r.normal(size=(d, d))) + 3 * np.eye(d)
    x = r.normal(size=(20, d))
    assert np.allclose(whitening.solved(x, upper) @ upper, x)
