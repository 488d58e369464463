"""Whitening: components against numpy's eigenvectors, exact sums, rank deficiency, edge rows."""

import numpy as np
import pytest

from quiver.llm.common import read_table
from quiver.llm.whitening import Centre, shifted_cholesky_qr, solve_right, whiten

from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, x int, n int, component int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)


def _brute(rows, components):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} from one numpy matrix."""
    kept = [(i, [int(np.floor(256.0 * float(np.float32(e)))) for e in v]) for i, v in rows
            if v and all(e is not None and np.isfinite(e) for e in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), np.float64)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = fit - fit.sum(0) / n
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(components):
            if e[k] > 1e-9 * e.sum():
                w = (np.array(x) - fit.sum(0) / n) @ vec[:, k] / np.sqrt(e[k])
                out.setdefault((i, k + 1), []).append((n, deviation, w, e[k] / e.sum()))
    return out


def _compare(got, want):
    assert len(got) == sum(map(len, want.values()))
    signs = {}
    for r in got:
        options = want[(r.vec_id, r.component)]
        n, deviation, w, explained = min(options, key=lambda o: abs(abs(o[2]) - abs(r.whitened)))
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(abs(w), abs=1e-7, rel=1e-7)
        if abs(w) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(w) == np.sign(r.whitened))
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error <= 1e-8
    assert all(len(s) == 1 for s in signs.values())


def test_given_table_matches_numpy(spark):
    table = read_table(spark, SF001, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    _compare(whiten(table).collect(), _brute(rows, 4))


def test_left_out_rows_copies_and_low_rank(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(3, 6)) * [[4], [2], [1]]
    rows = [(i, [float(v) for v in rng.integers(-9, 9, 3) @ np.round(basis)]) for i in range(80)]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[1][1]), (81, None), (82, []), (83, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (84, [float("nan")] * 6), (85, [float("inf")] + [0.0] * 5), (86, [1.0, 2.0]), (87, [3e38] * 6), (88, [-0.0] * 6)]
    want = _brute([r for r in rows if r[0] not in (86, 87)], 4)
    assert {k for _, k in want} == {1, 2, 3}  # rank three: the fourth component has no variance
    _compare(whiten(_table(spark, rows).repartition(3)).collect(), want)


def test_large_offsets_and_tiny_spread(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in [20000 + rng.normal() * 30, rng.normal() * 0.02, rng.normal() * 500]])
            for i in range(300)]
    _compare(whiten(_table(spark, rows), components=3).collect(), _brute(rows, 3))


def test_empty_and_single(spark):
    assert whiten(_table(spark, [(1, None)])).collect() == []
    assert whiten(_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_solve_and_exact_deviation():
    rng = np.random.default_rng(2)
    r = np.triu(rng.normal(size=(5, 5))) + 4 * np.eye(5)
    a = rng.normal(size=(9, 5))
    assert np.allclose(solve_right(a, r) @ r, a)
    x = rng.integers(-2 ** 40, 2 ** 40, (4, 2))
    sums = [int(s) for s in x.sum(0)]
    assert Centre(4, sums).deviation(x) == [v if v < 2 ** 63 else None for v in (
        sum((4 * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x)]


def test_factor_is_that_of_the_centred_matrix(spark):
    rng = np.random.default_rng(8)
    x = np.unique(rng.integers(-1000, 1000, (200, 7)) * [1, 1, 1, 1, 50, 900, 1], axis=0)
    fit = spark.createDataFrame([(row,) for row in x.tolist()], "x array<long>").repartition(3)
    r = shifted_cholesky_qr(fit, Centre(len(x), [int(s) for s in x.sum(0)]))
    a = x - x.mean(0)
    assert np.allclose(r.T @ r, a.T @ a, rtol=1e-10) and np.allclose(r, np.triu(r))
