"""Power-law fit: every row and the best one against numpy, and how few distances the bounds leave."""

import numpy as np
import pytest

from quiver.operators import powerlaw


def _brute(values):
    x, m = np.unique(np.asarray(values, np.float64), return_counts=True)
    out = []
    for xmin in x[:-1]:
        t, k = x[x >= xmin], m[x >= xmin]
        n = k.sum()
        alpha = 1 + n / (k * np.log(t / (xmin - 0.5))).sum()
        fit = 1 - ((t + 0.5) / (xmin - 0.5)) ** (1 - alpha)
        out.append((int(xmin), int(n), alpha, np.abs(np.cumsum(k) / n - fit).max()))
    return out


def _table(spark, values):
    return spark.createDataFrame([(None if v is None else int(v),) for v in values], "f long").repartition(3)


def _values(n=6000, seed=2):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.zipf(1.8, n) % 10_000_000, rng.integers(1, 40, n // 3)]).clip(1)


@pytest.mark.parametrize("chunk", [3, 64, 2048])
def test_every_row_matches_numpy(spark, monkeypatch, chunk):
    monkeypatch.setattr(powerlaw, "_CHUNK", chunk)
    values = _values(600)
    want = _brute(values)
    got = sorted(tuple(r) for r in powerlaw.powerlaw_fit(_table(spark, [*values, None]), "f").collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:4] for g in got], [w[2:] for w in want], rtol=1e-9)
    assert [g[0] for g in got if g[4]] == [min(want, key=lambda w: (w[3], w[0]))[0]]


def test_the_best_row_by_bounds(spark):
    values = _values(20_000)
    want = min(_brute(values), key=lambda w: (w[3], w[0]))
    stats = {}
    got = powerlaw.best_powerlaw(_table(spark, values), "f", checkpoints=100, first=4, stats=stats).collect()
    assert len(got) == 1 and got[0].xmin == want[0] and got[0].n_tail == want[1]
    assert got[0].ks == pytest.approx(want[3], rel=1e-9)
    assert stats["candidates"] > 200 and stats["full"] < 0.2 * stats["candidates"]


def test_few_frequencies(spark):
    assert powerlaw.powerlaw_fit(_table(spark, []), "f").collect() == []
    assert powerlaw.powerlaw_fit(_table(spark, [3, 3, None]), "f").collect() == []
    assert powerlaw.best_powerlaw(_table(spark, [3]), "f").collect() == []
    assert [r.xmin for r in powerlaw.best_powerlaw(_table(spark, [1, 1, 5]), "f").collect()] == [1]
