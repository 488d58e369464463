"""Embedding whitening by shifted CholeskyQR over integer-grid vectors.

Vectors become rows of longs (``floor(scale * entry)``); the distinct ones are the fit list,
an n x d matrix that stays distributed. One pass gives n and the exact column sums. Then
every pass centres the rows, applies the triangular solves found so far and adds up the
Gram matrix of what is left; the driver sees d x d numbers only, takes its Cholesky factor
and goes on until the rows are orthonormal. The first factor is taken of a shifted Gram
matrix, so an ill-conditioned or rank-deficient list does not break it. The composed R has
the singular values and right singular vectors of the centred matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import pin

_LIMIT = 2.0 ** 62  # scaled entries beyond have no place among longs
_UNIT = np.finfo(np.float64).eps / 2
_ROWS = 4096  # rows per step in a task


def grid_rows(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors whose entries are all present and finite, on the integer
    grid. Of vectors of several lengths those of the commonest length stay (the longer one
    on a tie); an entry beyond 2**62 / scale counts as not finite."""
    def scaled(e):
        return e.cast("double") * F.lit(float(scale))

    def fits(e):
        return F.coalesce(~F.isnan(scaled(e)) & (F.abs(scaled(e)) < _LIMIT), F.lit(False))

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fits))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).select("d").scalar()
    return rows.where(F.size("v") == length).select("vec_id", F.transform("v", lambda e: F.floor(scaled(e)).cast("long")).alias("x"))


def _steps(batches):
    """Matrices of at most _ROWS rows of x, with the batch slice they come from."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield part, x


class Centre:
    """Centring at S/n with exact whole parts: S = n * whole + rest, 0 <= rest < n."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list:
        """Sum over dimensions of (n * x - S)**2, exact; None where it passes a long."""
        near = (self(x) * self.n) ** 2
        if near.sum(axis=1).max(initial=0) < 2.0 ** 62:
            return ((self.n * (x - self.whole) - self.rest) ** 2).sum(axis=1).tolist()
        out = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 2 ** 63 else None for v in out]


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a @ inv(r) for an upper-triangular r, column by column."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def column_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(number of rows, exact sum of every dimension) of the fit list."""
    def sums(batches):
        for _, x in _steps(batches):  # 31-bit halves, so that no partial sum passes a long
            yield pa.RecordBatch.from_pydict({"k": np.arange(x.shape[1]), "n": np.full(x.shape[1], len(x)),
                                              "high": (x >> 31).sum(axis=0), "low": (x & (2 ** 31 - 1)).sum(axis=0)})

    got = (fit.select("x").mapInArrow(sums, "k long, n long, high long, low long").groupBy("k")
           .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("k").collect())
    return (got[0].n if got else 0), [(r.high << 31) + r.low for r in got]


def gram(fit: DataFrame, project, width: int) -> np.ndarray:
    """Gram matrix of the rows after ``project``, summed over tasks cell by cell."""
    at = np.triu_indices(width)

    def cells(batches):
        total = np.zeros((width, width))
        for _, x in _steps(batches):
            q = project(x)
            total += q.T @ q
        yield pa.RecordBatch.from_pydict({"cell": at[0] * width + at[1], "v": total[at]})

    got = fit.select("x").mapInArrow(cells, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(width * width)
    out[got["cell"].to_numpy()] = got["v"].to_numpy()
    upper = out.reshape(width, width)
    return upper + np.triu(upper, 1).T


def shifted_cholesky_qr(fit: DataFrame, centre: Centre, passes: int = 6) -> np.ndarray:
    """The R factor of the centred fit list: first of the shifted Gram matrix, then again of
    the rows solved by the factors so far, until their Gram matrix is the identity (or, for
    a list of less than full rank, a projector)."""
    d = len(centre.sums)
    factors: list[np.ndarray] = []
    for turn in range(passes):
        g = gram(fit, _Solved(centre, list(factors)), d)
        norm = np.linalg.norm(g, 2)
        if not norm or (turn and np.abs(g @ g - g).max() < 1e-13 * d):
            break
        factors.append(_cholesky(g, 11 * (centre.n * d + d * (d + 1)) * _UNIT * norm if not turn else 0.0, norm))
    r = np.eye(d) if factors else np.zeros((d, d))
    for f in factors:
        r = f @ r
    return r


class _Solved:
    """Rows centred and solved by each factor in turn."""

    def __init__(self, centre: Centre, factors: list[np.ndarray]):
        self.centre, self.factors = centre, factors

    def __call__(self, x: np.ndarray) -> np.ndarray:
        q = self.centre(x)
        for r in self.factors:
            q = solve_right(q, r)
        return q


def _cholesky(g: np.ndarray, shift: float, norm: float) -> np.ndarray:
    """Upper Cholesky factor of g + shift; a shift that is too small is raised until it works."""
    step = 10 * len(g) * _UNIT * norm
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift, step = shift + step, step * 10


class Whitener:
    """Centre and the first components of the fit list."""

    def __init__(self, centre: Centre, r: np.ndarray, components: int):
        _, sigma, vt = np.linalg.svd(r)
        e = sigma ** 2 / centre.n
        self.centre, self.trace = centre, float(e.sum())
        kept = min(components, int((e > 1e-14 * len(e) * max(self.trace, 0.0)).sum()))
        self.eigenvalues = e[:kept]
        self.basis = vt[:kept].T / np.sqrt(e[:kept])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.basis


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are left out; rows that
    repeat an id or a vector each give their rows, but a vector counts once in the fit. A
    component without variance (a fit list of lower rank, or of one vector) has no whitened
    values and is left out; an empty table gives an empty result. ``deviation`` is null where
    it passes 64 bits. Other columns are never read.
    """
    rows = grid_rows(vectors, scale, id_col, vec_col)
    fit = pin(rows.select("x").distinct(), "fit-list")
    n, sums = column_sums(fit)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    centre = Centre(n, sums)
    model = Whitener(centre, shifted_cholesky_qr(fit, centre), components)
    kept = len(model.eigenvalues)
    error = float(np.abs(gram(fit, model, kept) / n - np.eye(kept)).max()) if kept else 0.0
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        m = shared.value
        explained = m.eigenvalues / m.trace if kept else m.eigenvalues
        for part, x in _steps(batches):
            size = part.num_rows
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(np.repeat(np.arange(size), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), size)),
                pa.array(np.full(size * kept, n, np.int64)),
                pa.array(m.centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(size), kept))),
                pa.array(m(x).reshape(-1)), pa.array(np.tile(explained, size)),
                pa.array(np.full(size * kept, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
