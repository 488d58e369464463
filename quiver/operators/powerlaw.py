"""Discrete power-law fit of item frequencies.

For each candidate ``xmin`` (every distinct frequency but the largest):
``alpha = 1 + n / sum(ln(x / (xmin - 1/2)))`` over the tail x >= xmin
(Clauset, Shalizi and Newman 2009, discrete approximation), and the KS
distance between the tail's empirical CDF and the fitted CDF
``1 - ((x + 1/2) / (xmin - 1/2)) ** (1 - alpha)``. The best fit has the
smallest KS distance (ties to the smaller xmin).

One running sum over the distinct frequencies, from the largest down, gives n and alpha of
every xmin. Distances are computed for chunks of candidates against chunks of frequencies
that Spark brings together, so neither the table nor a candidate's tail has to fit anywhere.
``best_powerlaw`` looks at few distances: the largest gap at a bounded number of checkpoints
is a lower bound of a candidate's distance, and only candidates whose bound is below the
best distance found so far are computed in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin, running_sums

_CHUNK = 2048  # frequencies or candidates of one array
_CHECKPOINTS = 512
_FIRST = 32  # candidates computed in full before the others are ruled out

SCHEMA = "xmin long, n_tail long, alpha double, ks double"


def fitted_tails(freq: DataFrame, col: str) -> DataFrame:
    """One row per distinct frequency x: m, chunk, upto (items with at most x), n_tail and alpha
    of the tail from x on."""
    counts = freq.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("long").alias("x")).agg(F.count(F.lit(1)).alias("m"))
    own = counts.withColumns({"s": F.col("m") * F.log(F.col("x").cast("double")), "one": F.lit(1)})
    sums = running_sums(own, "x", ["m", "s", "one"], descending=True)
    total = pin(sums)
    n = total.select(F.sum("m")).scalar()
    tail, logs = F.col("before_m") + F.col("m"), F.col("before_s") + F.col("s")
    return total.select(
        "x", "m", F.floor(F.col("before_one") / _CHUNK).cast("long").alias("chunk"),
        (n - F.col("before_m")).cast("long").alias("upto"), tail.cast("long").alias("n_tail"),
        (1 + tail / (logs - tail * F.log(F.col("x") - 0.5))).alias("alpha"))


def _candidates(tails: DataFrame) -> DataFrame:
    top = tails.select(F.max("x")).scalar()
    return tails.where(F.col("x") < top).select(F.col("x").alias("xmin"), "chunk", "n_tail", "alpha",
                                                (F.col("upto") - F.col("m")).alias("below"))


def _gaps(x, upto, xmin, below, n, alpha) -> np.ndarray:
    """Largest gap between the two CDFs of every candidate over the frequencies x >= xmin."""
    out = np.zeros(len(xmin))
    for at in range(0, len(xmin), 256):
        part = slice(at, at + 256)
        lo = xmin[part, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            fit = 1.0 - ((x[None, :] + 0.5) / (lo - 0.5)) ** (1.0 - alpha[part, None])
            gap = np.abs((upto[None, :] - below[part, None]) / n[part, None] - fit)
        out[part] = np.where(x[None, :] >= lo, gap, 0.0).max(axis=1, initial=0.0)
    return out


def distances(tails: DataFrame, candidates: DataFrame) -> DataFrame:
    """(xmin, ks): the exact KS distance of every candidate. Chunks are numbered from the largest
    frequency down, so a candidate meets the chunks up to its own."""
    def packed(df, columns, name):
        rows = df.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias("l"))
        return rows.select(F.col("chunk").alias(name), *[F.col(f"l.{c}").alias(c) for c in columns])

    held = packed(tails, ["x", "upto"], "chunk")
    asked = packed(candidates, ["xmin", "below", "n_tail", "alpha"], "own")
    met = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own")))).join(held, "chunk")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                of = lambda c: batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.float64)  # noqa: E731, B023
                xmin = batch.column("xmin")[k].values
                ks = _gaps(of("x"), of("upto"), of("xmin"), of("below"), of("n_tail"), of("alpha"))
                yield pa.RecordBatch.from_arrays([xmin, pa.array(ks)], names=["xmin", "ks"])

    columns = ["x", "upto", "xmin", "below", "n_tail", "alpha"]
    return met.select(*columns).mapInArrow(run, "xmin long, ks double").groupBy("xmin").agg(F.max("ks").alias("ks"))


def lower_bounds(tails: DataFrame, candidates: DataFrame, checkpoints: int = _CHECKPOINTS) -> DataFrame:
    """The candidates with ``low``: the largest gap at the checkpoints and at xmin itself. The
    checkpoints are frequencies picked evenly by place (a bounded table)."""
    picked = (tails.where(F.pmod(F.xxhash64("x"), F.greatest(F.floor(tails.select(F.count(F.lit(1))).scalar() / checkpoints), F.lit(1))) == 0)
              .orderBy(F.xxhash64("x"), "x").limit(2 * checkpoints).select("x", "upto").toPandas())
    shared = tails.sparkSession.sparkContext.broadcast((picked["x"].to_numpy(np.float64), picked["upto"].to_numpy(np.float64)))

    def run(batches):
        x, upto = shared.value
        for batch in batches:
            xmin, below, n, alpha = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                     for c in ("xmin", "below", "n_tail", "alpha"))
            low = _gaps(x, upto, xmin, below, n, alpha)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low)], names=[*batch.schema.names, "low"])

    return candidates.select("xmin", "chunk", "n_tail", "alpha", "below").mapInArrow(
        run, "xmin long, chunk long, n_tail long, alpha double, below long, low double")


def powerlaw_fit(freq: DataFrame, col: str) -> DataFrame:
    """Fit table (xmin, n_tail, alpha, ks, is_best) for positive whole frequencies in ``col``;
    NULLs are left out, fewer than two distinct frequencies give no row."""
    tails = pin(fitted_tails(freq, col))
    cand = _candidates(tails)
    scored = pin(cand.join(distances(tails, cand), "xmin").select("xmin", "n_tail", "alpha", "ks"))
    best = scored.select(F.min_by("xmin", F.struct("ks", "xmin"))).scalar()
    return scored.withColumn("is_best", F.col("xmin") == best)


def best_powerlaw(freq: DataFrame, col: str, checkpoints: int = _CHECKPOINTS, first: int = _FIRST,
                  stats: dict | None = None) -> DataFrame:
    """The best row of ``powerlaw_fit`` (xmin, n_tail, alpha, ks), most candidates ruled out by
    their bounds. ``stats``, if given, receives how many were computed in full, and of how many."""
    tails = pin(fitted_tails(freq, col))
    cand = pin(lower_bounds(tails, _candidates(tails), checkpoints))
    some = cand.orderBy("low", "xmin").limit(first)
    found = pin(some.join(distances(tails, some), "xmin"))
    least = found.select(F.min("ks")).scalar()
    rest = cand.join(found.select("xmin"), "xmin", "left_anti").where(F.col("low") <= least)
    if stats is not None:
        stats.update(full=found.count() + rest.count(), candidates=cand.count())
    both = found.unionByName(rest.join(distances(tails, rest), "xmin"))
    return both.orderBy("ks", "xmin").limit(1).select("xmin", "n_tail", "alpha", "ks")
