"""Item vectors from co-occurrence, with nothing per item on the driver.

Items that stand near each other in a sequence are counted in pairs; the counts become
shifted positive pointwise mutual information, a sparse symmetric matrix of rows (item,
other, weight). Its leading eigenvectors are found by subspace iteration from a random
start: a step multiplies the matrix with a tall table of a few columns (a join and a sum,
both in the JVM), then makes the columns orthonormal. The driver sees Gram matrices of
``columns x columns`` numbers only; matrix and vectors stay distributed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin
from quiver.operators.sequences import ordered_chunks


def windowed_pairs(df: DataFrame, key: str, order_col: str, item_col: str, window: int = 10, min_count: int = 3,
                   chunk_size: int = 10_000) -> DataFrame:
    """(item, other, n): how often two different items stand at most ``window`` places apart in
    a key's order, both ways round. Items with fewer than ``min_count`` rows are taken out first.

    Sequences are read as chunk rows; a chunk is followed by the first items of the next one."""
    often = df.where(F.col(item_col).isNotNull()).groupBy(item_col).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= min_count)
    rows = df.join(often.select(item_col), item_col, "left_semi").select(F.col(key).alias("_key"), order_col, F.col(item_col).cast("string").alias("item"))
    chunks = pin(ordered_chunks(rows, "_key", order_col, ["item"], max(chunk_size, window)))
    head = chunks.select(F.col("_key").alias("_k"), (F.col("chunk") - 1).alias("_c"), F.slice("item_list", 1, window).alias("more"))
    both = chunks.join(head, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("chunk") == F.col("_c")), "left")
    own, size = F.col("item_list"), F.size("item_list")
    wide = F.concat(own, F.coalesce("more", F.array().cast("array<string>")))
    steps = [F.arrays_zip(F.slice(own, 1, F.greatest(F.least(size, F.size(wide) - k), F.lit(0))).alias("a"),
                          F.slice(wide, k + 1, F.greatest(F.least(size, F.size(wide) - k), F.lit(0))).alias("b"))
             for k in range(1, window + 1)]
    one_way = both.select(F.explode(F.concat(*steps)).alias("p")).select("p.*").toDF("a", "b").where(F.col("a") != F.col("b"))
    counted = one_way.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    turned = counted.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    return counted.unionByName(turned).groupBy(F.col("a").alias("item"), F.col("b").alias("other")).agg(F.sum("n").alias("n"))


def shifted_ppmi(pairs: DataFrame, shift: float = 1.0) -> DataFrame:
    """(item, other, weight): max(0, ln(n * total / (n_item * n_other)) - ln(shift)), zeros left out."""
    per = pairs.groupBy("item").agg(F.sum("n").alias("n_item"))
    total = pairs.select(F.sum("n")).scalar()
    other = per.select(F.col("item").alias("other"), F.col("n_item").alias("n_other"))
    weight = F.log(F.col("n") * total.cast("double") / (F.col("n_item").cast("double") * F.col("n_other"))) - float(np.log(shift))
    return (pairs.join(per, "item").join(other, "other").select("item", "other", weight.alias("weight"))
            .where(F.col("weight") > 0))


def _rows(batch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def cross_gram(df: DataFrame, left: str, right: str, width: int) -> np.ndarray:
    """Sum over rows of the outer product of two array columns, added up cell by cell."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            total += _rows(batch, left, width).T @ _rows(batch, right, width)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(width * width), "v": total.reshape(-1)})

    columns = [left] if left == right else [left, right]
    got = df.select(*columns).mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(width * width)
    out[got["cell"].to_numpy()] = got["v"].to_numpy()
    return out.reshape(width, width)


def times(rows: DataFrame, basis: np.ndarray, name: str = "y") -> DataFrame:
    """(item, y @ basis)."""
    width = basis.shape[0]

    def run(batches):
        for batch in batches:
            y = np.ascontiguousarray(_rows(batch, name, width) @ basis)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("item"), lists], names=["item", name])

    return rows.select("item", name).mapInArrow(run, f"item string, {name} array<double>")


def _orthonormal(rows: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The rows with their columns made orthonormal; columns without weight are dropped."""
    e, v = np.linalg.eigh(cross_gram(rows, "y", "y", width))
    keep = e > 1e-12 * max(e.max(initial=0), 1e-300)
    return times(rows, v[:, keep] / np.sqrt(e[keep])), int(keep.sum())


def multiply(matrix: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(item, y): the matrix rows (item, other, weight) times the table (item, y)."""
    table = rows.select(F.col("item").alias("other"), *[F.col("y")[k].alias(f"y{k}") for k in range(width)])
    summed = matrix.join(table, "other").groupBy("item").agg(*[F.sum(F.col("weight") * F.col(f"y{k}")).alias(f"y{k}") for k in range(width)])
    return summed.select("item", F.array(*[f"y{k}" for k in range(width)]).alias("y"))


def leading_vectors(matrix: DataFrame, size: int, spare: int = 8, steps: int = 3, seed: int = 42) -> DataFrame:
    """(item, vec): the ``size`` largest positive eigenvalues' vectors of a symmetric matrix of
    rows (item, other, weight), times the root of the eigenvalue; ``steps`` subspace iterations."""
    matrix = pin(matrix)
    width = size + spare
    start = [(F.pmod(F.xxhash64("item", F.lit(seed), F.lit(k)), F.lit(1 << 20)) / F.lit(float(1 << 19)) - 1.0) for k in range(width)]
    rows = pin(matrix.select("item").distinct().select("item", F.array(*start).alias("y")))
    for _ in range(steps):
        rows, width = _orthonormal(pin(multiply(matrix, rows, width)), width)
        if not width:
            return rows.select("item", F.col("y").alias("vec")).limit(0)
        rows = pin(rows)
    image = multiply(matrix, rows, width).withColumnRenamed("y", "z")
    b = cross_gram(rows.join(image, "item").select("y", "z"), "y", "z", width)
    e, v = np.linalg.eigh((b + b.T) / 2)
    best = [k for k in np.argsort(-e)[:size] if e[k] > 1e-9 * max(e.max(), 1e-300)]
    return times(rows, v[:, best] * np.sqrt(e[best])).select("item", F.col("y").alias("vec"))


def cooccurrence_embeddings(df: DataFrame, key: str, order_col: str, item_col: str, vector_size: int = 48, window: int = 10,
                            min_count: int = 3, shift: float = 1.0, seed: int = 42) -> DataFrame:
    """(item_id, vec) from the rows of ordered sequences. Items that never stand near
    another one have no vector; an empty table gives an empty result."""
    pairs = pin(windowed_pairs(df, key, order_col, item_col, window, min_count))
    found = leading_vectors(shifted_ppmi(pairs, shift), vector_size, seed=seed)
    return found.select(F.col("item").alias("item_id"), "vec")
