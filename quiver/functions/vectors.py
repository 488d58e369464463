"""Array/vector column functions (S10, S11) and centroid class scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a) -> Column:
    """Vector scaled to length 1; a zero vector stays zero (no division by zero)."""
    a = F.col(a) if isinstance(a, str) else a
    n = norm(a)
    return F.when(n == 0, a).otherwise(F.transform(a, lambda x: x / n))


def scale(a, factor: float) -> Column:
    """Element-wise scaling (e.g. /255 for pixels)."""
    a = F.col(a) if isinstance(a, str) else a
    return F.transform(a, lambda x: x * F.lit(factor))


def flatten_image(a, factor: float = 1 / 255) -> Column:
    """The rows of an image (28 x 28, say) as one flat vector (784), every pixel scaled."""
    a = F.col(a) if isinstance(a, str) else a
    return F.transform(F.flatten(a), lambda x: x.cast("double") * F.lit(factor))


def nested_scale(a, factor: float) -> Column:
    """Multiply every value of a list of lists."""
    a = F.col(a) if isinstance(a, str) else a
    return F.transform(a, lambda inner: F.transform(inner, lambda x: x * F.lit(factor)))


def one_hot(label, n: int) -> Column:
    """One-hot vector of length n for a 0-based label."""
    lab = F.col(label) if isinstance(label, str) else label
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.when(i == lab, F.lit(1.0)).otherwise(F.lit(0.0)))


def argmax(a) -> Column:
    """0-based position of the first maximum."""
    a = F.col(a) if isinstance(a, str) else a
    return F.array_position(a, F.array_max(a)) - 1


def softmax(a) -> Column:
    """Numerically stable softmax (max subtracted first)."""
    a = F.col(a) if isinstance(a, str) else a
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda x: x / s)


def centroid_scores(items: DataFrame, id_col: str, vec_col: str, label_col: str, decimals: int = 6) -> DataFrame:
    """Cosine of each unit item vector to every class centroid (mean of unit vectors).

    Centroids are aggregated per (class, position), then packed into one
    array (size = classes x dim, bounded by the class count) used as a scalar
    subquery; no item x class join is needed. Returns (item, truth, cls, score).
    """
    u = items.select(id_col, label_col, unit(vec_col).alias("_u"))
    parts = (u.select(label_col, F.posexplode("_u").alias("_pos", "_x"))
              .groupBy(label_col, "_pos").agg(F.avg("_x").alias("_m")))
    cen = (parts.groupBy(label_col)
                .agg(F.sort_array(F.collect_list(F.struct("_pos", "_m"))).alias("_l"))
                .select(F.struct(F.col(label_col).alias("cls"),
                                 F.transform("_l", lambda e: e["_m"]).alias("c")).alias("cc")))
    from quiver.operators.ranking import require_bounded

    require_bounded(cen, 10_000, "class centroids")
    packed = cen.select(F.sort_array(F.collect_list("cc"))).scalar()
    ex = u.select(F.col(id_col), F.col(label_col).alias("truth"), "_u", F.explode(packed).alias("_c"))
    scored = ex.select(id_col, "truth", F.struct(
        F.col("_c.cls").alias("cls"),
        F.round(F.try_divide(dot("_u", F.col("_c.c")), norm(F.col("_c.c"))), decimals).alias("score")).alias("_s"))
    return scored.select(id_col, "truth", "_s.cls", "_s.score")


def class_probabilities(scores: DataFrame, id_col: str, class_col: str, score_col: str) -> DataFrame:
    """Softmax over each item's class scores: (item, classes[], probs[])."""
    g = (scores.groupBy(id_col)
               .agg(F.sort_array(F.collect_list(F.struct(class_col, score_col))).alias("_l")))
    return g.select(id_col, F.transform("_l", lambda e: e[class_col]).alias("classes"),
                    softmax(F.transform("_l", lambda e: e[score_col])).alias("probs"))


def argmax_or_guess(df: DataFrame, probs_col: str, classes_col: str, id_col: str, tol: float = 1e-6, seed: int = 42) -> DataFrame:
    """Arg-max class when the probabilities sum to 1 (within ``tol``), else a class picked by
    a seeded md5 of the id; ``fallback`` tells which."""
    from quiver.functions.common import seeded_hash

    checked = argmax_with_check(df, probs_col, classes_col, tol)
    pick = F.conv(F.substring(seeded_hash([id_col], seed), 1, 8), 16, 10).cast("bigint") % F.size(classes_col)
    guess = F.element_at(F.col(classes_col), (pick + 1).cast("int"))
    return checked.withColumns({"fallback": F.col("pred").isNull(), "pred": F.coalesce("pred", guess)})


def argmax_with_check(df: DataFrame, probs_col: str, classes_col: str, tol: float = 1e-6) -> DataFrame:
    """Arg-max class when the probabilities sum to 1 (within ``tol``), else NULL."""
    total = F.aggregate(F.col(probs_col), F.lit(0.0), lambda acc, v: acc + v)
    pred = F.element_at(F.col(classes_col), (argmax(probs_col) + 1).cast("int"))
    return df.withColumns({
        "pred": F.when(F.abs(total - 1.0) <= tol, pred),
        "max_prob": F.array_max(probs_col),
    })
