"""Document quality by Bradley-Terry pairwise ranking.

Every text gives a small vector of surface features (shares of character classes, word and
line statistics) and their squares, standardised over all documents. From labelled
documents preference pairs (a good one, a bad one) are drawn; a weight vector is fitted by
logistic loss on the pairs' feature differences (Newton steps with an L2 penalty). The raw
score of a document is its weighted feature sum; the threshold is the quantile of the
training scores that rejects the share of bad documents seen in training, and scores are
shifted so that the threshold lies at ``cut``.

Every labelled training row is learned from: each row of the commoner kind is paired at
least once with one of the other kind, each of those at least once in turn, and at least
``pairs`` pairs are made. The Newton steps are sums over the pairs, the threshold an exact
quantile over all training rows; both are taken where the rows are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import (NULL_KEY, bounded_batches, column, id_text, pin, split_words, suspects_of,
                               text_steps)
from quiver.operators.ranking import rank_by

_CLASSES = [  # bytes of each counted class
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"|", b"!", b".,;:?'\"-()",
    b"#$%&*@^~<>{}[]\\/_=+`", b" \t\r\x0b\x0c", b"\n", bytes(range(128, 256))]
_CLASS_OF = np.zeros(256, np.int64)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS_OF[list(_bytes)] = _k + 1

NAMES = ["upper_share", "lower", "digit", "pipe", "exclamation", "punctuation", "symbol", "blank", "line_ends",
         "wide", "log_words", "word_length", "long_words", "short_words", "distinct_words", "repeated_neighbours",
         "top_word", "bare_marks", "capital_words", "log_lines", "distinct_lines", "words_per_line"]


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of distinct keys, count of the commonest key) of each text."""
    n = len(offsets) - 1
    distinct, top = np.zeros(n), np.zeros(n)
    for i in range(n):
        part = np.sort(keys[offsets[i]: offsets[i + 1]])
        if len(part):
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            distinct[i] = len(at)
            top[i] = np.diff(np.append(at, len(part))).max()
    return distinct, top


def features(texts: pa.Array) -> np.ndarray:
    """(texts, len(NAMES)) float32 features; zeros for an empty text."""
    texts = texts.cast(pa.large_string())
    _, offs, data = texts.buffers()
    at = np.frombuffer(offs, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    kinds = _CLASS_OF[raw] + (len(_CLASSES) + 1) * np.repeat(np.arange(len(texts)), np.diff(at))
    counts = np.bincount(kinds, minlength=len(texts) * (len(_CLASSES) + 1)).reshape(len(texts), -1)[:, 1:]
    n = np.maximum(np.diff(at), 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)

    words, first = split_words(texts.cast(pa.string()), lower=False)
    index = words.indices.to_numpy(zero_copy_only=False)
    own = words.dictionary.cast(pa.binary()).to_pylist()
    size = np.fromiter(map(len, own), np.float64, len(own))
    lead = np.fromiter((w[0] for w in own), np.int64, len(own))
    bare = np.fromiter((not any(c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 for c in w) for w in own),
                       bool, len(own))
    lengths = size[index] if len(index) else np.zeros(0)
    n_words = np.diff(first)
    w = np.maximum(n_words, 1)
    same = np.zeros(len(index))
    same[1:] = index[1:] == index[:-1]
    same[first[:-1][n_words > 0]] = 0
    distinct, top = _distinct(index, first)

    import pyarrow.compute as pc

    lists = pc.split_pattern(texts, "\n")
    flat = lists.flatten().dictionary_encode()
    line_at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    n_lines = np.maximum(np.diff(line_at), 1)
    lines, _ = _distinct(flat.indices.to_numpy(zero_copy_only=False), line_at)
    flag = lambda v: _per_text(v[index] if len(index) else np.zeros(0), first) / w
    out = np.stack([
        counts[:, 0] / letters, *(counts[:, k] / n for k in range(1, len(_CLASSES))),
        np.log1p(n_words), _per_text(lengths, first) / w, flag((size >= 12).astype(float)),
        flag((size <= 3).astype(float)), distinct / w, _per_text(same, first) / w, top / w, flag(bare.astype(float)),
        flag(((lead >= 65) & (lead <= 90)).astype(float)), np.log1p(n_lines), lines / n_lines,
        np.log1p(n_words / n_lines)], axis=1)
    out[np.diff(at) == 0] = 0
    return out.astype(np.float32)


def fit_bradley_terry(x: np.ndarray, good: np.ndarray, pairs: int, seed: int = 7, penalty: float = 3.0,
                      steps: int = 25) -> np.ndarray:
    """Weights of the pairwise logistic loss over ``pairs`` random (good, bad) pairs."""
    w = np.zeros(x.shape[1])
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return w  # nothing to prefer: every document scores alike
    rng = np.random.default_rng(seed)
    m = max(pairs, 1)
    d = x[up[rng.integers(0, len(up), m)]] - x[down[rng.integers(0, len(down), m)]]
    return newton(lambda at: pair_sums(d, at), len(w), penalty, steps)


def pair_sums(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the pairs' log likelihood at ``w``, and its curvature."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance that the bad one is preferred
    return d.T @ p, (d * (p * (1 - p))[:, None]).T @ d


def newton(sums, width: int, penalty: float = 3.0, steps: int = 25) -> np.ndarray:
    """Weights at which the penalised loss is least; ``sums(w)`` adds up all pairs at ``w``."""
    w = np.zeros(width)
    for _ in range(steps):
        up, curve = sums(w)
        step = np.linalg.solve(curve + penalty * np.eye(width), penalty * w - up)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id's decimal text leaves no remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == 0


class Ranker:
    """A fitted scorer: standardisation, weights and threshold."""

    def __init__(self, mean, spread, weights, threshold, cut: float):
        self.mean, self.spread, self.weights = mean, spread, weights
        self.shift = float(np.log(cut / (1 - cut)) - threshold)

    @staticmethod
    def expand(x, mean, spread) -> np.ndarray:
        z = np.clip((x - mean) / spread, -6, 6)
        return np.concatenate([z, z ** 2], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.expand(x, self.mean, self.spread) @ self.weights + self.shift
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.3, folds: int = 5,
                   pairs: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, tag (xxhash64 of the text), held_out, score, predicted.

    ``labels`` has doc_id and quality (1 good, 0 bad; others ignored; an id that repeats with
    one mark counts once, an id marked both ways is not learned from); rows whose id falls
    into the held-out fold are never learned from. A null text counts as empty and is
    scored like any other; rows that repeat an id are scored each on its text; without
    labels of both kinds all documents get the same score, at the threshold (predicted 1).
    An empty table gives an empty result; other columns are never read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("tag"), "text")

    def measure(batches):
        for step in text_steps(batches, 4_000_000):
            x = features(column(step, "text"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(step, "doc_id"), "tag": column(step, "tag"),
                "x": pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))})

    measured = pin(rows.mapInArrow(measure, "doc_id long, tag long, x array<float>"), "features")

    def sums(batches):
        total = np.zeros((3, len(NAMES)))
        for batch in batches:
            x = _matrix(batch)
            total += np.stack([np.full(len(NAMES), len(x)), x.sum(0), (x ** 2).sum(0)])
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(NAMES)), "n": total[0], "s": total[1], "q": total[2]})

    stats = (measured.select("x").mapInArrow(sums, "k long, n double, s double, q double").groupBy("k")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("k").toPandas())
    n = np.maximum(stats["n"].to_numpy(), 1) if len(stats) else np.ones(len(NAMES))
    mean = (stats["s"].to_numpy() / n) if len(stats) else np.zeros(len(NAMES))
    spread = np.sqrt(np.maximum(stats["q"].to_numpy() / n - mean ** 2, 0)) + 1e-6 if len(stats) else n

    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_good"))
    marks = (marks.where("_good in (0, 1)").groupBy("_id").agg(F.min("_good").alias("_good"), F.max("_good").alias("_most"))
             .where("_good = _most").select("_id", "_good"))
    train = (measured.join(marks, F.col("doc_id") == F.col("_id")).where(~held_out(F.col("doc_id"), folds))
             .select("x", "_good", F.xxhash64("doc_id").alias("_h"), "doc_id", "tag"))
    ranked = rank_by(train, ["_good", "_h", "doc_id", "tag"], rank_col="_place")  # the bad ones first
    counted = ranked.agg(F.count_if(F.col("_good") == 0).alias("bad"), F.count_if(F.col("_good") == 1).alias("good")).first()
    weights, threshold = np.zeros(2 * len(NAMES)), 0.0  # without both kinds every document scores alike
    if counted.bad and counted.good:
        weights = newton(_pair_job(_paired(ranked, counted.bad, counted.good, pairs), mean, spread), 2 * len(NAMES))
        threshold = _threshold_of(ranked, counted.bad, Ranker(mean, spread, weights, 0.0, cut))
    model = Ranker(mean, spread, weights, threshold, cut)
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            s = shared.value.score(_matrix(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "tag": batch.column("tag"), "score": s})

    scored = measured.mapInArrow(score, "doc_id long, tag long, score double")
    return scored.select("doc_id", "tag", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def _paired(ranked: DataFrame, bad: int, good: int, pairs: int) -> DataFrame:
    """(x, y): features of a good and of a bad row, ``pairs`` rows or one for each of the
    commoner kind if that is more. Places follow the ids' hashes; row i of the commoner kind
    meets, once a round, rows of the other kind that lie evenly apart."""
    small, big = min(bad, good), max(bad, good)
    rounds = -(-max(pairs, big) // big)
    own = ranked.withColumn("_i", F.col("_place") - 1 - F.when(F.col("_good") == 1, bad).otherwise(0))
    many = F.col("_good") == (1 if good >= bad else 0)
    partner = (F.col("_i") + F.col("_r") * (small // rounds + 1)) % small
    common = own.where(many).select("x", "_i", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_r"))
    other = own.where(~many).select(F.col("_i").alias("_j"), F.col("x").alias("y"))
    met = common.select("x", partner.alias("_j")).join(other, "_j")
    return pin(met.select("x", "y") if good >= bad else met.select(F.col("y").alias("x"), F.col("x").alias("y")), "quality-pairs")


def _pair_job(paired: DataFrame, mean: np.ndarray, spread: np.ndarray):
    """``pair_sums`` over all rows of ``paired``: one scan, summed by cell of (gradient, curvature)."""
    width = 2 * len(NAMES)

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            total = np.zeros(width + width * width)
            for batch in batches:
                d = Ranker.expand(_matrix(batch), mean, spread) - Ranker.expand(_matrix(batch, "y"), mean, spread)
                up, curve = pair_sums(d, w)
                total += np.concatenate([up, curve.reshape(-1)])
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(total)), "v": total})

        got = paired.mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
        total = np.zeros(width + width * width)
        total[got["cell"].to_numpy()] = got["v"].to_numpy()
        return total[:width], total[width:].reshape(width, width)

    return sums


def _threshold_of(ranked: DataFrame, bad: int, model: Ranker) -> float:
    """``_threshold`` over all training rows: half way between the scores of rank ``bad`` and the next."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": model.expand(_matrix(batch), model.mean, model.spread) @ model.weights})

    scores = rank_by(ranked.select("x").mapInArrow(run, "raw double"), ["raw"], rank_col="_rank")
    around = [r.raw for r in scores.where(F.col("_rank").isin(bad, bad + 1)).select("raw").collect()]  # two rows
    return float(sum(around) / 2)


def _matrix(batch, name: str = "x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, len(NAMES)).astype(np.float64)


def _threshold(raw: np.ndarray, good: np.ndarray) -> float:
    """Quantile of the training scores that leaves the share of bad documents below: half
    way between the two scores around it."""
    bad = int((~good).sum())
    if not bad or bad == len(raw):
        return float(raw.min(initial=0.0))
    at = np.sort(raw)
    return float((at[bad - 1] + at[bad]) / 2)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """``docs`` with all its columns, without the rows predicted bad."""
    found = quality_scores(docs, labels, id_col=id_col, text_col=text_col, **options)
    bad = pin(found.where("predicted = 0").select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("_bad_id"),
                                                  F.col("tag").alias("_bad_tag")).distinct(), "bad-documents")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY))
    tag = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    clear, suspects = suspects_of(docs, own, bad, "_bad_id")
    return clear.unionByName(suspects.join(bad, (own == F.col("_bad_id")) & (tag == F.col("_bad_tag")), "left_anti"))
