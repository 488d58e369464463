"""Bag of words and a count-based text classifier.

Tokens are exploded to (doc, term) rows and counted with partial
aggregation; document frequencies, the vocabulary cut and the classifier
weights are all aggregations. No document is collected anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.text import english_stop_words, tokens


MAX_BROADCAST_TERMS = 10_000  # a vocabulary of at most so many terms is joined by broadcast


def _without_stop_words(terms: DataFrame, stop_words=None) -> DataFrame:
    stop = english_stop_words() if stop_words is None else tuple(stop_words)
    if not stop:
        return terms
    sw = terms.sparkSession.createDataFrame([(w,) for w in stop], "term string")
    return terms.join(F.broadcast(sw), "term", "left_anti")  # fixed list, bounded size


def term_counts(docs: DataFrame, id_col: str, text_col: str, stop_words=None) -> DataFrame:
    """(doc, term, cnt) for every token of every document, stop words removed."""
    t = _without_stop_words(docs.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text_col)).alias("term")), stop_words)
    return t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("cnt"))


def _by_repeated_id(docs: DataFrame, id_col: str, most: int = 100_000) -> tuple[DataFrame | None, DataFrame | None]:
    """``docs`` in two parts: rows whose id is theirs alone, and rows that share an id (null is
    an id like any other); None for an empty part. With more than ``most`` repeated ids all
    rows count as sharing, since the ids could not be broadcast."""
    ids = docs.groupBy(F.col(id_col).alias("_rid")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = ids.filter(F.col("_n") > 1).select("_rid").limit(most + 1).checkpoint(eager=True)
    n = repeated.count()
    if not n:
        return docs, None
    if n > most:
        return None, docs
    same = docs[id_col].eqNullSafe(repeated["_rid"])
    return docs.join(F.broadcast(repeated), same, "left_anti"), docs.join(F.broadcast(repeated), same, "left_semi")


def term_statistics(docs: DataFrame, id_col: str, text_col: str, stop_words=None, label_col: str | None = None) -> DataFrame:
    """(term, df, tf): number of documents with a term and its occurrences, stop words removed;
    with ``label_col`` also n1 and n0, its occurrences in documents of label 1 and of others.

    A row's tokens are counted where the row is: of rows whose id is theirs alone only sums
    per term are shuffled. Rows that share an id are one document (once per label) and meet first."""
    alone, shared = _by_repeated_id(docs, id_col)
    label = F.lit(None).cast("int") if label_col is None else F.col(label_col)
    side = lambda n: [F.sum(F.when(F.col("_y") == 1, n).otherwise(0)).alias("n1"),
                      F.sum(F.when(F.col("_y") != 1, n).otherwise(0)).alias("n0")]
    parts = []
    if alone is not None:
        toks = F.sort_array(tokens(text_col))
        own = alone.select(label.alias("_y"), toks.alias("_t")).select("_y", F.posexplode(F.transform(
            "_t", lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get("_t", i - 1) != t)).alias("first")))).alias("_i", "_e"))
        own = _without_stop_words(own.select("_y", "_e.term", "_e.first"), stop_words)
        parts.append(own.groupBy("term").agg(F.count_if("first").alias("df"), F.count(F.lit(1)).alias("tf"), *side(F.lit(1))))
    if shared is not None:
        counts = term_counts(shared, id_col, text_col, stop_words).checkpoint(eager=True)
        stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("cnt").alias("tf"))
        labels = shared.select(F.col(id_col).alias("doc_id"), label.alias("_y"))
        sides = counts.join(labels, "doc_id").groupBy("term").agg(*side(F.col("cnt")))
        parts.append(stats.join(sides, "term", "left").select("term", "df", "tf", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n1", "n0")]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part).groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "tf", "n1", "n0")])
    return out.select("term", "df", "tf", *(["n1", "n0"] if label_col is not None else []))


def fit_vocabulary(docs: DataFrame, id_col: str, text_col: str, min_df: float = 0.005,
                   max_df: float = 0.75, max_features: int | None = 750, stop_words=None,
                   stats: DataFrame | None = None) -> DataFrame:
    """Terms with min_df*n <= df <= max_df*n, top ``max_features`` by
    corpus count (ties by term), indexed alphabetically from 0. ``stats``
    (from :func:`term_statistics`) avoids tokenising the documents again."""
    stats = stats if stats is not None else term_statistics(docs, id_col, text_col, stop_words)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    kept = stats.select("term", "df", "tf").filter((F.col("df") >= F.lit(min_df) * n_docs) & (F.col("df") <= F.lit(max_df) * n_docs))
    if max_features:
        kept = kept.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    # at most max_features rows: a small window is fine; pinned so every
    # later use reads the fitted table instead of refitting
    vocab = kept.withColumn("index", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    return vocab.checkpoint(eager=True)


def bow_counts(docs: DataFrame, id_col: str, text_col: str, vocab: DataFrame, stop_words=None) -> DataFrame:
    """E09 transform: sparse counts (doc, index, count) over the fitted vocabulary. Tokens
    outside it go before the shuffle, the others travel as their index."""
    v = vocab.select("term", "index")
    if v.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS:  # a measured bound
        v = F.broadcast(v)
    t = _without_stop_words(docs.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text_col)).alias("term")), stop_words)
    return t.join(v, "term").groupBy("doc_id", "index").agg(F.count(F.lit(1)).alias("count"))


@dataclass
class NaiveBayes:
    """Multinomial naive Bayes on vocabulary counts (Laplace smoothing).

    ``weights`` holds (index, w) with w = log P(t|1) - log P(t|0); ``bias`` the
    log prior ratio (a one-row DataFrame, used through a scalar subquery)."""

    vocab: DataFrame
    weights: DataFrame
    bias: DataFrame

    def score(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Probability of class 1 per document (docs without vocabulary terms get the prior)."""
        c = bow_counts(docs, id_col, text_col, self.vocab)
        s = c.join(self.weights, "index").groupBy("doc_id").agg(F.sum(F.col("count") * F.col("w")).alias("_z"))
        b = self.bias.select("bias").scalar()
        out = docs.select(F.col(id_col).alias("doc_id")).join(s, "doc_id", "left")
        z = F.coalesce(F.col("_z"), F.lit(0.0)) + b
        return out.select("doc_id", (1.0 / (1.0 + F.exp(-z))).alias("prob"))


def fit_naive_bayes(docs: DataFrame, id_col: str, text_col: str, label_col: str, vocab: DataFrame,
                    alpha: float = 1.0, stats: DataFrame | None = None) -> NaiveBayes:
    """Fit on labelled documents; ``stats`` (from :func:`term_statistics` with the label) skips re-tokenising."""
    stats = stats if stats is not None else term_statistics(docs, id_col, text_col, (), label_col)
    lab = docs.select(F.col(label_col).alias("_y"))
    per = stats.join(vocab.select("term", "index"), "term").select("index", "n1", "n0")
    full = vocab.select("index").join(per, "index", "left").fillna(0, subset=["n1", "n0"])
    v = vocab.select(F.count(F.lit(1))).scalar()
    tot1 = full.select(F.sum("n1")).scalar()
    tot0 = full.select(F.sum("n0")).scalar()
    w = full.select("index", (F.log((F.col("n1") + alpha) / (tot1 + alpha * v)) -
                              F.log((F.col("n0") + alpha) / (tot0 + alpha * v))).alias("w"))
    # log prior ratio; NULL (then 0) when one class is absent
    prior = lab.agg(F.coalesce(F.log(F.try_divide(F.count_if(F.col("_y") == 1), F.count_if(F.col("_y") != 1))),
                               F.lit(0.0)).alias("bias"))
    return NaiveBayes(vocab, w.checkpoint(eager=True), prior.checkpoint(eager=True))
