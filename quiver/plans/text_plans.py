"""Text plans: bag-of-words vocabulary and counts (E09/E10), deploy gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.common import r6
from quiver.functions.text import english_stop_words, sql_quote, sql_tokens
from quiver.operators import metrics, sampling, text
from quiver.plans.registry import plan
from quiver.plans.sqlparts import REVIEWS, with_
from quiver.sources.tables import read_table, reviews

# The two smoke-test reviews and their expected sides of 0.5.
SMOKE_REVIEWS = [
    "poor fit its baggy in places where it isn't supposed to be.",
    "love it, very high quality and great value",
]


def _stop_sql() -> str:
    return "stop AS (SELECT unnest([" + ", ".join(sql_quote(w) for w in english_stop_words()) + "]) AS term)"


def _vocab_sql(src: str, id_col: str, text_col: str, name: str = "vocab") -> str:
    return f"""
toks_{name} AS (SELECT {id_col} AS doc_id, unnest({sql_tokens(text_col)}) AS term FROM {src}),
tc_{name} AS (SELECT doc_id, term, count(*) AS cnt FROM toks_{name}
              WHERE term NOT IN (SELECT term FROM stop) GROUP BY doc_id, term),
st_{name} AS (SELECT term, count(*) AS df, sum(cnt) AS tf FROM tc_{name} GROUP BY term),
kept_{name} AS (SELECT * FROM st_{name}
           WHERE df >= 0.005::DOUBLE * (SELECT count(*) FROM {src})
             AND df <= 0.75::DOUBLE * (SELECT count(*) FROM {src})
           ORDER BY tf DESC, term LIMIT 750),
{name} AS (SELECT term, df, tf, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS index FROM kept_{name})"""


@plan("bow_vocabulary", with_(_stop_sql(), _vocab_sql("documents", "doc_id", "text")) +
      " SELECT term, df, tf, index FROM vocab")
def q_bow_vocabulary(spark, sf):
    """Vocabulary of all documents: lower-case, ASCII-folded, >= 2-char
    tokens, English stop words out, 0.005 <= df share <= 0.75, top 750 by count."""
    return text.fit_vocabulary(read_table(spark, sf, "documents"), "doc_id", "text")


@plan("bow_counts", with_(_stop_sql(), _vocab_sql("documents", "doc_id", "text")) + """
SELECT t.doc_id, v.index, t.cnt AS count FROM tc_vocab t JOIN vocab v ON t.term = v.term""")
def q_bow_counts(spark, sf):
    """E09 transform: sparse term counts of every document over the fitted vocabulary."""
    docs = read_table(spark, sf, "documents")
    vocab = text.fit_vocabulary(docs, "doc_id", "text")
    return text.bow_counts(docs, "doc_id", "text", vocab)


def _split_reviews(spark, sf):
    return sampling.split_at_positions(reviews(spark, sf), "doc_id", (0.8,), seed=42, labels=("train", "valid"))


_GATE_SQL = with_(REVIEWS, """
rr AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS rk,
              count(*) OVER () AS n FROM reviews),
train AS (SELECT * FROM rr WHERE rk <= floor(0.8::DOUBLE * n)),
valid AS (SELECT * FROM rr WHERE rk > floor(0.8::DOUBLE * n))""", _stop_sql(),
                  _vocab_sql("train", "doc_id", "review"), """
per AS (SELECT v.index, sum(t.cnt) FILTER (WHERE tr.labels = 1) AS n1,
               sum(t.cnt) FILTER (WHERE tr.labels <> 1) AS n0
        FROM tc_vocab t JOIN vocab v ON t.term = v.term JOIN train tr ON tr.doc_id = t.doc_id
        GROUP BY v.index),
fullw AS (SELECT v.index, coalesce(per.n1, 0) AS n1, coalesce(per.n0, 0) AS n0
         FROM vocab v LEFT JOIN per ON v.index = per.index),
w AS (SELECT index, ln((n1 + 1.0) / ((SELECT sum(n1) FROM fullw) + (SELECT count(*) FROM vocab)))
                  - ln((n0 + 1.0) / ((SELECT sum(n0) FROM fullw) + (SELECT count(*) FROM vocab))) AS w
      FROM fullw),
bias AS (SELECT ln(count(*) FILTER (WHERE labels = 1) / count(*) FILTER (WHERE labels <> 1)) AS b FROM train),
smoke AS (SELECT * FROM (VALUES (-1, """ + sql_quote(SMOKE_REVIEWS[0]) + "), (-2, " + sql_quote(SMOKE_REVIEWS[1]) + """))
          AS s(doc_id, review)),
todo AS (SELECT doc_id, review FROM valid UNION ALL SELECT doc_id, review FROM smoke),
ttok AS (SELECT doc_id, unnest(""" + sql_tokens("review") + """) AS term FROM todo),
tcnt AS (SELECT doc_id, term, count(*) AS cnt FROM ttok WHERE term NOT IN (SELECT term FROM stop)
         GROUP BY doc_id, term),
z AS (SELECT tcnt.doc_id, sum(tcnt.cnt * w.w) AS z FROM tcnt JOIN vocab v ON tcnt.term = v.term
      JOIN w ON w.index = v.index GROUP BY tcnt.doc_id),
prob AS (SELECT todo.doc_id, 1.0 / (1.0 + exp(-(coalesce(z.z, 0.0) + (SELECT b FROM bias)))) AS prob
         FROM todo LEFT JOIN z ON todo.doc_id = z.doc_id),
sv AS (SELECT p.prob AS score, v.labels FROM prob p JOIN valid v ON p.doc_id = v.doc_id),
bys AS (SELECT score, count(*) FILTER (WHERE labels = 1) AS p, count(*) FILTER (WHERE labels <> 1) AS q
        FROM sv GROUP BY score),
run AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS below FROM bys),
auc AS (SELECT sum(p * (below + q / 2.0)) / (sum(p) * sum(q)) AS a FROM run)""") + """
SELECT round((SELECT a FROM auc), 6) AS model_auc, 0.5::DOUBLE AS base_auc,
       (SELECT a FROM auc) > 0.5 AS beats_baseline,
       (SELECT prob FROM prob WHERE doc_id = -1) < 0.5 AS smoke_negative_ok,
       (SELECT prob FROM prob WHERE doc_id = -2) > 0.5 AS smoke_positive_ok,
       ((SELECT prob FROM prob WHERE doc_id = -1) < 0.5 AND (SELECT prob FROM prob WHERE doc_id = -2) > 0.5)
         AS passed_smoke_test,
       ((SELECT a FROM auc) > 0.5 AND (SELECT prob FROM prob WHERE doc_id = -1) < 0.5
         AND (SELECT prob FROM prob WHERE doc_id = -2) > 0.5) AS deployment_candidate"""


def fitted_model(spark, sf):
    s = _split_reviews(spark, sf)
    train = s.filter(F.col("split") == "train")
    stats = text.term_statistics(train, "doc_id", "review", label_col="labels").checkpoint(eager=True)  # tokenised once
    vocab = text.fit_vocabulary(train, "doc_id", "review", stats=stats)
    return s, text.fit_naive_bayes(train, "doc_id", "review", "labels", vocab, stats=stats)


@plan("deploy_gate", _GATE_SQL)
def q_deploy_gate(spark, sf):
    """Bag-of-words naive Bayes fitted on the train split; candidate when its
    validation AUC beats the constant baseline (0.5) and both smoke reviews land
    on the right side of 0.5."""
    s, model = fitted_model(spark, sf)
    valid = s.filter(F.col("split") == "valid")
    smoke = spark.createDataFrame([(-1, SMOKE_REVIEWS[0]), (-2, SMOKE_REVIEWS[1])], "doc_id long, review string")
    scored = model.score(valid.select("doc_id", "review").unionByName(smoke), "doc_id", "review")
    scored = scored.join(valid.select("doc_id", "labels"), "doc_id", "left").checkpoint(eager=True)
    auc = metrics.roc_auc(scored.filter(F.col("doc_id") >= 0), "prob", "labels")
    a = auc.select("roc_auc").scalar()
    p1 = scored.filter(F.col("doc_id") == -1).select("prob").scalar()
    p2 = scored.filter(F.col("doc_id") == -2).select("prob").scalar()
    return auc.select(
        r6(a).alias("model_auc"), F.lit(0.5).alias("base_auc"), (a > 0.5).alias("beats_baseline"),
        (p1 < 0.5).alias("smoke_negative_ok"), (p2 > 0.5).alias("smoke_positive_ok"),
        ((p1 < 0.5) & (p2 > 0.5)).alias("passed_smoke_test"),
        ((a > 0.5) & (p1 < 0.5) & (p2 > 0.5)).alias("deployment_candidate"))
