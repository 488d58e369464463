"""Vector plans: KNN (cosine / dot), next-track, hit rate, near duplicates,
and the multi-class metrics built on neighbour and centroid predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.common import arr_text, r6, round_even
from quiver.functions import vectors as vf
from quiver.operators import knn, metrics
from quiver.plans.playlists import _pairs
from quiver.plans.registry import plan
from quiver.plans.sqlparts import SEQUENCES, VECTORS, with_
from quiver.sources.tables import item_vectors

NV = """
nv AS (SELECT item_id, label,
              list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS v FROM vectors)"""

PAIRS = """
pairs AS (SELECT a.item_id AS query_id, b.item_id, round(list_inner_product(a.v, b.v), 6) AS score
          FROM nv a JOIN nv b ON a.item_id <> b.item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
           FROM pairs)"""


@plan("knn_cosine", with_(VECTORS, NV, PAIRS) + " SELECT query_id, item_id, score, rank FROM ranked WHERE rank <= 10")
def q_knn_cosine(spark, sf):
    """10 nearest items of every item by cosine, self excluded, ties by id."""
    return knn.knn_cosine(item_vectors(spark, sf), k=10)


@plan("near_duplicates", with_(VECTORS, NV, PAIRS) + """
SELECT query_id, item_id, score, rank FROM ranked WHERE score >= 0.35""")
def q_near_duplicates(spark, sf):
    """Every ordered pair of distinct items with cosine >= 0.35 (no partner cap)."""
    return knn.near_duplicates(item_vectors(spark, sf), 0.35)


@plan("topk_dot", with_(SEQUENCES, VECTORS) + """,
q AS (SELECT DISTINCT track_sequence[-1] AS query_id FROM seqs),
qv AS (SELECT q.query_id, coalesce(v.vec, list_transform(range(64), lambda x: 0.0::DOUBLE)) AS qvec
       FROM q LEFT JOIN vectors v ON q.query_id = v.item_id),
pairs AS (SELECT qv.query_id, i.item_id, round(list_inner_product(qv.qvec, i.vec), 6) AS score
          FROM qv JOIN vectors i ON true),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
           FROM pairs)
SELECT query_id, item_id, score, rank FROM ranked WHERE rank <= 10""")
def q_topk_dot(spark, sf):
    """Inner-product top-10 for every target track, self kept, unknown -> zero vector."""
    targets = _pairs(spark, sf).select(F.col("track_test_y").alias("query_id")).distinct()
    return knn.topk_dot(item_vectors(spark, sf), targets, k=10)


def _next_track_sql(k: int) -> str:
    return with_(SEQUENCES, VECTORS, NV) + f""",
items AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS ord, v FROM nv),
last AS (SELECT playlist_id, track_sequence[-2] AS query_item0, track_sequence[-1] AS track_test_y FROM seqs),
chosen AS (
  SELECT l.playlist_id, l.track_test_y,
         CASE WHEN i.item_id IS NOT NULL THEN l.query_item0 ELSE fb.item_id END AS query_item
  FROM last l LEFT JOIN items i ON l.query_item0 = i.item_id
  LEFT JOIN items fb ON fb.ord = (('0x' || substr(md5(l.playlist_id || '42'), 1, 8))::BIGINT
                                  % (SELECT COUNT(*) FROM items)) + 1),
pairs AS (SELECT a.item_id AS query_item, b.item_id, round(list_inner_product(a.v, b.v), 6) AS score
          FROM (SELECT DISTINCT query_item FROM chosen) q JOIN items a ON a.item_id = q.query_item
          JOIN items b ON b.item_id <> a.item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_item ORDER BY score DESC, item_id) AS rank
           FROM pairs),
preds AS (SELECT query_item, list(item_id ORDER BY rank) AS predictions FROM ranked
          WHERE rank <= {k} GROUP BY query_item),
hits AS (SELECT c.playlist_id, c.query_item, c.track_test_y, p.predictions,
                CASE WHEN list_contains(p.predictions, c.track_test_y) THEN 1 ELSE 0 END AS hit
         FROM chosen c LEFT JOIN preds p ON c.query_item = p.query_item)"""


@plan("next_track", _next_track_sql(10) + """
SELECT playlist_id, query_item, track_test_y, array_to_string(predictions, '>') AS predictions, hit FROM hits""")
def q_next_track(spark, sf):
    """Last input item -> 10 nearest tracks; hit when the held-out track is among them."""
    nt = knn.next_track(_pairs(spark, sf), item_vectors(spark, sf), k=10)
    return nt.select("playlist_id", "query_item", "track_test_y", arr_text("predictions").alias("predictions"),
                     metrics.hit("predictions", "track_test_y").alias("hit"))


@plan("hit_rate", _next_track_sql(100) + """
SELECT round(avg(hit::DOUBLE), 6) AS hit_rate, COUNT(*) AS n FROM hits""")
def q_hit_rate(spark, sf):
    """Hit rate@100 of next-track prediction over all sequences."""
    nt = knn.next_track(_pairs(spark, sf), item_vectors(spark, sf), k=100)
    hr = metrics.hit_rate(nt, "predictions", "track_test_y")
    return hr.select(r6("hit_rate").alias("hit_rate"), "n")


NN_LABEL = """
nn1 AS (SELECT r.query_id AS item_id, q.label AS truth, b.label AS pred
        FROM ranked r JOIN nv q ON q.item_id = r.query_id JOIN nv b ON b.item_id = r.item_id
        WHERE r.rank = 1)"""


def _nn_labels(spark, sf):
    v = item_vectors(spark, sf)
    nn = knn.knn_cosine(v, k=1)
    lab = v.select("item_id", "label")
    return (nn.join(lab.withColumnRenamed("item_id", "query_id").withColumnRenamed("label", "truth"), "query_id")
              .join(lab.withColumnRenamed("label", "pred"), "item_id")
              .select(F.col("query_id").alias("item_id"), "truth", "pred"))


@plan("multiclass_metrics", with_(VECTORS, NV, PAIRS, NN_LABEL) + """,
per AS (
  SELECT c AS cls,
         (SELECT COUNT(*) FROM nn1 WHERE truth = c) AS support,
         (SELECT COUNT(*) FROM nn1 WHERE pred = c) AS npred,
         (SELECT COUNT(*) FROM nn1 WHERE pred = c AND truth = c) AS tp
  FROM (SELECT truth AS c FROM nn1 UNION SELECT pred FROM nn1)),
pr AS (SELECT *, CASE WHEN npred > 0 THEN tp / npred ELSE 0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr)
SELECT round_even(sum(r * support) / sum(support), 6) AS accuracy,
       round_even(sum(p * support) / sum(support), 6) AS precision,
       round_even(sum(r * support) / sum(support), 6) AS recall,
       round_even(sum(f1 * support) / sum(support), 6) AS f1_score FROM f""")
def q_multiclass_metrics(spark, sf):
    """Weighted accuracy/precision/recall/F1 of nearest-neighbour labels, 6 decimals half-even."""
    m = metrics.multiclass_metrics(_nn_labels(spark, sf), "pred", "truth")
    return m.select(*[round_even(c, 6).alias(c) for c in m.columns])


@plan("confusion_matrix", with_(VECTORS, NV, PAIRS, NN_LABEL) + """,
classes AS (SELECT DISTINCT label AS class_id, 'class_' || label AS class_name FROM nv)
SELECT t.class_name AS true_class, p.class_name AS pred_class, COUNT(nn1.item_id) AS n
FROM classes t JOIN classes p ON true
LEFT JOIN nn1 ON nn1.truth = t.class_id AND nn1.pred = p.class_id
GROUP BY t.class_name, p.class_name""")
def q_confusion_matrix(spark, sf):
    """Class x class grid of nearest-neighbour predictions with counts."""
    v = item_vectors(spark, sf)
    classes = v.select(F.col("label").alias("class_id")).distinct().withColumn(
        "class_name", F.concat(F.lit("class_"), F.col("class_id").cast("string")))
    return metrics.confusion_matrix(_nn_labels(spark, sf), "pred", "truth", classes)


CENTROIDS = """
ex AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM nv),
cen AS (SELECT label, list(m ORDER BY pos) AS c
        FROM (SELECT label, pos, avg(x) AS m FROM ex GROUP BY label, pos) GROUP BY label),
cs AS (SELECT nv.item_id, nv.label AS truth, cen.label AS cls,
              round(list_inner_product(nv.v, cen.c) / sqrt(list_inner_product(cen.c, cen.c)), 6) AS score
       FROM nv JOIN cen ON true)"""


def _class_scores(spark, sf):
    return vf.centroid_scores(item_vectors(spark, sf), "item_id", "vec", "label")


@plan("multiclass_auroc", with_(VECTORS, NV, CENTROIDS) + """,
bys AS (SELECT cls, score, count(*) FILTER (WHERE truth = cls) AS p,
               count(*) FILTER (WHERE truth <> cls) AS q FROM cs GROUP BY cls, score),
run AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY cls ORDER BY score
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM bys),
per AS (SELECT cls, sum(p * (below + q / 2.0)) / (sum(p) * sum(q)) AS auc, sum(p) AS npos
        FROM run GROUP BY cls)
SELECT round(sum(auc * npos) / sum(npos), 6) AS roc_auc FROM per""")
def q_multiclass_auroc(spark, sf):
    """One-vs-rest AUROC of cosine-to-class-centroid scores, support weighted."""
    s = _class_scores(spark, sf)
    return metrics.multiclass_auroc(s, "cls", "score", "truth").select(r6("roc_auc").alias("roc_auc"))


@plan("softmax_argmax", with_(VECTORS, NV, CENTROIDS) + """,
mx AS (SELECT item_id, max(score) AS m FROM cs GROUP BY item_id),
e AS (SELECT cs.item_id, cs.cls, exp(cs.score - mx.m) AS e FROM cs JOIN mx USING (item_id)),
p AS (SELECT item_id, cls, e / sum(e) OVER (PARTITION BY item_id) AS prob FROM e),
top AS (SELECT item_id, arg_max(cls, prob) AS pred, max(prob) AS pmax, sum(prob) AS psum FROM p GROUP BY item_id)
SELECT item_id, CASE WHEN abs(psum - 1.0) <= 1e-6 THEN pred ELSE NULL END AS pred,
       round(pmax, 6) AS max_prob FROM top""")
def q_softmax_argmax(spark, sf):
    """Softmax over class scores, arg-max class, sum-to-one check."""
    probs = vf.class_probabilities(_class_scores(spark, sf), "item_id", "cls", "score")
    out = vf.argmax_with_check(probs, "probs", "classes")
    return out.select("item_id", "pred", r6("max_prob").alias("max_prob"))


@plan("log_loss", with_(VECTORS, NV, CENTROIDS) + """,
mx AS (SELECT item_id, max(score) AS m FROM cs GROUP BY item_id),
e AS (SELECT cs.item_id, cs.truth, cs.cls, exp(cs.score - mx.m) AS e FROM cs JOIN mx USING (item_id)),
p AS (SELECT item_id, truth, cls, e / sum(e) OVER (PARTITION BY item_id) AS prob FROM e)
SELECT round(avg(-ln(least(greatest(prob, 1e-7), 1 - 1e-7))), 6) AS log_loss FROM p WHERE cls = truth""")
def q_log_loss(spark, sf):
    """Categorical cross-entropy of the softmax class probabilities (clipped 1e-7)."""
    probs = vf.class_probabilities(_class_scores(spark, sf), "item_id", "cls", "score")
    truth = item_vectors(spark, sf).select("item_id", "label")
    d = probs.join(truth, "item_id").withColumn("_idx", F.array_position("classes", F.col("label")) - 1)
    return metrics.categorical_log_loss(d, "probs", "_idx").select(r6("log_loss").alias("log_loss"))


@plan("two_head_loss", with_(VECTORS, NV, CENTROIDS) + """,
mx AS (SELECT item_id, max(score) AS m FROM cs GROUP BY item_id),
e AS (SELECT cs.item_id, cs.truth, cs.cls, exp(cs.score - mx.m) AS e FROM cs JOIN mx USING (item_id)),
p AS (SELECT item_id, truth, cls, e / sum(e) OVER (PARTITION BY item_id) AS prob FROM e),
h AS (SELECT item_id, any_value(truth) AS truth, sum(prob) FILTER (cls = truth) AS own, sum(prob) FILTER (cls % 2 = 1) AS odd
      FROM p GROUP BY item_id),
c AS (SELECT truth, least(greatest(own, 1e-7), 1 - 1e-7) AS own, least(greatest(coalesce(odd, 0), 1e-7), 1 - 1e-7) AS odd FROM h)
SELECT round(avg(-ln(own)), 6) AS class_loss, round(avg(-ln(CASE WHEN truth % 2 = 1 THEN odd ELSE 1 - odd END)), 6) AS flag_loss,
       round(avg(-ln(own)) + avg(-ln(CASE WHEN truth % 2 = 1 THEN odd ELSE 1 - odd END)), 6) AS loss FROM c""")
def q_two_head_loss(spark, sf):
    """Class head and binary head (odd class or not), their cross-entropies and the sum."""
    probs = vf.class_probabilities(_class_scores(spark, sf), "item_id", "cls", "score")
    pairs = F.arrays_zip(F.col("classes").alias("c"), F.col("probs").alias("p"))
    odd = F.aggregate(F.filter(pairs, lambda e: e["c"] % 2 == 1), F.lit(0.0), lambda a, e: a + e["p"])
    truth = item_vectors(spark, sf).select("item_id", "label")
    d = probs.select("item_id", "classes", "probs", odd.alias("odd")).join(truth, "item_id").select(
        "probs", "odd", (F.array_position("classes", F.col("label")) - 1).alias("index"), (F.col("label") % 2).alias("flag"))
    out = metrics.two_head_loss(d, "probs", "index", "odd", "flag")
    return out.select(*[r6(c).alias(c) for c in out.columns])


@plan("flatten_image", """
SELECT vec_id, len(embedding) AS n_pixels, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / 255)), 6) AS total
FROM embeddings""")
def q_flatten_image(spark, sf):
    """Images of 8-pixel rows flattened to one vector, pixels scaled by 1/255."""
    from quiver.sources.tables import read_table
    e = read_table(spark, sf, "embeddings")
    v = F.col("embedding")
    starts = F.filter(F.sequence(F.lit(0), F.size(v)), lambda i: (i % 8 == 0) & (i < F.size(v)))
    image = e.select("vec_id", F.transform(starts, lambda i: F.slice(v, i + 1, F.lit(8))).alias("image"))
    flat = image.select("vec_id", vf.flatten_image("image").alias("f"))
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + x)
    return flat.select("vec_id", F.size("f").cast("long").alias("n_pixels"), r6(total).alias("total"))


@plan("fallback_guess", with_(VECTORS, NV, CENTROIDS) + """,
mx AS (SELECT item_id, max(score) AS m FROM cs GROUP BY item_id),
e AS (SELECT cs.item_id, cs.cls, exp(cs.score - mx.m) AS e FROM cs JOIN mx USING (item_id)),
p AS (SELECT item_id, cls, CASE WHEN cls = 0 THEN 0.0 ELSE e / sum(e) OVER (PARTITION BY item_id) END AS prob FROM e),
top AS (SELECT item_id, list(cls ORDER BY cls) AS classes, list(prob ORDER BY cls) AS probs, max(prob) AS m, sum(prob) AS total
        FROM p GROUP BY item_id)
SELECT item_id, abs(total - 1.0) > 0.1 AS fallback,
       CASE WHEN abs(total - 1.0) <= 0.1 THEN classes[list_position(probs, m)]
            ELSE classes[(('0x' || substr(md5(item_id || '42'), 1, 8))::BIGINT % len(classes)) + 1] END AS pred
FROM top""")
def q_fallback_guess(spark, sf):
    """A model that lost class 0: arg-max where the rest still sums to 1 within 0.1, else a
    seeded guess."""
    probs = vf.class_probabilities(_class_scores(spark, sf), "item_id", "cls", "score")
    lost = F.zip_with("classes", "probs", lambda c, p: F.when(c == 0, F.lit(0.0)).otherwise(p))
    out = vf.argmax_or_guess(probs.select("item_id", "classes", lost.alias("probs")), "probs", "classes", "item_id", tol=0.1)
    return out.select("item_id", "fallback", "pred")


@plan("class_distribution", "SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label")
def q_class_distribution(spark, sf):
    """Items per class."""
    from quiver.operators.profile import class_distribution
    from quiver.sources.tables import read_table
    return class_distribution(read_table(spark, sf, "embeddings"), "label")


@plan("onehot_check", """
SELECT COUNT(*) AS n_rows,
       coalesce(bool_and(list_sum(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1.0 ELSE 0.0 END)) = 1.0),
                true) AS all_valid FROM embeddings""")
def q_onehot_check(spark, sf):
    """One-hot encode labels (10 classes) and check every vector sums to 1."""
    from quiver.operators.profile import onehot_check
    from quiver.sources.tables import read_table
    e = read_table(spark, sf, "embeddings")
    return onehot_check(e.select(vf.one_hot("label", 10).alias("y")), "y")
