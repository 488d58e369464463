"""Learning plans (rows-only checks): embeddings, ALS, text classifier,
cross-validated trees, MLP, batch and streaming scoring, 2-D projection,
and the grid search over the next-track model."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import boosting, experiments, factor, features, forest, knn, layout, learn, metrics, profile, ranking, recs, sampling, sinks
from quiver.plans.playlists import _pairs, _playlists, _sequences
from quiver.plans.purchases import split_table
from quiver.plans.registry import plan
from quiver.plans.text_plans import _split_reviews, fitted_model
from quiver.session import dropping_shuffles, shared_path
from quiver.sources.tables import item_vectors, read_table
from quiver.streaming.score_stream import stream_score


def _seq_split(spark, sf):
    s = sampling.positional_split(_sequences(spark, sf), "playlist_id", (0.7, 0.9), seed=42)
    return s.withColumn("x_last", F.element_at("track_test_x", -1))


@plan("item_embeddings")
def q_item_embeddings(spark, sf):
    """48-dim track vectors from the train split's ordered track sequences."""
    train = _seq_split(spark, sf).filter(F.col("split") == "train")
    return learn.item_embeddings(train, "track_sequence", vector_size=48, window=10, min_count=3)


@plan("w2v_hit_rate")
def q_w2v_hit_rate(spark, sf):
    """L01+L02+M09: item vectors trained on the train split's sequences, then
    next-track prediction (100 nearest, cosine) for every validation sequence
    and its hit rate@100."""
    s = _seq_split(spark, sf)
    vec = learn.item_embeddings(s.filter(F.col("split") == "train"), "track_sequence",
                                vector_size=48, window=10, min_count=3).checkpoint(eager=True)
    nt = knn.next_track(s.filter(F.col("split") == "validate"), vec, k=100)
    return metrics.hit_rate(nt, "predictions", "track_test_y")


def _pair_split(spark, sf):
    return sampling.positional_split(_pairs(spark, sf), "playlist_id", (0.7, 0.9), seed=42)


def _train_vectors(spark, sf, split):
    train = split.filter(F.col("split") == "train").select("playlist_id")
    rows = _playlists(spark, sf).select("playlist_id", "row_id", "track_id").join(train, "playlist_id", "left_semi")
    return factor.cooccurrence_embeddings(rows, "playlist_id", "row_id", "track_id", vector_size=48, window=10, min_count=3)


@plan("cooccurrence_embeddings")
def q_cooccurrence_embeddings(spark, sf):
    """48-dim track vectors from windowed co-occurrence of the train split's playlists,
    factored without a driver-side vocabulary."""
    return _train_vectors(spark, sf, _pair_split(spark, sf))


@plan("cooccurrence_hit_rate")
def q_cooccurrence_hit_rate(spark, sf):
    """L01+L02+M09: hit rate@100 of next-track prediction over the validation playlists with
    the co-occurrence vectors."""
    split = ranking.pin(_pair_split(spark, sf))
    vec = ranking.pin(_train_vectors(spark, sf, split))
    nt = knn.next_track(split.filter(F.col("split") == "validate"), vec, k=100)
    return metrics.hit_rate(nt, "predictions", "track_test_y")


@plan("grid_results")
def q_grid_results(spark, sf):
    """Grid over the skip-gram vectors' min_count (3, 5, 10): item vectors are
    trained on the train sequences for every set; hit rate@100 on the validation split; the
    best set (first on ties) is re-scored on test."""
    s = ranking.pin(_seq_split(spark, sf).select("playlist_id", "track_sequence", "x_last", "track_test_y", "split"))
    train = s.filter(F.col("split") == "train")
    rows, spaces = [], {}
    for i, mc in enumerate((3, 5, 10)):
        space = spaces[mc] = learn.item_embeddings(train, "track_sequence", vector_size=48, window=10,
                                                   min_count=mc).checkpoint(eager=True)
        nt = knn.next_track(s.filter(F.col("split") == "validate"), space, k=100)
        hr = metrics.hit_rate(nt, "predictions", "track_test_y").select(
            F.lit(i).alias("grid_pos"), F.lit(mc).alias("min_count"), "hit_rate")
        rows.append(hr)
    res = rows[0]
    for r in rows[1:]:
        res = res.unionByName(r)
    res = res.checkpoint(eager=True)
    js = experiments.python_json([("min_count", F.col("min_count")), ("k", F.lit(100))])
    res = res.withColumns({"params": js, "model_name": experiments.param_hash(js)})
    best = profile.best_by_metric(res.withColumn("_g", F.lit(1)), ["_g"], "min_count", "hit_rate", "grid_pos")
    best_mc = best.head()["best_min_count"]  # one row: the chosen parameter set
    test_nt = knn.next_track(s.filter(F.col("split") == "test"), spaces[best_mc], k=100)
    test_hr = metrics.hit_rate(test_nt, "predictions", "track_test_y").select("hit_rate").scalar()
    return res.select("grid_pos", "min_count", "params", "model_name", F.col("hit_rate").alias("validation_hit_rate"),
                      (F.col("min_count") == best_mc).alias("is_best"),
                      F.when(F.col("min_count") == best_mc, test_hr).alias("test_hit_rate"))


@plan("comparison_table")
def q_comparison_table(spark, sf):
    """Boosted models of a grid over depth and learning rate, with held-out log loss,
    accuracy and its spread over the folds, best loss first."""
    e = read_table(spark, sf, "embeddings")
    d = e.select("vec_id", (F.col("label") % 3).alias("label"), F.col("embedding").alias("features"))
    folds = ranking.pin(sampling.kfold(d, "label", "vec_id", k=3, seed=42))
    rows = None
    for depth in (1, 2):
        for rate in (0.1, 0.3):
            per = boosting.kfold_boosted(folds, "features", "label", "fold", classes=3, k=3, rounds=3, depth=depth, rate=rate)
            row = per.agg(F.avg("score").alias("accuracy"), F.stddev_pop("score").alias("spread"), F.avg("loss").alias("loss"))
            row = row.select(F.lit(depth).alias("depth"), F.lit(rate).alias("rate"), "loss", "accuracy", "spread")
            rows = row if rows is None else rows.unionByName(row)
    js = experiments.python_json([("depth", F.col("depth")), ("rate", F.col("rate"))])
    return rows.withColumns({"params": js, "model_name": experiments.param_hash(js)}).orderBy("loss", "params")


def _coded_purchases(spark, sf, cols):
    """The split purchases with user and item codes, coded once and written: the fit, the users
    and the score read them again."""
    with dropping_shuffles(spark):
        s = split_table(spark, sf, cols, written=True)
        cats = features.fit_many(s, ["customer_id", "article_id"])
        coded = cats["article_id"].transform(cats["customer_id"].transform(s, "user_code"), "item_code")
        coded = coded.drop("customer_id").withColumns({"user_code": F.col("user_code").cast("int"), "item_code": F.col("item_code").cast("int")})
        return sinks.write_and_reload(spark, coded, "coded-purchases")


@plan("als_topk")
def q_als_topk(spark, sf):
    """Implicit ALS on coded train purchases, top-10 articles per test shopper."""
    coded = _coded_purchases(spark, sf, ["article_id", "customer_id", "split"])
    train = coded.filter(F.col("split") == "train")
    test_users = coded.filter(F.col("split") == "test")
    return learn.als_topk(train, test_users, "user_code", "item_code", k=10)


@plan("als_recall_ndcg")
def q_als_recall_ndcg(spark, sf):
    """L05+D13+M10: implicit ALS fitted on coded train purchases; its top-10 for
    every test shopper scored with recall@10 and NDCG@10 against the shopper's
    first test purchase (shoppers unseen in training count as misses)."""
    coded = _coded_purchases(spark, sf, ["article_id", "customer_id", "t_dat", "split", "price", "sales_channel_id"])
    train = coded.filter(F.col("split") == "train")
    test = coded.filter(F.col("split") == "test").select("user_code", "item_code", "t_dat", "article_id", "price",
                                                        "sales_channel_id")
    first = recs.first_per_user(test, "user_code", ["t_dat", "article_id", "price", "sales_channel_id"])
    top = learn.als_topk(train, first, "user_code", "item_code", k=10)
    scored = first.join(top, "user_code", "left").withColumn(
        "items", F.coalesce("items", F.array().cast("array<int>")))
    return metrics.recall_ndcg(scored, "items", "item_code", 10)


@plan("text_classifier")
def q_text_classifier(spark, sf):
    """Bag-of-words logistic regression on the train reviews; validation
    AUC and accuracy at 0.5."""
    s = _split_reviews(spark, sf).withColumn("labels", F.col("labels").cast("double"))
    model = learn.text_pipeline("review", "labels").fit(s.filter(F.col("split") == "train"))
    pred = model.transform(s.filter(F.col("split") == "valid")).withColumn("p", learn.positive_probability())
    pred = pred.select("p", "labels").checkpoint(eager=True)  # scored once, read by both metrics
    acc = metrics.threshold_accuracy(pred, "p", "labels", 0.5).select("accuracy").scalar()
    return metrics.roc_auc(pred, "p", "labels").withColumn("accuracy", acc)


def _folded_vectors(spark, sf, n_classes=None):
    """Item vectors as (vec_id, label, features) with a stratified 5-fold id;
    ``n_classes`` folds the labels onto fewer classes (label mod n)."""
    e = read_table(spark, sf, "embeddings")
    label = F.col("label") if n_classes is None else F.col("label") % n_classes
    d = e.select("vec_id", label.alias("label"), F.col("embedding").alias("features"))
    return sampling.kfold(d, "label", "vec_id", k=5, seed=42)


def _labelled_vectors(spark, sf):
    """The same rows for Spark ML: features as its vectors, labels as doubles."""
    from pyspark.ml.functions import array_to_vector

    return _folded_vectors(spark, sf).withColumns({"label": F.col("label").cast("double"),
                                                   "features": array_to_vector(F.col("features").cast("array<double>"))})


@plan("rf_cv")
def q_rf_cv(spark, sf):
    """Random forest (10 trees), 5-fold accuracy mean +- std (x100)."""
    return experiments.fold_stats(forest.kfold_forest(_folded_vectors(spark, sf), "features", "label", "fold", k=5, trees=10))


@plan("gbt_cv")
def q_gbt_cv(spark, sf):
    """One-vs-rest boosted trees (10 rounds) on 3 classes, 5-fold accuracy."""
    folds = _folded_vectors(spark, sf, n_classes=3)
    return experiments.fold_stats(boosting.kfold_boosted(folds, "features", "label", "fold", classes=3, k=5, rounds=10, depth=5, rate=0.1,
                                                         penalty=0.0, one_vs_rest=True))


@plan("boosted_softmax_cv")
def q_boosted_softmax_cv(spark, sf):
    """One boosted model over three classes (10 rounds, softmax loss), 5-fold accuracy."""
    e = read_table(spark, sf, "embeddings")
    d = e.select("vec_id", (F.col("label") % 3).alias("label"), F.col("embedding").alias("features"))
    folds = sampling.kfold(d, "label", "vec_id", k=5, seed=42)
    return experiments.fold_stats(boosting.kfold_boosted(folds, "features", "label", "fold", classes=3, k=5, rounds=10))


@plan("mlp_baseline")
def q_mlp_baseline(spark, sf):
    """Fully connected 64-64-10 network; accuracy on the held-out fold 0."""
    d = _labelled_vectors(spark, sf)
    model = learn.mlp([64, 64, 10], max_iter=50).fit(d.filter(F.col("fold") != 0))
    pred = model.transform(d.filter(F.col("fold") == 0))
    return metrics.accuracy(pred, "prediction", "label")


@plan("batch_score")
def q_batch_score(spark, sf):
    """The text classifier saved, loaded back and used to score every document."""
    s = _split_reviews(spark, sf).withColumn("labels", F.col("labels").cast("double"))
    model = learn.text_pipeline("review", "labels").fit(s.filter(F.col("split") == "train"))
    docs = read_table(spark, sf, "documents").select(F.col("text").alias("review"))
    return learn.save_and_score(model, shared_path(spark, "text-model"), docs)


@plan("stream_batch_score")
def q_stream_batch_score(spark, sf):
    """L11 as a stream: documents files scored micro-batch by micro-batch with the
    naive-Bayes text model; results appended to parquet and read back."""
    _, model = fitted_model(spark, sf)
    docs = read_table(spark, sf, "documents")
    sink, ckpt = shared_path(spark, "stream-scores"), shared_path(spark, "stream-ckpt")

    def score(batch):
        return model.score(batch, "doc_id", "text").select("doc_id", F.col("prob").alias("data"))

    # the table is a file of the folder or a folder of files
    base = sf.rstrip("/")
    folder = docs.limit(1).select(F.col("_metadata.file_path").contains("/documents.parquet/").alias("f")).head()
    inside = folder is not None and folder.f
    stream_score(spark, f"{base}/documents.parquet" if inside else base, docs.schema, score, sink, ckpt,
                 glob=None if inside else "documents.parquet")
    empty = spark.createDataFrame([], "doc_id long, data double")
    empty.write.parquet(f"{sink}/batch=-1")  # so that a stream without rows has a result
    return spark.read.parquet(sink)


def _shown_vectors(spark, sf):
    """Vectors of the 250 most common tracks and of the tracks that 'error' playlists add."""
    seqs = _sequences(spark, sf)
    top = profile.most_common(seqs.select(F.explode("track_sequence").alias("item_id")), "item_id", 250)
    tagged = seqs.filter(F.col("playlist_id").contains("error")).select(F.explode("track_sequence").alias("item_id"))
    vec = item_vectors(spark, sf)
    shown = recs.extend_items(top.select("item_id"), tagged, vec.select("item_id"), "item_id")
    return vec.join(shown, "item_id", "left_semi")


@plan("project_2d")
def q_project_2d(spark, sf):
    """2-D PCA of the vectors of the 250 most common tracks and of the tracks that
    'error' playlists add to them."""
    return learn.project_2d(_shown_vectors(spark, sf))


@plan("neighbour_map")
def q_neighbour_map(spark, sf):
    """The same tracks on a 2-D map that keeps their nearest neighbours, started from PCA."""
    shown = ranking.pin(_shown_vectors(spark, sf).select("item_id", "vec"))
    return layout.neighbour_map(shown, learn.project_2d(shown))
