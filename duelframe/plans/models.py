"""Model queries on embeddings (M8-M16, M18-M21) and career windows.

Fitted models are randomised / iterative, so most of these are rows-only
checks; exact k-NN (M12) and the result ranking (M21) have oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import models as ML
from duelframe.operators.prep import split, split_threshold
from duelframe.operators.selection import scaled
from duelframe.plans.registry import register, table


def embedding_frame(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return ML.as_features(e.select(F.col("vec_id").alias("id"), "embedding",
                                   (F.col("label") % 2).cast("double").alias("label")),
                          "embedding")


_KNN_SPLIT = f"substr(md5(concat_ws(':', CAST(vec_id AS VARCHAR), '5')), 1, 8) < '{split_threshold(0.8)}'"


@register("knn_exact", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 AS y, {_KNN_SPLIT} AS is_train
           FROM embeddings),
d AS (SELECT t.vec_id AS qid, r.vec_id AS tid, r.y,
             row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.v, r.v), r.vec_id) AS rk
      FROM e t JOIN e r ON NOT t.is_train AND r.is_train),
v AS (SELECT qid, y, count(*) AS n FROM d WHERE rk <= 5 GROUP BY qid, y)
SELECT qid AS vec_id, CAST(arg_min(y, [-n, y]) AS BIGINT) AS prediction FROM v GROUP BY qid
""")
def q_knn_exact(spark, sf_dir):
    """Exact 5-NN majority vote for the held-out rows."""
    e = split(table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 2).cast("long").alias("label")),
        "vec_id", 0.8, 5)
    train = e.filter("is_train")
    test = e.filter(~F.col("is_train"))
    return ML.knn_classify(train, test, k=5, id_col="vec_id", vec="embedding")


@register("knn_distance_weighted", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 AS y, {_KNN_SPLIT} AS is_train
           FROM embeddings),
d AS (SELECT t.vec_id AS qid, r.vec_id AS tid, r.y, list_distance(t.v, r.v) AS dist,
             row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.v, r.v), r.vec_id) AS rk
      FROM e t JOIN e r ON NOT t.is_train AND r.is_train),
k AS (SELECT *, max(CAST(dist = 0 AS INTEGER)) OVER (PARTITION BY qid) AS has_zero FROM d WHERE rk <= 5),
v AS (SELECT qid, y, sum(CASE WHEN has_zero = 1 THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END) AS s
      FROM k GROUP BY qid, y)
SELECT qid AS vec_id, CAST(arg_min(y, [-s, y]) AS BIGINT) AS prediction FROM v GROUP BY qid
""")
def q_knn_weighted(spark, sf_dir):
    """M12 with 1/distance weights."""
    e = split(table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 2).cast("long").alias("label")),
        "vec_id", 0.8, 5)
    return ML.knn_classify(e.filter("is_train"), e.filter(~F.col("is_train")), k=5,
                           weights="distance", id_col="vec_id", vec="embedding")


@register("knn_grid", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 AS y, vec_id % 3 AS fold FROM embeddings),
d AS (SELECT t.vec_id AS qid, t.y AS real, r.y, list_distance(t.v, r.v) AS dist,
             row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.v, r.v), r.vec_id) AS rk
      FROM e t JOIN e r ON t.fold <> r.fold),
s AS (SELECT qid, real, y, k, w, dist, min(dist) OVER (PARTITION BY qid) = 0 AS exact
      FROM d, (SELECT unnest([3, 5, 9]) AS k), (SELECT unnest(['uniform', 'distance']) AS w) WHERE rk <= k),
v AS (SELECT k, w, qid, real, y, sum(CASE WHEN w = 'uniform' THEN 1.0 WHEN exact THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END) AS votes
      FROM s GROUP BY ALL),
p AS (SELECT k, w, qid, real, arg_min(y, [-votes, y]) AS prediction FROM v GROUP BY ALL)
SELECT k, w AS weights, round(avg(CAST(prediction = real AS DOUBLE)), 6) AS accuracy FROM p GROUP BY k, w
""")
def q_knn_grid(spark, sf_dir):
    """M9 for k-NN: every k and weighting from one neighbour search per fold."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"),
                                                  (F.col("label") % 2).cast("long").alias("label"), (F.col("vec_id") % 3).alias("fold"))
    grid, _ = ML.tune_knn(e, [3, 5, 9])
    return grid.select("k", "weights", F.round("accuracy", 6).alias("accuracy"))


def _models():
    return {
        "logreg": lambda n: scaled(ML.logreg(C=1.0, n=n)),
        "linear_svm": lambda n: scaled(ML.linear_svm(C=1.0, n=n)),
        "bernoulli_nb": lambda n: ML.bernoulli_nb(1.0),
        "random_forest": lambda n: ML.random_forest(n_trees=50, max_depth=5),
        "knn": lambda n: ML.Knn(5),
    }


@register("compare_models", None)
def q_compare_models(spark, sf_dir):
    """M20 (+ M10, M11, M13, M14, W7, A14): models × 3 folds × metrics, medians."""
    long, med = ML.compare_models(embedding_frame(spark, sf_dir), _models(), k=3, inputs=("features",))
    return med


@register("compare_models_folds", None)
def q_compare_models_folds(spark, sf_dir):
    """The long table (model, fold, metric, value)."""
    long, _ = ML.compare_models(embedding_frame(spark, sf_dir),
                                {"logreg": lambda n: ML.logreg(C=0.5, n=n)}, k=3)
    return long


@register("repeat_eval", None)
def q_repeat_eval(spark, sf_dir):
    """M8 + A13: five seeded 80/20 splits, mean of each metric."""
    r = ML.repeat_eval(embedding_frame(spark, sf_dir), lambda n: ML.logreg(C=1.0, n=n))
    return r.groupBy("metric").agg(F.avg("value").alias("mean"))


@register("grid_search", None)
def q_grid_search(spark, sf_dir):
    """M9: 3-fold cross-validated grid over logistic-regression settings."""
    est = ML.LogisticRegression(maxIter=50)
    return ML.grid_search(embedding_frame(spark, sf_dir), est,
                          {"regParam": [0.001, 0.1], "elasticNetParam": [0.0, 0.5]})


@register("pca_projection", None)
def q_pca(spark, sf_dir):
    """Centred PCA to 5 components."""
    p = ML.pca(embedding_frame(spark, sf_dir), 5)
    return p.select("id", ML.vector_to_array("pca").alias("pca"))


@register("rfe_selection", None)
def q_rfe(spark, sf_dir):
    """Eliminate features of a linear fit down to 8, one a round."""
    e = table(spark, sf_dir, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    wide = e.select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)],
                    (F.col("label") % 2).alias("label"))
    keep = ML.rfe(wide, cols, "label", 8)
    return wide.select(*keep, "label")


_NB = """
e AS (SELECT vec_id, label % 2 AS y, list_transform(CAST(embedding AS DOUBLE[]), lambda v: CAST(v > 0 AS INTEGER)) AS b FROM embeddings),
s AS (SELECT e.*, seed, substr(md5(concat_ws(':', CAST(vec_id AS VARCHAR), CAST(seed AS VARCHAR))), 1, 8) < '{thr}' AS is_train
      FROM e, (SELECT unnest({seeds}) AS seed)),
u AS (SELECT vec_id, seed, y, is_train, unnest(b) AS v, unnest(range(len(b))) AS i FROM s),
t AS (SELECT seed, y, i, ln((sum(v) + 1.0) / (count(*) + 2.0)) AS on_, ln((count(*) - sum(v) + 1.0) / (count(*) + 2.0)) AS off_
      FROM u WHERE is_train GROUP BY ALL),
c AS (SELECT seed, y, ln(count(*) + 1.0) AS prior FROM s WHERE is_train GROUP BY ALL),
l AS (SELECT u.vec_id, u.seed, u.y AS label, t.y AS k, sum(CASE WHEN v = 1 THEN on_ ELSE off_ END) + any_value(prior) AS score
      FROM u JOIN t ON u.i = t.i AND u.seed = t.seed JOIN c ON c.seed = t.seed AND c.y = t.y WHERE NOT is_train GROUP BY ALL),
p AS (SELECT vec_id, seed, CAST(label AS INTEGER) AS label, CAST(arg_max(k, score) AS INTEGER) AS prediction FROM l GROUP BY vec_id, seed, label)
"""


@register("naive_bayes_predictions", "WITH" + _NB.format(thr=split_threshold(0.8), seeds="[1]") + "SELECT vec_id AS id, label, prediction FROM p")
def q_naive_bayes(spark, sf_dir):
    """Bernoulli naive Bayes on features binarised at 0, predictions of a 20 % hold-out (closed form in SQL)."""
    p = ML.repeat_predictions(embedding_frame(spark, sf_dir), lambda n: ML.bernoulli_nb(1.0), seeds=[1])
    return p.select("id", "label", "prediction")


@register("repeat_confusion", "WITH" + _NB.format(thr=split_threshold(0.8), seeds="[1, 2, 3, 4, 5]") + """,
n AS (SELECT seed, label, prediction, count(*) AS n FROM p GROUP BY ALL),
f AS (SELECT k, sum(f1) / 5 AS f1 FROM (SELECT seed, k, 2.0 * sum(hit) / sum(n) AS f1 FROM (
    SELECT seed, label AS k, n, CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM n UNION ALL SELECT seed, prediction, n, 0 FROM n)
    GROUP BY ALL) GROUP BY k)
SELECT label, prediction, round(sum(n) / 5, 6) AS mean_count, round(any_value(f1), 6) AS mean_f1
FROM n JOIN f ON f.k = n.label GROUP BY label, prediction
""")
def q_repeat_confusion(spark, sf_dir):
    """M8: mean confusion matrix and mean F1 per class over five seeded 80/20 splits."""
    p = ML.repeat_predictions(embedding_frame(spark, sf_dir), lambda n: ML.bernoulli_nb(1.0))
    return ML.mean_confusion(p).select("label", "prediction", F.round("mean_count", 6).alias("mean_count"), F.round("mean_f1", 6).alias("mean_f1"))


@register("pca_held_out", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
    substr(md5(concat_ws(':', CAST(vec_id AS VARCHAR), '5')), 1, 8) < '{split_threshold(0.8)}' AS is_train FROM embeddings),
u AS (SELECT vec_id, is_train, unnest(v) AS x, unnest(range(len(v))) AS i FROM e),
m AS (SELECT i, avg(x) AS m FROM u WHERE is_train GROUP BY i)
SELECT vec_id, round(sum((x - m) ** 2), 4) AS apart FROM u JOIN m USING (i) WHERE NOT is_train GROUP BY vec_id
""")
def q_pca_held_out(spark, sf_dir):
    """Components fitted on train rows, applied to the held-out ones; on all 64 components a
    projection is as long as the row is far from the train mean."""
    from duelframe.operators.selection import principal_components

    e = split(embedding_frame(spark, sf_dir), "id", 0.8, 5)
    model = principal_components(64).fit(e.filter("is_train"))
    out = model.transform(e.filter(~F.col("is_train"))).select(F.col("id").alias("vec_id"), ML.vector_to_array("pca").alias("p"))
    return out.select("vec_id", F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x * x), 4).alias("apart"))


@register("mlp_eval", None)
def q_mlp(spark, sf_dir):
    """Feed-forward net on the 64 features, evaluated on a 20 % hold-out."""
    from duelframe.operators.prep import split as rsplit

    e = rsplit(embedding_frame(spark, sf_dir), "id", 0.8, 11)
    model = ML.mlp([64, 16, 2], max_iter=50).fit(e.filter("is_train"))
    m = ML.evaluate(model.transform(e.filter(~F.col("is_train"))))
    return spark.createDataFrame(sorted(m.items()), "metric string, value double")


@register("predict_horizons", None)
def q_predict_horizons(spark, sf_dir):
    """From the last 5 events predict each of the next 2 outcomes (one model each)."""
    from duelframe.operators.windows import flatten_windows, label_columns
    from duelframe.plans.careers import event_careers

    w = event_careers(spark, sf_dir, 5, 2, True)
    w = w.select("user_id", "win_start", flatten_windows("features", ["value", "won"])
                 .alias("flat"), "labels")
    w = label_columns(w, "labels", 2)
    w = ML.as_features(w, "flat").withColumn(
        "id", F.concat_ws(":", "user_id", "win_start"))
    return ML.predict_horizons(w, 2, lambda n: ML.logreg(C=1.0, n=n))


@register("rank_results", """
WITH r AS (SELECT l_linenumber AS run, round(avg(l_discount), 6) AS score,
                  round(avg(l_tax), 6) AS loss FROM lineitem GROUP BY l_linenumber)
SELECT run, score, loss, row_number() OVER (ORDER BY score DESC, run) AS rank
FROM r ORDER BY score DESC, run LIMIT 5
""")
def q_rank_results(spark, sf_dir):
    """Result table (one row per run), sorted, top 5, numbered."""
    li = table(spark, sf_dir, "lineitem")
    res = li.groupBy(F.col("l_linenumber").alias("run")).agg(
        F.round(F.avg("l_discount"), 6).alias("score"), F.round(F.avg("l_tax"), 6).alias("loss"))
    return ML.rank_results(res, "score", 5, tie="run")


@register("career_model_comparison", None)
def q_career_model_comparison(spark, sf_dir):
    """The reference's last-N flow end to end: two-sided rows -> competitor rows
    (U1) -> prepared (M24) -> last-5 windows and next outcome (W2-W4) ->
    flattened (W8) -> models compared over folds (M20)."""
    from duelframe.operators.prep import prepare_careers
    from duelframe.operators.reshape import split_sides
    from duelframe.operators.windows import career_windows, flatten_windows, label_columns
    from duelframe.plans.reshaping import two_sided_lineitem

    b = two_sided_lineitem(spark, sf_dir)
    bouts = b.select(F.col("l_shipdate").alias("date"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bout_id"),
                     F.concat(F.lit("p"), F.col("R_key").cast("string")).alias("R_name"),
                     "R_landed", "R_att",
                     F.concat(F.lit("s"), F.col("B_key").cast("string")).alias("B_name"),
                     "B_landed", "B_att", "Winner")
    feats = ["landed", "att", "Winner"]
    rows = prepare_careers(split_sides(bouts, "R_", "B_", winner="Winner"), [], ["date", "name"])
    win = career_windows(rows, "name", ["date", "bout_id", "landed", "att"], feats, n=5, f=1,
                         label="Winner")
    win = label_columns(win.withColumn("flat", flatten_windows("features", feats)), "labels")
    data = (ML.as_features(win, "flat").withColumnRenamed("label_1", "label")
              .withColumn("id", F.concat_ws(":", "name", "win_start")))
    _long, med = ML.compare_models(data, {"logreg": lambda n: ML.logreg(1.0, n),
                                          "random_forest": lambda n: ML.random_forest(20, 5)}, k=3,
                                   inputs=("features",))
    return med
