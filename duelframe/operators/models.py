"""Learning and evaluation (M8-M16, M18-M21) on MLlib, metrics as DataFrames.

Every fit is a distributed MLlib job; the driver only loops over models,
folds and seeds (a handful of jobs), never over rows.  Inputs are persisted
before repeated fits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.operators.metrics import binary_metrics
from duelframe.operators.selection import eliminate, gram, principal_components


def as_features(df: DataFrame, cols: list[str] | str, out: str = "features") -> DataFrame:
    """Numeric columns (or one array column) -> an MLlib vector column."""
    if isinstance(cols, str):
        return df.withColumn(out, array_to_vector(F.col(cols).cast("array<double>")))
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


# -- estimators (scikit-learn parameter names mapped to MLlib) --------------

def logreg(C: float = 1.0, n: int = 1, max_iter: int = 100, tol: float = 1e-4) -> LogisticRegression:
    """L2 logistic regression; C -> regParam = 1 / (C·n); scikit-learn's
    default tolerance (1e-4) and iteration cap (100)."""
    return LogisticRegression(regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, tol=tol)


def linear_svm(C: float = 1.0, n: int = 1, max_iter: int = 100, tol: float = 1e-4) -> LinearSVC:
    """Linear SVM (hinge loss); C -> regParam = 1 / (C·n); tolerance 1e-4
    as in scikit-learn."""
    return LinearSVC(regParam=1.0 / (C * max(n, 1)), standardization=False, maxIter=max_iter,
                     tol=tol)


def bernoulli_nb(alpha: float = 1.0) -> Pipeline:
    """Features binarised at 0, Bernoulli naive Bayes with smoothing alpha."""
    return Pipeline(stages=[
        Binarizer(threshold=0.0, inputCol="features", outputCol="_bin"),
        NaiveBayes(modelType="bernoulli", smoothing=alpha, featuresCol="_bin")])


def random_forest(n_trees: int = 100, max_depth: int = 10, features: str = "auto",
                  min_instances: int = 1, seed: int = 1) -> RandomForestClassifier:
    """M14."""
    if max_depth > 30:
        raise ValueError("trees of more than 30 levels are not supported by MLlib")
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth,
                                  featureSubsetStrategy=features,
                                  minInstancesPerNode=min_instances, seed=seed)


def mlp(layers: list[int], max_iter: int = 100, seed: int = 1, step: float | None = None,
        block: int = 128) -> MultilayerPerceptronClassifier:
    """Feed-forward net (sigmoid hidden units, softmax output).

    Without ``step`` the net is fitted by L-BFGS, which has no step size;
    with it by gradient descent.
    """
    how = {"solver": "gd", "stepSize": step} if step is not None else {"solver": "l-bfgs"}
    return MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed,
                                          blockSize=block, **how)


def pca(df: DataFrame, k: int, inp: str = "features", out: str = "pca") -> DataFrame:
    """Centre (PCA in MLlib does not), then project on k components."""
    return principal_components(k, inp, out).fit(df).transform(df).drop("_centred")


def rfe(df: DataFrame, cols: list[str], label: str, k: int, step: int = 1) -> list[str]:
    """Names of the ``k`` columns that recursive elimination with a linear model keeps.

    A round drops the ``step`` columns with the smallest |coefficient|; all
    rounds work on one aggregated Gram matrix (``operators.selection``).
    """
    matrix, _, _ = gram(df, F.array(*[F.col(c).cast("double") for c in cols]), F.col(label))
    return [cols[i] for i in eliminate(matrix, k, step)]


# -- evaluation ---------------------------------------------------------------

def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """A17 + A19 on a prediction table (one aggregate job)."""
    row = binary_metrics(pred.select(F.col(label).cast("int").alias("y"),
                                     F.col(prediction).cast("int").alias("yhat")),
                         "y", "yhat").first()
    return {k: float(row[k]) for k in ("accuracy", "precision", "recall", "f1")}


def evaluate_by(pred: DataFrame, group: str, label: str = "label",
                prediction: str = "prediction") -> dict:
    """A17 + A19 for each value of ``group`` in one aggregate job."""
    y = F.col(label).cast("int") == 1
    yh = F.col(prediction).cast("int") == 1
    rows = pred.groupBy(group).agg(
        F.count_if(y & yh).alias("tp"), F.count_if(~y & yh).alias("fp"),
        F.count_if(y & ~yh).alias("fn"), F.count_if(~y & ~yh).alias("tn")).collect()
    out = {}
    for r in rows:
        tp, fp, fn, tn = (int(r[c]) for c in ("tp", "fp", "fn", "tn"))
        p = tp / (tp + fp) if tp + fp else 0.0
        rc = tp / (tp + fn) if tp + fn else 0.0
        out[r[group]] = {"accuracy": (tp + tn) / max(tp + fp + fn + tn, 1), "precision": p,
                         "recall": rc, "f1": (2 * p * rc / (p + rc)) if p + rc else 0.0}
    return out


ROWS_PER_FIT_PARTITION = 200_000
LARGE_FIT_ROWS = 5_000_000


def right_size(df: DataFrame) -> DataFrame:
    """Persist training data with about ``ROWS_PER_FIT_PARTITION`` rows per
    partition (capped by spark.sql.shuffle.partitions): iterative fits run one
    job per iteration, so empty or tiny partitions only add task overhead."""
    df = df.persist()
    n = df.count()
    cap = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    want = max(1, min(cap, -(-n // ROWS_PER_FIT_PARTITION)))
    # coalesce never adds partitions, so a smaller input keeps its own count
    return df.coalesce(want)


def compare_models(df: DataFrame, models: dict[str, Callable[[int], object]], k: int = 5,
                   order: str = "id", label: str = "label", parallelism: int = 4,
                   inputs: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Models × folds × {train_accuracy, accuracy, precision, recall, f1}.

    Folds are contiguous (W7).  Returns (long table, median per model/metric).
    ``models`` maps a name to ``fn(n_train) -> estimator``.  Independent
    (fold, model) fits are submitted from ``parallelism`` driver threads, as
    ``CrossValidator(parallelism=...)`` does, so small fits share the cluster;
    a table whose fits have tasks enough is fitted one model at a time, so that
    the training rows of several fits never contend for the cache.  With
    ``inputs`` (the columns the models read) other columns are not carried.
    """
    from concurrent.futures import ThreadPoolExecutor

    from duelframe.operators.ordering import _num_partitions
    from duelframe.operators.windows import kfold

    spark = df.sparkSession
    narrow = df.select(*[c for c in dict.fromkeys([order, label, *inputs]) if c in df.columns]) if inputs else df
    parts = _num_partitions(narrow, None)
    kept = narrow.storageLevel
    ours = not (kept.useMemory or kept.useDisk)
    if ours:
        narrow = narrow.persist()          # the range sort of the folds reads it twice: once to sample the order
    try:
        data = right_size(kfold(narrow, k, [order], partitions=parts))
    finally:
        if ours:
            narrow.unpersist()
    sizes = {r["fold"]: r["count"] for r in data.groupBy("fold").count().collect()}
    total = sum(sizes.values())
    if total > LARGE_FIT_ROWS:
        parallelism = 1

    def run(fold, name):
        train = data.filter(F.col("fold") != fold)
        model = models[name](total - sizes.get(fold, 0)).fit(train)
        pred = model.transform(data).withColumn("_test", F.col("fold") == fold)
        ev = evaluate_by(pred, "_test", label)
        out = [(name, fold, "train_accuracy", ev[False]["accuracy"])]
        out.extend((name, fold, m, v) for m, v in ev.get(True, {}).items())
        return out

    jobs = [(fold, name) for fold in range(k) for name in models]
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = [r for part in pool.map(lambda j: run(*j), jobs) for r in part]
    finally:
        data.unpersist()
    long = spark.createDataFrame(rows, "model string, fold int, metric string, value double")
    med = long.groupBy("model", "metric").agg(F.median("value").alias("median"))
    return long, med


def repeat_eval(df: DataFrame, make: Callable[[int], object], seeds=range(1, 6),
                frac: float = 0.8, id_col: str = "id", label: str = "label") -> DataFrame:
    """M8: repeated seeded splits, fit, evaluate; one row per seed and metric."""
    from duelframe.operators.prep import split

    spark = df.sparkSession
    data = right_size(df)
    rows = []
    try:
        for s in seeds:
            d = split(data, id_col, frac, s)
            train, test = d.filter("is_train"), d.filter(~F.col("is_train"))
            model = make(train.count()).fit(train)
            for m, v in evaluate(model.transform(test), label).items():
                rows.append((int(s), m, v))
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "seed int, metric string, value double")


def repeat_predictions(df: DataFrame, make: Callable[[int], object], seeds=range(1, 6), frac: float = 0.8,
                       id_col: str = "id", label: str = "label") -> DataFrame:
    """M8: (seed, id, label, prediction) of the test rows of each seeded split.

    The data is persisted once and every fit reads it; the predictions are
    written, so the metrics of all seeds come from one table.
    """
    from duelframe.operators.prep import split
    from duelframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    data = right_size(df)
    parts = []
    try:
        for s in seeds:
            d = split(data, id_col, frac, s)
            train = d.filter("is_train")
            test = make(train.count()).fit(train).transform(d.filter(~F.col("is_train")))
            test = test.select(F.lit(int(s)).alias("seed"), F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"),
                               F.col("prediction").cast("int").alias("prediction"))
            parts.append(test.checkpoint(eager=True))
    finally:
        data.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mean_confusion(predictions: DataFrame) -> DataFrame:
    """M8: (label, prediction, mean_count, mean_f1): cells of the mean confusion matrix over seeds, and the label's mean F1.

    One aggregate over (seed, label, prediction); cells that no seed fills
    are left out.  A class's F1 is 0 in a seed that neither has nor predicts it.
    """
    cells = predictions.groupBy("seed", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    seeds = max(cells.select("seed").distinct().count(), 1)
    hit = (F.col("label") == F.col("prediction")).cast("int")
    side = cells.select("seed", "n", F.explode(F.array(
        F.struct(F.col("label").alias("c"), hit.alias("hit")), F.struct(F.col("prediction").alias("c"), F.lit(0).alias("hit")))).alias("s"))
    # 2 hits / (rows labelled so + rows predicted so)
    f1 = side.groupBy("seed", F.col("s.c").alias("c")).agg((2 * F.sum(F.col("n") * F.col("s.hit")) / F.sum("n")).alias("f1"))
    f1 = f1.groupBy(F.col("c").alias("label")).agg((F.sum("f1") / seeds).alias("mean_f1"))
    counts = cells.groupBy("label", "prediction").agg((F.sum("n") / seeds).alias("mean_count"))
    return counts.join(f1, "label").select("label", "prediction", "mean_count", "mean_f1")


def predict_horizons(windows: DataFrame, f: int, make: Callable[[int], object],
                     id_col: str = "id", frac: float = 0.8, seed: int = 2,
                     features: str = "features") -> DataFrame:
    """One binary model per horizon h = 1..f on the same window features.

    ``windows`` holds a vector column ``features`` and 0/1 columns
    ``label_1 .. label_f`` (W10).  Returns (horizon, metric, value) on a
    repeatable hold-out split (M6).
    """
    from duelframe.operators.prep import split

    spark = windows.sparkSession
    data = right_size(split(windows, id_col, frac, seed))
    rows = []
    try:
        n = data.filter("is_train").count()
        for h in range(1, f + 1):
            d = data.withColumn("label", F.col(f"label_{h}").cast("double"))
            model = make(n).setFeaturesCol(features).fit(d.filter("is_train"))
            for m, v in evaluate(model.transform(d.filter(~F.col("is_train")))).items():
                rows.append((h, m, v))
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "horizon int, metric string, value double")


def grid_search(df: DataFrame, estimator, grid: dict, folds: int = 3, seed: int = 1,
                label: str = "label", parallelism: int = 4) -> DataFrame:
    """M9: cross-validated grid search; one row per parameter map with its mean accuracy."""
    b = ParamGridBuilder()
    for param, values in grid.items():
        b = b.addGrid(getattr(estimator, param), values)
    maps = b.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        numFolds=folds, seed=seed, parallelism=parallelism)
    model = cv.fit(df)
    rows = [({p.name: str(v) for p, v in m.items()}, float(a))
            for m, a in zip(maps, model.avgMetrics)]
    return df.sparkSession.createDataFrame(
        [(str(sorted(p.items())), a) for p, a in rows], "params string, accuracy double")


def rank_results(results: DataFrame, metric: str, k: int = 5, tie: str | None = None) -> DataFrame:
    """Sort runs by a metric (descending), keep the top k, number them."""
    order = [F.col(metric).desc()] + ([F.col(tie)] if tie else [])
    top = results.orderBy(*order).limit(k)
    w = Window.orderBy(*order)  # k rows only
    return top.withColumn("rank", F.row_number().over(w).cast("bigint"))


# -- exact k nearest neighbours (M12) -------------------------------------------

KNN_QUERY_BLOCK = 16_384
KNN_TRAIN_BLOCK = 65_536
KNN_TASKS = 32                     # smaller query blocks, down to KNN_LEAST, for as many tasks on small tables
KNN_LEAST = 1024
KNN_STRIP, KNN_CHUNK = 256, 8192   # queries and train rows compared at once


def _distances(qs: np.ndarray, ts: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows; summed one dimension after the other, as a plain loop does."""
    acc = np.zeros(len(qs))
    for dim in range(qs.shape[1]):
        diff = qs[:, dim] - ts[:, dim]
        acc += diff * diff
    return np.sqrt(acc)


def _bounded(qmat: np.ndarray, tv: np.ndarray):
    """(q, t, slack): q @ t.T is |t|^2 - 2 q.t of scaled rows in single precision, its error at most
    ``slack`` of |q|^2 + |t|^2; None where the values leave no such bound."""
    most = max(np.abs(qmat).max(initial=0), np.abs(tv).max(initial=0))
    if not 1e-100 < most < 1e100:                  # zeros alone, not finite, or squares out of range
        return None
    scale = 2.0 ** -np.ceil(np.log2(most))
    q, t = qmat * scale, tv * scale
    qn, tn = (q * q).sum(axis=1), (t * t).sum(axis=1)
    slack = 4 * (q.shape[1] + 8) * 2.0 ** -23
    q = np.column_stack([q, np.ones(len(q))]).astype(np.float32)
    t = np.column_stack([-2 * t, tn]).astype(np.float32)
    return q, t, slack * qn + 1e-30, slack * tn


def _nearest(ids, qmat, tid, tv, tlab, k: int) -> pd.DataFrame:
    """The k nearest train rows of each query row, ties by train id.

    One matrix product bounds the distances of a strip of queries to a chunk
    of train rows; only pairs within the bound of the k-th nearest get their
    distance in double precision, which alone decides.
    """
    kk, bounded = min(k, len(tv)), _bounded(qmat, tv)
    out = []
    for s in range(0, len(ids), KNN_STRIP):
        n = len(ids[s:s + KNN_STRIP])
        limit, best = np.full(n, np.inf), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for c in range(0, len(tv), KNN_CHUNK):
            m = len(tv[c:c + KNN_CHUNK])
            if bounded is None:
                i, j = np.divmod(np.arange(n * m), m)
            else:
                q, t, q_slack, t_slack = (x[at:at + size] for x, at, size in zip(bounded, (s, c, s, c), (n, m, n, m)))
                near = q @ t.T
                if m >= kk:                        # the k-th of this chunk is no nearer than the k-th of all
                    kth = np.partition(near + t_slack.astype(np.float32), kk - 1, axis=1)[:, kk - 1] if c == 0 else np.inf
                    limit = np.minimum(limit, kth + 2 * q_slack)
                near -= t_slack.astype(np.float32)
                i, j = np.nonzero(near <= np.nextafter(limit.astype(np.float32), np.float32(np.inf))[:, None])
            d = _distances(qmat[s + i], tv[c + j]) if len(i) else np.zeros(0)
            i, j, d = (np.concatenate(x) for x in zip(best, (i, c + j, d)))
            ok = ~np.isnan(d)
            i, j, d = i[ok], j[ok], d[ok]
            by = np.lexsort((tid[j], d, i))
            by = by[np.arange(len(by)) - np.searchsorted(i[by], i[by], side="left") < kk]
            best = i[by], j[by], d[by]
        out.append((s + best[0], best[1], best[2]))
    i, j, d = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"_qid": ids[i], "_tid": tid[j], "_d": d, "_lab": tlab[j]})


def knn_neighbours(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "id", vec: str = "vec", label: str = "label",
                   query_block: int = KNN_QUERY_BLOCK, train_block: int = KNN_TRAIN_BLOCK) -> DataFrame:
    """(_qid, _tid, _d, _lab, _r): the exact k nearest train rows (Euclidean) of each test row, ties by (distance, train id).

    Both sides are dealt by a hash of their ids into blocks of about
    ``query_block`` (less for a small table) and ``train_block`` rows.  Every query block meets every
    train block in a task of its own, which keeps k rows for each query; a
    top-k merge per query follows.  Nothing passes through the driver, and
    both counts only set the number of blocks.  Rows without a vector take
    no part.
    """
    def vector(df):                               # single precision travels as it is
        kind = df.schema[vec].dataType
        return F.col(vec) if kind == T.ArrayType(T.FloatType(), kind.containsNull) else F.col(vec).cast("array<double>")

    q = test.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("_qid"), vector(test).alias("_q"))
    tr = train.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("_tid"), vector(train).alias("_v"), F.col(label).alias("_lab"))
    rows = q.count()
    nt = max(1, -(-tr.count() // train_block))
    nq = max(1, -(-rows // query_block), min(KNN_TASKS // nt, rows // KNN_LEAST))
    parts = min(nq * nt, 16 * int(q.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))

    def deal(id_name, n):
        return F.pmod(F.xxhash64(id_name), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = q.withColumn("_qb", deal("_qid", nq)).withColumn("_tb", every(nt))
    tr = tr.withColumn("_tb", deal("_tid", nt)).withColumn("_qb", every(nq))

    def local_top(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or ts.empty:
            return pd.DataFrame({c: [] for c in ("_qid", "_tid", "_d", "_lab")})
        return _nearest(qs["_qid"].to_numpy(), np.stack(qs["_q"].to_numpy()).astype(np.float64),
                        ts["_tid"].to_numpy(), np.stack(ts["_v"].to_numpy()).astype(np.float64),
                        ts["_lab"].to_numpy(), k)

    schema = T.StructType([T.StructField("_qid", q.schema["_qid"].dataType),
                           T.StructField("_tid", tr.schema["_tid"].dataType),
                           T.StructField("_d", T.DoubleType()),
                           T.StructField("_lab", tr.schema["_lab"].dataType)])
    # a block is little data and much work: a stated number of partitions is not coalesced
    q, tr = q.repartition(parts, "_qb", "_tb"), tr.repartition(parts, "_qb", "_tb")
    cand = q.groupBy("_qb", "_tb").cogroup(tr.groupBy("_qb", "_tb")).applyInPandas(local_top, schema)
    w = Window.partitionBy("_qid").orderBy("_d", "_tid")
    return cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)


def _votes(top: DataFrame, weight: Column, *by: str) -> DataFrame:
    """(*by, _qid, prediction): the label with most votes; ties -> the smallest."""
    votes = top.withColumn("_w", weight).groupBy(*by, "_qid", "_lab").agg(F.sum("_w").alias("_s"))
    best = votes.groupBy(*by, "_qid").agg(F.min(F.struct((-F.col("_s")).alias("neg"), F.col("_lab"))).alias("_b"))
    return best.select(*by, "_qid", F.col("_b._lab").alias("prediction"))


def _inverse_distance() -> Column:
    """1 / d; exact matches, if there are any among the neighbours, vote alone."""
    exact = F.min("_d").over(Window.partitionBy("_qid")) == 0
    return F.when(exact, (F.col("_d") == 0).cast("double")).otherwise(1.0 / F.col("_d"))


def knn_classify(train: DataFrame, test: DataFrame, k: int = 5, weights: str = "uniform", id_col: str = "id",
                 vec: str = "vec", label: str = "label", **blocks: int) -> DataFrame:
    """(id, prediction) by the vote of the k nearest (``knn_neighbours``).

    Votes: 'uniform' or 'distance' (1/d; exact matches alone vote); ties ->
    the smallest label.
    """
    top = knn_neighbours(train, test, k, id_col, vec, label, **blocks)
    best = _votes(top, F.lit(1.0) if weights == "uniform" else _inverse_distance())
    return best.withColumnRenamed("_qid", id_col)


def tune_knn(df: DataFrame, ks: list[int], weights: tuple[str, ...] = ("uniform", "distance"), fold: str = "fold",
             id_col: str = "id", vec: str = "vec", label: str = "label") -> tuple[DataFrame, dict]:
    """M9 for k-NN: ((k, weights, accuracy) over all folds, the best setting).

    Each row is predicted from the rows of the other folds.  One neighbour
    search per fold, for the largest k, serves every k and weighting; the
    votes of all settings are one aggregate.  Of equally good settings the
    smallest k, then the first weighting counts as best.
    """
    data = df.select(F.col(id_col).alias("_id"), F.col(vec).alias("_v"), F.col(label).alias("_y"), F.col(fold).alias("_fold")).persist()
    try:
        parts = [knn_neighbours(data.filter(F.col("_fold") != f), data.filter(F.col("_fold") == f), max(ks), "_id", "_v", "_y")
                 for f in sorted(r["_fold"] for r in data.select("_fold").distinct().collect())]
        top = parts[0]
        for p in parts[1:]:
            top = top.unionByName(p)
        settings = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights")) for k in ks for w in weights]))
        top = top.withColumn("_s", settings).select("*", "_s.*").filter("_r <= k")
        weight = F.when(F.col("weights") == "uniform", F.lit(1.0)).otherwise(_inverse_distance())
        got = _votes(top, weight, "k", "weights").join(data.select(F.col("_id").alias("_qid"), "_y"), "_qid")
        rows = got.groupBy("k", "weights").agg(F.avg((F.col("prediction") == F.col("_y")).cast("double")).alias("accuracy")).collect()
    finally:
        data.unpersist()
    best = min(rows, key=lambda r: (-r["accuracy"], r["k"], weights.index(r["weights"])))
    table = df.sparkSession.createDataFrame([tuple(r) for r in rows], "k int, weights string, accuracy double")
    return table, {"k": best["k"], "weights": best["weights"], "accuracy": best["accuracy"]}


class Knn:
    """k-NN with the fit / transform calls of an MLlib estimator, so that it
    can stand beside the other models in ``compare_models`` and ``repeat_eval``.
    Rows need a unique ``id_col``."""

    def __init__(self, k: int = 5, weights: str = "uniform", id_col: str = "id",
                 features: str = "features", label: str = "label"):
        self.k, self.weights, self.id_col = k, weights, id_col
        self.features, self.label = features, label
        self.train = None

    def _vectors(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_vec", vector_to_array(self.features))

    def fit(self, df: DataFrame) -> Knn:
        model = Knn(self.k, self.weights, self.id_col, self.features, self.label)
        model.train = self._vectors(df).select(self.id_col, "_vec", self.label)
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        votes = knn_classify(self.train, self._vectors(df), self.k, self.weights,
                             self.id_col, "_vec", self.label)
        return df.join(votes, self.id_col, "left")
