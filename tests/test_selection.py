"""Elimination by the Gram matrix against refits, and reductions that are fitted on train rows only."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from duelframe.operators import models as ML
from duelframe.operators import selection as S
from duelframe.session import scratch_path


def refitted(x, y, k, step):
    keep = list(range(x.shape[1]))
    while len(keep) > k:
        a = np.column_stack([x[:, keep], np.ones(len(x))])
        b = np.linalg.lstsq(a, y, rcond=None)[0][:-1]
        gone = set(np.argsort(np.abs(b), kind="stable")[:min(step, len(keep) - k)].tolist())
        keep = [c for i, c in enumerate(keep) if i not in gone]
    return keep


def table(spark, x, y):
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x array<double>, label double").repartition(3)


@pytest.mark.parametrize("step", [1, 3])
def test_elimination_equals_refitting(spark, step):
    rng = np.random.default_rng(4)
    x = rng.normal(5, 1, (200, 12)) * rng.uniform(0.5, 3, 12)
    y = x @ rng.normal(0, 1, 12) + rng.normal(0, 0.5, 200)
    matrix, means, n = S.gram(table(spark, x, y), F.col("x"), F.col("label"))
    assert n == 200 and np.allclose(means[:-1], x.mean(axis=0)) and np.allclose(matrix[:-1, :-1], (x - x.mean(0)).T @ (x - x.mean(0)))
    for k in (1, 4, 12):
        assert S.eliminate(matrix, k, step) == refitted(x, y, k, step)


def test_constant_and_repeated_features(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (60, 4))
    x = np.column_stack([x, x[:, 0], np.ones(60)])
    keep = S.eliminate(S.gram(table(spark, x, x[:, 1] * 2 + x[:, 2]), F.col("x"), F.col("label"))[0], 2)
    assert keep == [1, 2]


def test_fits_see_train_rows_only_and_are_saved(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (120, 6))
    y = (x[:, 2] + x[:, 4] > 0).astype(float)
    df = table(spark, x, y).withColumn("features", array_to_vector("x"))
    train, test = df.filter("id < 80"), df.filter("id >= 80")
    pipeline = S.reduced(S.Elimination(k=2, outputCol="selected"), ML.logreg(n=80), "selected")
    model = pipeline.fit(train)
    assert model.stages[0].getIndices() == refitted(x[:80], y[:80], 2, 1)
    assert np.allclose(model.stages[1].mean.toArray(), x[:80][:, model.stages[0].getIndices()].mean(axis=0))
    before = {r.id: r.prediction for r in model.transform(test).collect()}
    assert np.mean([before[i] == y[i] for i in before]) > 0.9
    path = scratch_path(spark, "elimination")
    S.Elimination(k=3, step=2).save(path)
    loaded = S.Elimination.load(path)
    assert loaded.getOrDefault("k") == 3 and loaded.getOrDefault("step") == 2
    assert isinstance(loaded.fit(train), VectorSlicer)
    parts = S.principal_components(6).fit(train)
    p = np.array([r.pca.toArray() for r in parts.transform(test).orderBy("id").collect()])
    assert np.allclose((p ** 2).sum(axis=1), ((x[80:] - x[:80].mean(0)) ** 2).sum(axis=1))


def test_mean_confusion_by_hand(spark):
    rows = [(1, 1, 0, 0), (1, 2, 0, 1), (1, 3, 1, 1), (2, 1, 0, 0), (2, 2, 2, 0)]
    out = ML.mean_confusion(spark.createDataFrame(rows, "seed int, id int, label int, prediction int"))
    got = {(r.label, r.prediction): (r.mean_count, round(r.mean_f1, 6)) for r in out.collect()}
    assert got == {(0, 0): (1.0, 0.666667), (0, 1): (0.5, 0.666667), (1, 1): (0.5, 0.333333), (2, 0): (0.5, 0.0)}


def test_one_search_serves_every_setting(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 4, (60, 3)).astype(float)                 # many equal distances, also 0
    y = (x.sum(axis=1) > 4).astype(float)
    df = table(spark, x, y).select("id", F.col("x").alias("vec"), "label", (F.col("id") % 4).alias("fold"))
    grid, best = ML.tune_knn(df, [1, 4, 7])
    got = {(r.k, r.weights): r.accuracy for r in grid.collect()}
    want = {}
    for k in (1, 4, 7):
        for w in ("uniform", "distance"):
            hits = 0
            for i in range(60):
                near = sorted((np.sqrt(((x[i] - x[j]) ** 2).sum()), j) for j in range(60) if j % 4 != i % 4)[:k]
                exact = near[0][0] == 0
                votes = {}
                for d, j in near:
                    votes[y[j]] = votes.get(y[j], 0) + (1 if w == "uniform" else (d == 0) * 1.0 if exact else 1 / d)
                hits += min(votes, key=lambda c: (-votes[c], c)) == y[i]
            want[k, w] = hits / 60
    assert got == pytest.approx(want)
    assert best["accuracy"] == max(got.values()) and got[best["k"], best["weights"]] == best["accuracy"]
