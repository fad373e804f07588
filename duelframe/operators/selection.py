"""Feature reduction fitted on train rows and applied elsewhere (M15, M16, M4 in evaluation).

``Elimination`` is an estimator like MLlib's own: it can stand in a pipeline,
be fitted on the train rows only, saved and loaded.  Its fit needs one pass
for the means and one for the centred Gram matrix (products of all pairs of
features and of features and label, summed per task in numpy and then by
Spark); the rounds work on that matrix, which grows with the features and not
with the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, features: Column, label: Column) -> tuple[np.ndarray, np.ndarray, int]:
    """(matrix, means, rows): the centred products of the features and, last, the label.

    ``features`` is an array of doubles; rows with a NULL label or features
    are left out.  What reaches the driver is (features + 1) squared.
    """
    rows = df.select(F.concat(features, F.array(label.cast("double"))).alias("x")).where(F.col("x").isNotNull())
    rows = rows.where(~F.exists("x", lambda v: v.isNull()))
    first = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.count("v").alias("n")).orderBy("i").collect()
    if not first:
        return np.zeros((1, 1)), np.zeros(1), 0
    means = np.array([r["m"] for r in first])
    d = len(means)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - means
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(d, dtype=np.int32), d)), pa.array(np.tile(np.arange(d, dtype=np.int32), d)),
                                          pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros((d, d))
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out, means, int(first[0]["n"])


def eliminate(matrix: np.ndarray, k: int, step: int = 1) -> list[int]:
    """Places of the ``k`` features that stay: ``step`` features with the least |coefficient| of the least-squares fit go a round.

    ``matrix`` as ``gram`` gives it.  The inverse is brought up to date when
    a feature goes, and computed anew where the features are collinear.
    """
    products, with_label = matrix[:-1, :-1], matrix[:-1, -1]
    keep = np.arange(len(products))
    inverse = None
    while len(keep) > k:
        if inverse is None:
            inverse = np.linalg.pinv(products[np.ix_(keep, keep)], hermitian=True)
            full = np.linalg.matrix_rank(products[np.ix_(keep, keep)], hermitian=True) == len(keep)
        coefficients = inverse @ with_label[keep]
        gone = np.argsort(np.abs(coefficients), kind="stable")[:min(step, len(keep) - k)]
        if full and len(gone) == 1:
            j = gone[0]
            inverse = inverse - np.outer(inverse[:, j], inverse[j]) / inverse[j, j]
            inverse = np.delete(np.delete(inverse, j, 0), j, 1)
        else:
            inverse = None
        keep = np.delete(keep, gone)
    return keep.tolist()


class Elimination(Estimator, HasInputCol, HasOutputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """M16 as an estimator: recursive elimination down to ``k`` features; fits to a ``VectorSlicer``."""

    k = Param(Params._dummy(), "k", "features that stay", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "features that go in a round", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k: int = 8, step: int = 1, inputCol: str = "features", outputCol: str = "selected", labelCol: str = "label"):
        super().__init__()
        self._setDefault(k=8, step=1, inputCol="features", outputCol="selected", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        matrix, _, n = gram(dataset, vector_to_array(self.getInputCol()), F.col(self.getLabelCol()))
        if not n:
            raise ValueError("no row to fit on")
        places = eliminate(matrix, self.getOrDefault(self.k), self.getOrDefault(self.step))
        return VectorSlicer(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), indices=places)


def scaled(estimator, inp: str = "features", mean: bool = True) -> Pipeline:
    """``estimator`` on standardised features; the scaling is fitted with it, on the train rows only (M4, Q11)."""
    scaler = StandardScaler(withMean=mean, withStd=True, inputCol=inp, outputCol="_scaled")
    return Pipeline(stages=[scaler, estimator.copy().setFeaturesCol("_scaled")])


def principal_components(k: int, inp: str = "features", out: str = "pca", scale: bool = False) -> Pipeline:
    """M15 as an estimator: centre (and scale), then project on ``k`` components."""
    return Pipeline(stages=[StandardScaler(withMean=True, withStd=scale, inputCol=inp, outputCol="_centred"),
                            PCA(k=k, inputCol="_centred", outputCol=out)])


def reduced(reduction, estimator, out: str) -> Pipeline:
    """Reduce, scale what is left, fit: one pipeline, so that test rows enter none of the three."""
    return Pipeline(stages=[reduction, *scaled(estimator, out).getStages()])
