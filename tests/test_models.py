"""Rows-only model queries: shapes and value ranges (sf0.001)."""

import pytest

from conftest import SF_SMALL
import __spark_entry__ as E


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_compare_models_long_and_medians(spark, q):
    med = q["compare_models"](spark, SF_SMALL).collect()
    assert {r.model for r in med} == {"logreg", "linear_svm", "bernoulli_nb", "random_forest", "knn"}
    assert {r.metric for r in med} == {"train_accuracy", "accuracy", "precision", "recall", "f1"}
    assert all(0.0 <= r.median <= 1.0 for r in med)
    long = q["compare_models_folds"](spark, SF_SMALL).collect()
    assert sorted({r.fold for r in long}) == [0, 1, 2] and len(long) == 3 * 5


def test_repeat_eval_and_grid(spark, q):
    r = {x.metric: x.mean for x in q["repeat_eval"](spark, SF_SMALL).collect()}
    assert set(r) == {"accuracy", "precision", "recall", "f1"}
    g = q["grid_search"](spark, SF_SMALL).collect()
    assert len(g) == 4 and all(0.0 <= x.accuracy <= 1.0 for x in g)


def test_pca_rfe_mlp_horizons(spark, q):
    p = q["pca_projection"](spark, SF_SMALL).first()
    assert len(p.pca) == 5
    rfe = q["rfe_selection"](spark, SF_SMALL)
    assert len(rfe.columns) == 9 and "label" in rfe.columns
    m = {x.metric for x in q["mlp_eval"](spark, SF_SMALL).collect()}
    assert m == {"accuracy", "precision", "recall", "f1"}
    h = q["predict_horizons"](spark, SF_SMALL).collect()
    assert sorted({x.horizon for x in h}) == [1, 2]


def test_career_model_comparison(spark, q):
    med = q["career_model_comparison"](spark, SF_SMALL).collect()
    assert {r.model for r in med} == {"logreg", "random_forest"} and len(med) == 10
