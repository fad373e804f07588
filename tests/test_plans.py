"""Physical-plan checks: the plans the operators are designed to produce."""

from conftest import SF_SMALL
import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_top_n_has_partial_group_limit(spark):
    p = _plan(_q(spark, "top_orders_per_customer"))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(_q(spark, "skip_status"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_min_rows_is_partial_aggregate_and_semi_join(spark):
    p = _plan(_q(spark, "career_min_rows"))
    assert "partial_count" in p and "LeftSemi" in p
    assert "Window" not in p


def test_dedupe_is_an_aggregate_not_a_window(spark):
    p = _plan(_q(spark, "dedupe_first"))
    assert "partial_min_by" in p and "Window" not in p


def test_career_windows_single_shuffle_without_hot_key(spark):
    p = _plan(_q(spark, "career_windows"))
    assert p.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in p


def test_literal_dimension_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(_q(spark, "literal_lookup"))


def test_name_matching_has_no_cartesian_product(spark):
    for name in ("name_matches_parts", "name_matches_docs"):
        p = _plan(_q(spark, name))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_registered_query_uses_a_cross_product(spark):
    skip = {"compare_models", "compare_models_folds", "repeat_eval", "grid_search",
            "mlp_eval", "predict_horizons", "rfe_selection", "pca_projection",
            "career_model_comparison"}
    for name, fn in E.queries().items():
        if name in skip:
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
