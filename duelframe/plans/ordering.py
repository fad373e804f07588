"""Sorting, limits and top-k (O1-O7), P17 row ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import aggs as A
from duelframe.operators import ordering as O
from duelframe.operators.project import with_row_id
from duelframe.plans.aggregates import CORR_SQL, lineitem_label
from duelframe.plans.registry import register, table


@register("sort_ascending", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def q_sort_asc(spark, sf_dir):
    """O1."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").orderBy(
        "o_orderdate", "o_orderkey")


@register("sort_descending", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def q_sort_desc(spark, sf_dir):
    """O2."""
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.col("c_acctbal").desc(), "c_custkey")


@register("top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def q_top_k(spark, sf_dir):
    """O3: the 10 largest orders (a top-k report)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, [F.col("o_totalprice").desc(), "o_orderkey"], 10)


@register("preview_tail", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey DESC LIMIT 5
""")
def q_preview_tail(spark, sf_dir):
    """The last five rows in key order (tail preview)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return O.preview(o, ["o_orderkey"], 5, tail=True)


@register("preview_head", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5")
def q_preview_head(spark, sf_dir):
    """Head preview."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return O.preview(o, ["o_orderkey"], 5)


@register("shuffle_rows", """
SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat_ws(':', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS shuffle_pos
FROM orders
""")
def q_shuffle_rows(spark, sf_dir):
    """Repeatable seeded shuffle (md5 of id:seed)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return O.shuffle_rows(o, "o_orderkey", 42)


@register("reverse_order", "SELECT c_custkey FROM customer ORDER BY c_custkey DESC")
def q_reverse(spark, sf_dir):
    """O6."""
    return O.reverse_order(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@register("top_half_correlated", f"""
WITH c AS (SELECT feature, abs(corr) * 100 AS score, corr FROM ({CORR_SQL})
           WHERE corr IS NOT NULL AND NOT isnan(corr)),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, feature DESC) AS rk, count(*) OVER () AS n FROM c)
SELECT feature, round(corr, 6) AS corr, round(score, 6) AS score FROM r WHERE rk <= greatest(floor(n / 2), 1)
""")
def q_top_half(spark, sf_dir):
    """The half of the features with the largest |corr|."""
    c = A.label_correlation(lineitem_label(spark, sf_dir), "label")
    t = O.top_half(c)
    return t.select("feature", F.round("corr", 6).alias("corr"), F.round("score", 6).alias("score"))


@register("row_ids", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS cust_row
FROM orders
""")
def q_row_ids(spark, sf_dir):
    """Global and per-customer stable row ids."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    g = with_row_id(o, ["o_orderdate", "o_orderkey"], "row_id")
    k = with_row_id(g, ["o_orderdate", "o_orderkey"], "cust_row", key="o_custkey")
    return k.select("o_orderkey", "row_id", "cust_row")
