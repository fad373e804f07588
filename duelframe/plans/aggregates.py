"""Aggregations over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.numeric import row_mean
from duelframe.operators import aggs as A
from duelframe.plans import sqlx as S
from duelframe.plans.registry import register, table


def _part_with_nulls(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_type",
                    F.nullif(F.col("p_size") % 5, F.lit(0)).cast("double").alias("p_size_n"),
                    F.nullif(F.col("p_name"), F.lit("red bolt")).alias("p_name_n"),
                    "p_retailprice")


_PART_NULLS = """(SELECT p_partkey, p_type, CAST(nullif(p_size % 5, 0) AS DOUBLE) AS p_size_n,
                         nullif(p_name, 'red bolt') AS p_name_n, p_retailprice FROM part)"""


@register("group_count", """
SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL
""")
def q_group_count(spark, sf_dir):
    """A1."""
    return A.group_count(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("value_counts_two_columns", """
SELECT value, count(*) AS count FROM (
  SELECT l_partkey AS value FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem)
GROUP BY value
""")
def q_value_counts_multi(spark, sf_dir):
    """A2: frequency over the union of two key columns (both sides of a bout)."""
    return A.value_counts_multi(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@register("value_counts", """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS count FROM orders GROUP BY ALL
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL
""")
def q_value_counts(spark, sf_dir):
    """A3: frequency tables of several columns."""
    return A.value_counts(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("group_mean", f"""
SELECT p_type, round(avg(p_size_n), 6) AS p_size_n, round(avg(p_retailprice), 6) AS p_retailprice
FROM {_PART_NULLS} GROUP BY p_type
""")
def q_group_mean(spark, sf_dir):
    """A4: NULL-ignoring group mean."""
    m = A.group_mean(_part_with_nulls(spark, sf_dir), "p_type", ["p_size_n", "p_retailprice"])
    return m.select("p_type", F.round("p_size_n", 6).alias("p_size_n"),
                    F.round("p_retailprice", 6).alias("p_retailprice"))


@register("null_profile", f"""
SELECT 'p_partkey' AS "column", count(*) - count(p_partkey) AS nulls FROM {_PART_NULLS}
UNION ALL SELECT 'p_type', count(*) - count(p_type) FROM {_PART_NULLS}
UNION ALL SELECT 'p_size_n', count(*) - count(p_size_n) FROM {_PART_NULLS}
UNION ALL SELECT 'p_name_n', count(*) - count(p_name_n) FROM {_PART_NULLS}
UNION ALL SELECT 'p_retailprice', count(*) - count(p_retailprice) FROM {_PART_NULLS}
""")
def q_null_profile(spark, sf_dir):
    """A5: nulls per column in one pass."""
    return A.null_profile(_part_with_nulls(spark, sf_dir))


@register("null_totals", f"""
WITH p AS (SELECT count(*) - count(p_size_n) AS a, count(*) - count(p_name_n) AS b FROM {_PART_NULLS})
SELECT a + b AS total_nulls, CAST((a > 10)::INT + (b > 10)::INT AS BIGINT) AS columns_over FROM p
""")
def q_null_totals(spark, sf_dir):
    """Total nulls; columns with more than 10."""
    return A.null_totals(_part_with_nulls(spark, sf_dir), 10)


@register("has_null", f"""
SELECT bool_or(p_size_n IS NULL) AS has_null FROM {_PART_NULLS}
""")
def q_has_null(spark, sf_dir):
    """Integrity flag after a join."""
    return A.has_null(_part_with_nulls(spark, sf_dir), "p_size_n")


@register("shape", """
SELECT count(*) AS rows, 5 AS columns FROM part
""")
def q_shape(spark, sf_dir):
    """A8."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size",
                                            "p_retailprice")
    return A.shape(p)


@register("column_stats", f"""
SELECT 'p_partkey' AS "column", 'bigint' AS dtype, count(p_partkey) AS non_null FROM {_PART_NULLS}
UNION ALL SELECT 'p_type', 'string', count(p_type) FROM {_PART_NULLS}
UNION ALL SELECT 'p_size_n', 'double', count(p_size_n) FROM {_PART_NULLS}
UNION ALL SELECT 'p_name_n', 'string', count(p_name_n) FROM {_PART_NULLS}
UNION ALL SELECT 'p_retailprice', 'double', count(p_retailprice) FROM {_PART_NULLS}
""")
def q_column_stats(spark, sf_dir):
    """Column, dtype, non-null count."""
    return A.column_stats(_part_with_nulls(spark, sf_dir))


@register("distinct_values", """
SELECT DISTINCT o_orderpriority FROM orders
""")
def q_distinct_values(spark, sf_dir):
    """A10."""
    return A.distinct_values(table(spark, sf_dir, "orders"), "o_orderpriority")


@register("mean_over_runs", """
SELECT l_linenumber, round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax
FROM lineitem GROUP BY l_linenumber
""")
def q_mean_over_runs(spark, sf_dir):
    """Line number plays the repetition."""
    m = A.mean_over_runs(table(spark, sf_dir, "lineitem"), "l_linenumber", ["l_discount", "l_tax"])
    return m.select("l_linenumber", F.round("l_discount", 6).alias("l_discount"),
                    F.round("l_tax", 6).alias("l_tax"))


@register("median_over_folds", """
SELECT l_linenumber, round(median(l_quantity), 6) AS l_quantity,
       round(median(l_extendedprice), 6) AS l_extendedprice
FROM lineitem GROUP BY l_linenumber
""")
def q_median_over_folds(spark, sf_dir):
    """Exact interpolated median."""
    m = A.median_over_folds(table(spark, sf_dir, "lineitem"), "l_linenumber",
                            ["l_quantity", "l_extendedprice"])
    return m.select("l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                    F.round("l_extendedprice", 6).alias("l_extendedprice"))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def lineitem_label(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*_CORR_COLS, (F.col("l_returnflag") == "R").cast("int").alias("label"))


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(l_returnflag = 'R' AS DOUBLE)) AS corr "
    f"FROM lineitem" for c in _CORR_COLS)


@register("label_correlation", f"""
SELECT feature, round(corr, 6) AS corr FROM ({CORR_SQL}) WHERE corr IS NOT NULL AND NOT isnan(corr)
""")
def q_label_correlation(spark, sf_dir):
    """Correlation of every numeric column with the label."""
    c = A.label_correlation(lineitem_label(spark, sf_dir), "label")
    return c.select("feature", F.round("corr", 6).alias("corr"))


@register("five_number", """
SELECT l_linenumber, "column", round(q[1], 6) AS min, round(q[2], 6) AS q1, round(q[3], 6) AS median,
       round(q[4], 6) AS q3, round(q[5], 6) AS max
FROM (SELECT l_linenumber, 'l_quantity' AS "column",
             quantile_cont(l_quantity, [0, 0.25, 0.5, 0.75, 1]) AS q FROM lineitem GROUP BY l_linenumber
      UNION ALL
      SELECT l_linenumber, 'l_discount', quantile_cont(l_discount, [0, 0.25, 0.5, 0.75, 1])
      FROM lineitem GROUP BY l_linenumber)
""")
def q_five_number(spark, sf_dir):
    """The numbers behind box plots."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount") + 0.0)
    f = A.five_number(li, ["l_quantity", "l_discount"], "l_linenumber")
    return f.select("l_linenumber", "column",
                    *[F.round(c, 6).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


@register("row_mean", """
SELECT p_partkey, round((p_size + p_retailprice) / 2, 6) AS size_price_mean FROM part
""")
def q_row_mean(spark, sf_dir):
    """Row mean of two columns."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.round(row_mean("p_size", "p_retailprice"), 6)
                    .alias("size_price_mean"))


@register("argmin_per_order", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_extendedprice, l_linenumber, l_partkey, l_suppkey) AS rk
  FROM lineitem) WHERE rk = 1
""")
def q_argmin(spark, sf_dir):
    """The cheapest line of each order (ties by line number, then keys)."""
    from duelframe.operators.joins import argmin

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_suppkey", "l_extendedprice")
    best = argmin(li, "l_orderkey", "l_extendedprice", ["l_linenumber", "l_partkey", "l_suppkey"])
    return best.select("l_orderkey", "l_linenumber", "l_extendedprice")


@register("numeric_cleanup", """
WITH r AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'NaN'::DOUBLE
                       WHEN l_tax = 0 THEN 'inf'::DOUBLE
                       ELSE (l_discount + 0.0) / l_tax END AS x,
                  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS q,
                  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN isnan(x) THEN 0 WHEN x = 'inf'::DOUBLE THEN 1.7976931348623157e308
                  WHEN x = '-inf'::DOUBLE THEN -1.7976931348623157e308 ELSE x END, 6) AS x_finite,
       coalesce(q, 0) AS q_filled, coalesce(flag, 'Orthodox') AS flag_filled,
       floor(abs(CASE WHEN isnan(x) OR isinf(x) THEN 0 ELSE x END) * 100) AS x_pct
FROM r
""")
def q_numeric_cleanup(spark, sf_dir):
    """F18 + F19 + F20 + F21: NaN/inf made by expression, then cleaned."""
    from duelframe.functions.numeric import abs_percent, fill_category, fill_zero, finite_or_max

    li = table(spark, sf_dir, "lineitem")
    x = (F.when((F.col("l_tax") == 0) & (F.col("l_discount") == 0), F.lit(float("nan")))
          .when(F.col("l_tax") == 0, F.lit(float("inf")))
          .otherwise((F.col("l_discount") + 0.0) / F.col("l_tax")))
    r = li.select("l_orderkey", "l_linenumber", x.alias("x"),
                  F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("l_quantity"))
                  .alias("q"),
                  F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_returnflag"))
                  .alias("flag"))
    r = fill_category(fill_zero(r.withColumn("x_finite", F.round(finite_or_max("x"), 6))
                                 .withColumn("x_pct", F.floor(abs_percent(
                                     F.when(F.isnan("x") | (F.abs("x") == float("inf")), 0.0)
                                      .otherwise(F.col("x")))).cast("double"))
                                 .drop("x")),
                      {"flag": "Orthodox"})
    return r.select("l_orderkey", "l_linenumber", "x_finite", F.col("q").alias("q_filled"),
                    F.col("flag").alias("flag_filled"), "x_pct")


@register("edit_scores", f"""
SELECT p_partkey, levenshtein(p_name, p_type) AS distance,
       round({S.indel_ratio('p_name', 'p_type')}, 6) AS ratio
FROM part
""")
def q_edit_scores(spark, sf_dir):
    """F12 + F13 row-wise: edit distance and indel similarity of two text columns."""
    from duelframe.functions.text import edit_distance, indel_ratio

    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", edit_distance("p_name", "p_type").cast("bigint").alias("distance"),
                    F.round(indel_ratio("p_name", "p_type"), 6).alias("ratio"))


@register("feature_columns", """
SELECT l_orderkey, l_linenumber, 7 AS n_features,
       round(l_orderkey + l_partkey + l_suppkey + l_linenumber + l_quantity + l_extendedprice
             + l_discount + l_tax, 6) AS feature_sum,
       CAST(l_returnflag = 'R' AS INTEGER) AS label
FROM lineitem
""")
def q_feature_columns(spark, sf_dir):
    """P6 + P7: numeric columns by dtype, all but the label as features."""
    from duelframe.operators.project import columns_by_type, split_label

    li = table(spark, sf_dir, "lineitem").withColumn(
        "label", (F.col("l_returnflag") == "R").cast("int"))
    num, _cat = columns_by_type(li)
    feats, label = split_label(li.select(*num), "label")
    feats = [c for c in feats if c != "l_orderkey"]
    total = F.col("l_orderkey").cast("double")
    for c in feats:
        total = total + F.col(c).cast("double")
    return li.select("l_orderkey", "l_linenumber", F.lit(len(feats)).alias("n_features"),
                     F.round(total, 6).alias("feature_sum"), F.col(label))
