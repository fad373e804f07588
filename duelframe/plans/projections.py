"""Projections and predicates over orders / customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import project as P
from duelframe.plans.registry import register, table


@register("drop_select_reorder", """
SELECT o_orderdate, o_orderkey, o_orderpriority, o_orderstatus FROM orders
""")
def q_drop_select(spark, sf_dir):
    """P1 + P2 + P5: drop by list, keep by name pattern, reorder."""
    o = P.drop_columns(table(spark, sf_dir, "orders"), ["o_totalprice"])
    o = P.select_matching(o, r"^o_order")
    return o.select("o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")


@register("rename_columns", """
SELECT c_custkey AS id, c_name AS competitor, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer
""")
def q_rename(spark, sf_dir):
    """P3 + P4: mapping rename, then anchored prefix strip."""
    c = P.rename(table(spark, sf_dir, "customer"), {"c_custkey": "id", "c_name": "competitor"})
    return P.strip_prefix(c, "c_")


@register("drop_value_nullsafe", """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '2-HIGH') AS prio FROM orders)
SELECT o_orderkey, prio FROM o WHERE prio IS DISTINCT FROM '1-URGENT'
""")
def q_drop_value(spark, sf_dir):
    """Drop rows equal to a value, keep NULL rows."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("2-HIGH")).alias("prio"))
    return P.drop_value(o, "prio", "1-URGENT")


@register("null_rows", """
SELECT p_partkey FROM part WHERE nullif(p_size % 5, 0) IS NULL
""")
def q_null_rows(spark, sf_dir):
    """Rows with a NULL in the column."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif(F.col("p_size") % 5, F.lit(0)).alias("s"))
    return P.null_rows(p, "s").select("p_partkey")


@register("drop_blank", """
SELECT c_custkey, seg FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS seg
                            FROM customer) WHERE seg <> ''
""")
def q_drop_blank(spark, sf_dir):
    """P10: drop empty strings."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_mktsegment"))
        .alias("seg"))
    return P.drop_blank(c, ["seg"])


@register("compound_predicate", """
SELECT o_orderkey FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice > 100000) OR o_orderpriority = '1-URGENT'
""")
def q_compound(spark, sf_dir):
    """P11."""
    o = table(spark, sf_dir, "orders")
    cond = (((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
            | (F.col("o_orderpriority") == "1-URGENT"))
    return o.filter(cond).select("o_orderkey")


@register("binary_label", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished FROM orders
""")
def q_binary_label(spark, sf_dir):
    """P12."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", P.binary_label("o_orderstatus", "F").alias("finished"))


@register("replace_where", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def q_replace_where(spark, sf_dir):
    """Conditional overwrite."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return P.replace_where(c, F.col("c_acctbal") < 0, "c_mktsegment", "OTHER").select(
        "c_custkey", "c_mktsegment")


@register("skip_status", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def q_skip_status(spark, sf_dir):
    """Skip rows by status text."""
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") != "P").select("o_orderkey")


@register("try_casts", """
SELECT c_custkey, TRY_CAST(string_split(c_name, '#')[2] AS INTEGER) AS name_num,
       TRY_CAST(c_mktsegment AS DOUBLE) AS seg_num, CAST(c_acctbal > 0 AS BOOLEAN) AS positive,
       CAST(trunc(c_acctbal) AS BIGINT) AS acct_int
FROM customer
""")
def q_try_casts(spark, sf_dir):
    """float/int/bool casts; bad text -> NULL instead of an error."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    P.try_cast(F.expr("try_element_at(split(c_name, '#'), 2)"), "int")
                    .alias("name_num"),
                    P.try_cast("c_mktsegment", "double").alias("seg_num"),
                    (F.col("c_acctbal") > 0).cast("boolean").alias("positive"),
                    F.col("c_acctbal").cast("bigint").alias("acct_int"))


@register("if_column", """
SELECT o_orderkey, round(o_totalprice, 0) AS o_totalprice FROM orders
""")
def q_if_column(spark, sf_dir):
    """Transformations applied only when the column exists."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    o = P.if_column(o, "o_totalprice", lambda d: d.withColumn("o_totalprice",
                                                              F.round("o_totalprice", 0)))
    return P.if_column(o, "o_comment", lambda d: d.drop("o_comment"))
