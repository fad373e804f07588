"""Feature preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import prep as M
from duelframe.plans.aggregates import _CORR_COLS, CORR_SQL
from duelframe.plans.registry import register, table

_SPLIT = "substr(md5(concat_ws(':', CAST(o_orderkey AS VARCHAR), '{seed}')), 1, 8) < '{thr}'"


def _split_sql(seed, frac):
    return _SPLIT.format(seed=seed, thr=M.split_threshold(frac))


@register("label_encode", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority
FROM orders
""")
def q_label_encode(spark, sf_dir):
    """M1: alphabetical codes from 0."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return M.label_encode(o, ["o_orderpriority"])


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS c_mktsegment_{v}" for v in _SEGS)
    + " FROM customer")
def q_one_hot(spark, sf_dir):
    """M2: one-hot columns named col_value."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return M.one_hot(c, ["c_mktsegment"])


@register("one_hot_null_category", """
SELECT o_orderkey,
       CASE WHEN coalesce(nullif(o_orderstatus, 'P'), '0') = '0' THEN 1 ELSE 0 END AS st_0,
       CASE WHEN coalesce(nullif(o_orderstatus, 'P'), '0') = 'F' THEN 1 ELSE 0 END AS st_F,
       CASE WHEN coalesce(nullif(o_orderstatus, 'P'), '0') = 'O' THEN 1 ELSE 0 END AS st_O
FROM orders
""")
def q_one_hot_null_category(spark, sf_dir):
    """M2 with nulls='category' (Q10: NULL becomes its own '0' column)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"))
    return M.one_hot(o, ["st"], nulls="category")


@register("encode_auto", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
       CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 1 ELSE 0 END AS st_F,
       CASE WHEN nullif(o_orderstatus, 'P') = 'O' THEN 1 ELSE 0 END AS st_O
FROM orders
""")
def q_encode_auto(spark, sf_dir):
    """M3: a column without nulls is label-encoded, one with nulls one-hot encoded."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"))
    return M.encode_auto(o)


@register("one_hot_sparse", """
WITH o AS (SELECT o_orderkey, nullif(CAST(o_custkey AS VARCHAR), '1') AS c, CAST(o_orderdate AS VARCHAR) AS d FROM orders),
c AS (SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY c) - 1 AS INTEGER) AS place FROM o WHERE c IS NOT NULL),
n AS (SELECT count(DISTINCT c) AS n FROM o),
d AS (SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY d) - 1 + n AS INTEGER) AS place FROM o, n)
SELECT o_orderkey, place, 1.0::DOUBLE AS value FROM (SELECT * FROM c UNION ALL SELECT * FROM d)
""")
def q_one_hot_sparse(spark, sf_dir):
    """M2 with any number of values: customers (one of them NULL) and order dates as one sparse vector."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey").cast("string"), F.lit("1")).alias("c"), F.col("o_orderdate").cast("string").alias("d"))
    return M.sparse_entries(M.one_hot_vector(o, ["c", "d"], output="v"), "o_orderkey", "v")


@register("scale_train_test", f"""
WITH o AS (SELECT o_orderkey, o_totalprice, {_split_sql(7, 0.8)} AS is_train FROM orders),
s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd, min(o_totalprice) AS lo,
             max(o_totalprice) AS hi FROM o WHERE is_train)
SELECT o_orderkey, is_train, round((o_totalprice - m) / sd, 6) AS z,
       round((o_totalprice - lo) / (hi - lo), 6) AS mm
FROM o, s
""")
def q_scale(spark, sf_dir):
    """M4 + M5 + M6: fit standard and min-max scaling on the train rows only."""
    o = M.split(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                "o_orderkey", 0.8, 7)
    o = o.withColumn("v", F.col("o_totalprice"))
    z = M.standardize(o, ["o_totalprice"], F.col("is_train"), "_z")
    z = M.minmax(z, ["v"], F.col("is_train"), "_mm")
    return z.select("o_orderkey", "is_train", F.round("o_totalprice_z", 6).alias("z"),
                    F.round("v_mm", 6).alias("mm"))


@register("split_random", f"SELECT o_orderkey, {_split_sql(1, 0.9)} AS is_train FROM orders")
def q_split(spark, sf_dir):
    """M6: repeatable 90/10 split."""
    return M.split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.9, 1)


@register("split_stratified", """
WITH o AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus
                                     ORDER BY substr(md5(concat_ws(':', CAST(o_orderkey AS VARCHAR), '3')), 1, 8), o_orderkey) AS rn,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, rn <= floor(n * 0.75 + 0.5) AS is_train FROM o
""")
def q_split_stratified(spark, sf_dir):
    """M7: stratified 75/25 by order status."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return M.split_stratified(o, "o_orderkey", "o_orderstatus", 0.75, 3)


@register("feature_set_correlated", f"""
WITH c AS (SELECT feature, abs(corr) * 100 AS score FROM ({CORR_SQL})
           WHERE corr IS NOT NULL AND NOT isnan(corr)),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, feature DESC) AS rk, count(*) OVER () AS n FROM c),
f AS (SELECT feature FROM r WHERE rk <= greatest(floor(n / 2), 1)),
u AS (SELECT row_key, feature, value, label FROM (
    SELECT l_orderkey || '-' || l_linenumber AS row_key, CAST(l_returnflag = 'R' AS INTEGER) AS label,
           """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CORR_COLS) + """ FROM lineitem)
    UNPIVOT INCLUDE NULLS (value FOR feature IN (""" + ", ".join(_CORR_COLS) + """)))
SELECT row_key, feature, round(value, 6) AS value, label FROM u WHERE feature IN (SELECT feature FROM f)
""")
def q_feature_set_correlated(spark, sf_dir):
    """M17 + M22: keep the correlated half of the features."""
    li = table(spark, sf_dir, "lineitem")
    df = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_key"), *[F.col(c).cast("double").alias(c) for c in _CORR_COLS],
                   (F.col("l_returnflag") == "R").cast("int").alias("label"))
    chosen = M.feature_set(df, "correlated", "label", keep=["row_key"])
    long = chosen.unpivot(["row_key", "label"], [c for c in chosen.columns if c in _CORR_COLS], "feature", "value")
    return long.select("row_key", "feature", F.round("value", 6).alias("value"), "label")


@register("feature_set_no_avg", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
""")
def q_feature_set_no_avg(spark, sf_dir):
    """The variant without the avg_ columns."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_discount").alias("avg_discount"),
        F.col("l_tax").alias("avg_tax"))
    return M.feature_set(li, "no_avg")


@register("clean_competitors", """
WITH p AS (SELECT p_partkey, p_type, CAST(nullif(p_size % 5, 0) AS DOUBLE) AS p_size_n,
                  nullif(p_brand, 'Brand#13') AS stance, p_retailprice FROM part),
i AS (SELECT p_partkey, p_type, coalesce(p_size_n, avg(p_size_n) OVER (PARTITION BY p_type)) AS p_size_n,
             coalesce(stance, 'Orthodox') AS stance, p_retailprice FROM p)
SELECT p_partkey, p_type, round(CASE WHEN p_size_n > 3 THEN 3.0 ELSE p_size_n END, 6) AS p_size_n,
       stance, p_retailprice
FROM i WHERE p_retailprice IS NOT NULL
""")
def q_clean_competitors(spark, sf_dir):
    """W6 + F19 + P9 + P13 in one plan."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.nullif(F.col("p_size") % 5, F.lit(0)).cast("double").alias("p_size_n"),
        F.nullif(F.col("p_brand"), F.lit("Brand#13")).alias("stance"), "p_retailprice")
    out = M.clean_competitors(p, "p_type", ["p_size_n"], {"stance": "Orthodox"},
                              ["p_retailprice"], [(F.col("p_size_n") > 3, "p_size_n", 3.0)])
    return out.withColumn("p_size_n", F.round("p_size_n", 6))


@register("prepare_careers", """
SELECT o_orderkey, o_custkey,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
       CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 1 ELSE 0 END AS st_F,
       CASE WHEN nullif(o_orderstatus, 'P') = 'O' THEN 1 ELSE 0 END AS st_O,
       coalesce(CAST(nullif(o_custkey % 4, 0) AS DOUBLE), 0) AS cust_mod
FROM orders
""")
def q_prepare_careers(spark, sf_dir):
    """Drop, encode by the null rule, fill the rest with 0."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"),
        F.nullif(F.col("o_custkey") % 4, F.lit(0)).cast("double").alias("cust_mod"))
    return M.prepare_careers(o, ["o_totalprice"], ["o_orderkey"])
