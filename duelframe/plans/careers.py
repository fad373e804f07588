"""Careers: events as dated competitor histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.numeric import finite_or_max
from duelframe.operators.windows import (
    career_windows, chunk, flatten_windows, impute_group_mean, kfold, label_columns,
    top_n_per_group, with_min_rows,
)
from duelframe.plans.registry import register, table

# One competitor = one user; a bout = one event; the "win" = a purchase.
_EVENTS_SQL = """(SELECT user_id, ts, event_id, value,
                         CAST(event_type = 'purchase' AS INTEGER) AS won
                  FROM {source})"""


def event_careers(spark, sf_dir, n=5, f=1, drop_last=True, split_hot_keys="auto"):
    ev = table(spark, sf_dir, "events").withColumn(
        "won", (F.col("event_type") == "purchase").cast("int"))
    return career_windows(ev, "user_id", ["ts", "event_id"], ["ts", "value", "won"],
                          n=n, f=f, label="won", drop_last=drop_last,
                          split_hot_keys=split_hot_keys)


def _summarise(w, f):
    feats = F.col("features")
    out = w.select(
        "user_id", "win_start",
        F.element_at(feats, 1)["ts"].alias("start_ts"),
        F.element_at(feats, -1)["ts"].alias("end_ts"),
        F.size(feats).alias("n_rows"),
        F.round(F.aggregate(feats, F.lit(0.0), lambda a, s: a + s["value"]) / F.size(feats), 6)
         .alias("value_mean"),
        F.element_at(feats, 1)["value"].alias("first_value"),
        F.element_at(feats, -1)["value"].alias("last_value"),
        F.aggregate(feats, F.lit(0), lambda a, s: a + s["won"]).alias("wins_in_window"),
        "labels")
    return label_columns(out, "labels", f).drop("labels")


def _oracle(n, f, drop_last, source="events"):
    last = f"sz - {n} - {f}" + ("" if drop_last else " + 1")
    labels = ",\n".join(
        f"lead(won, {n + i}) OVER w AS label_{i + 1}" for i in range(f))
    return f"""
WITH e AS {_EVENTS_SQL.format(source=source)},
r AS (
  SELECT user_id, ts, value, won,
         row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY user_id) AS sz,
         last_value(ts) OVER (w ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS end_ts,
         round(avg(value) OVER (w ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING), 6) AS value_mean,
         last_value(value) OVER (w ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS last_value,
         sum(won) OVER (w ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS wins_in_window,
         {labels}
  FROM e
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
SELECT user_id, rn AS win_start, ts AS start_ts, end_ts, {n} AS n_rows, value_mean,
       value AS first_value, last_value, CAST(wins_in_window AS INTEGER) AS wins_in_window,
       {", ".join(f"label_{i + 1}" for i in range(f))}
FROM r
WHERE sz >= {n + f} AND rn <= {last}
"""


@register("career_windows", _oracle(5, 1, True))
def q_career_windows(spark, sf_dir):
    """Flagship: last-5 windows with the next outcome, reference count rule (Q1)."""
    return _summarise(event_careers(spark, sf_dir, 5, 1, True), 1)


@register("career_windows_all_f2", _oracle(5, 2, False))
def q_career_windows_all_f2(spark, sf_dir):
    """N=5, F=2, every complete window (drop_last=False)."""
    return _summarise(event_careers(spark, sf_dir, 5, 2, False), 2)


@register("career_min_rows", """
SELECT event_id, user_id FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 70)
""")
def q_career_min_rows(spark, sf_dir):
    """Competitors with at least 70 rows."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    return with_min_rows(ev, "user_id", 70)


@register("career_vectors", """
WITH e AS (SELECT user_id, ts, event_id, value,
                  CAST(event_type = 'purchase' AS INTEGER) AS won FROM events),
r AS (
  SELECT user_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS sz,
         round(sum(value + won) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), 6) AS flat_sum,
         lead(value, 2) OVER w AS chunk3_value,
         lead(won, 2) OVER w AS chunk3_won
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, rn AS win_start, 10 AS flat_len, 5 AS n_chunks, flat_sum,
       CAST(chunk3_value AS DOUBLE) AS chunk3_value, CAST(chunk3_won AS DOUBLE) AS chunk3_won
FROM r WHERE sz >= 6 AND rn <= sz - 6
""")
def q_career_vectors(spark, sf_dir):
    """W8 + W9: flatten each window to one vector, reshape to (N, C)."""
    w = event_careers(spark, sf_dir, 5, 1, True)
    flat = w.select("user_id", "win_start",
                    flatten_windows("features", ["value", "won"]).alias("flat"))
    ch = flat.withColumn("chunks", chunk("flat", 2))
    return ch.select(
        "user_id", "win_start", F.size("flat").alias("flat_len"),
        F.size("chunks").alias("n_chunks"),
        F.round(F.aggregate("flat", F.lit(0.0), lambda a, x: a + x), 6).alias("flat_sum"),
        F.get(F.get("chunks", 2), 0).alias("chunk3_value"),
        F.get(F.get("chunks", 2), 1).alias("chunk3_won"))


@register("impute_group_mean", """
WITH p AS (SELECT p_partkey, p_type, CAST(nullif(p_size % 5, 0) AS DOUBLE) AS p_size_n FROM part)
SELECT p_partkey, p_type,
       round(coalesce(p_size_n, avg(p_size_n) OVER (PARTITION BY p_type)), 6) AS p_size_imputed
FROM p
""")
def q_impute_group_mean(spark, sf_dir):
    """NULL -> mean of the competitor's group."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type",
        F.nullif(F.col("p_size") % 5, F.lit(0)).cast("double").alias("p_size_n"))
    out = impute_group_mean(p, "p_type", ["p_size_n"])
    return out.select("p_partkey", "p_type", F.round("p_size_n", 6).alias("p_size_imputed"))


@register("kfold_contiguous", """
SELECT o_orderkey, CAST(ntile(20) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders
""")
def q_kfold(spark, sf_dir):
    """20 contiguous, unshuffled folds."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return kfold(o, 20, ["o_orderkey"]).select("o_orderkey", "fold")


@register("top_orders_per_customer", """
SELECT o_custkey, o_orderkey, o_totalprice, rk FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
  FROM orders) WHERE rk <= 3
""")
def q_top_orders(spark, sf_dir):
    """The three largest orders of each customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"], 3,
                           rank_name="rk")


@register("window_labels_int", """
WITH e AS (SELECT user_id, ts, event_id, CAST(event_type = 'purchase' AS INTEGER) AS won FROM events),
r AS (SELECT user_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS sz,
             lead(won, 5) OVER w AS label_1, lead(won, 6) OVER w AS label_2,
             lead(won, 7) OVER w AS label_3
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, rn AS win_start, label_1, label_2, label_3 FROM r WHERE sz >= 8 AND rn <= sz - 8
""")
def q_label_columns(spark, sf_dir):
    """A label array of three outcomes -> three int columns."""
    w = event_careers(spark, sf_dir, 5, 3, True)
    return label_columns(w, "labels", 3).select("user_id", "win_start", "label_1",
                                                "label_2", "label_3")


__all__ = ["event_careers", "finite_or_max"]


@register("bout_careers", """
WITH two AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
                    l_discount + 0.0 AS d, l_tax + 0.0 AS t,
                    CASE l_returnflag WHEN 'R' THEN 'Red' WHEN 'A' THEN 'Blue' ELSE 'Draw' END AS Winner
             FROM lineitem),
c AS (SELECT concat('R', CAST(l_partkey AS VARCHAR)) AS competitor, l_shipdate, l_orderkey, l_linenumber,
             d AS landed, t AS att, CAST(Winner = 'Red' AS INTEGER) AS won FROM two WHERE Winner <> 'Draw'
      UNION ALL
      SELECT concat('B', CAST(l_suppkey AS VARCHAR)), l_shipdate, l_orderkey, l_linenumber,
             t, d, CAST(Winner = 'Blue' AS INTEGER) FROM two WHERE Winner <> 'Draw'),
r AS (SELECT competitor, row_number() OVER w AS rn, count(*) OVER (PARTITION BY competitor) AS sz,
             round(avg(landed) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 6) AS landed_mean,
             sum(won) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS wins,
             lead(won, 3) OVER w AS label_1
      FROM c WINDOW w AS (PARTITION BY competitor ORDER BY l_shipdate, l_orderkey, l_linenumber, landed, att, won))
SELECT competitor, rn AS win_start, landed_mean, CAST(wins AS INTEGER) AS wins, label_1
FROM r WHERE sz >= 4 AND rn <= sz - 4
""")
def q_bout_careers(spark, sf_dir):
    """The reference's career build end to end: two-sided rows -> competitor
    rows without draws (U1) -> last-3 windows with the next outcome (W2-W4)."""
    from duelframe.operators.reshape import split_sides
    from duelframe.plans.reshaping import two_sided_lineitem

    two = two_sided_lineitem(spark, sf_dir).withColumn("R_id", F.concat(F.lit("R"), F.col("R_key").cast("string"))) \
        .withColumn("B_id", F.concat(F.lit("B"), F.col("B_key").cast("string"))).drop("R_key", "B_key")
    comp = split_sides(two, flag="int", side_col=None)
    w = career_windows(comp, "id", ["l_shipdate", "l_orderkey", "l_linenumber", "landed", "att",
                                    "Winner"],
                       ["landed", "Winner"], n=3, f=1, label="Winner")
    feats = F.col("features")
    out = w.select(F.col("id").alias("competitor"), "win_start",
                   F.round(F.aggregate(feats, F.lit(0.0), lambda a, s: a + s["landed"]) / 3, 6)
                    .alias("landed_mean"),
                   F.aggregate(feats, F.lit(0), lambda a, s: a + s["Winner"]).alias("wins"),
                   "labels")
    return label_columns(out, "labels", 1).drop("labels")


_HOT_EVENTS = ("(SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, "
               "event_type, value FROM events)")
_HOT_SQL = _oracle(5, 1, True, _HOT_EVENTS)


@register("career_windows_hot_key", _HOT_SQL)
def q_career_windows_hot_key(spark, sf_dir):
    """W2-W4 with one competitor holding a third of all rows (every third
    user folded into user 0): the block-split plan, forced, with small blocks
    so that block boundaries are crossed at every scale."""
    ev = table(spark, sf_dir, "events").withColumn(
        "won", (F.col("event_type") == "purchase").cast("int")).withColumn(
        "user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    w = career_windows(ev, "user_id", ["ts", "event_id"], ["ts", "value", "won"], n=5, f=1,
                       label="won", split_hot_keys=True, block_rows=512, partitions=8)
    return _summarise(w, 1)
