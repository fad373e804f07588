"""Joins over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.keys import name_pairs, normalize_name, pair_key
from duelframe.operators import joins as J
from duelframe.operators.joins import broadcast_if_small
from duelframe.operators.project import winner_loser
from duelframe.plans import sqlx as S
from duelframe.plans.registry import register, table

_KEY = S.pair_key(S.normalize_name("a"), S.normalize_name("b"))


@register("pair_join", f"""
WITH b AS (SELECT doc_id, lang, pos, {_KEY} AS k FROM {S.word_pairs("documents", "doc_id", "lang")}),
c AS (SELECT conv_id, turn, role, pos, {_KEY} AS k
      FROM {S.word_pairs("conversations", "conv_id", "turn", "role")}),
f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY conv_id, turn, pos) = 1)
SELECT b.doc_id, b.lang, b.pos, f.conv_id AS sc_conv_id, f.turn AS sc_turn, f.role AS sc_role,
       f.pos AS sc_pos
FROM b LEFT JOIN f ON b.k = f.k
""")
def q_pair_join(spark, sf_dir):
    """Documents ⟕ conversations on the order-insensitive pair of every two
    neighbouring words (conversation words swapped); cards deduplicated (A11)."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.posexplode(name_pairs("text")).alias("pos", "w")).select(
        "doc_id", "lang", "pos", pair_key("w.a", "w.b").alias("_k"))
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.posexplode(name_pairs("text")).alias("pos", "w")).select(
        "conv_id", "turn", "role", "pos", pair_key("w.b", "w.a").alias("_k"))
    c = J.dedupe_first(c, "_k", ["conv_id", "turn", "pos"])
    out = J.pair_join(d, c, "_k", "_k")
    return out.select("doc_id", "lang", "pos", "sc_conv_id", "sc_turn", "sc_role", "sc_pos")


_NLOC = "concat(n_name, ', Centre, ', r_name)"
_DIM = f"""(SELECT {_NLOC} AS location, n_nationkey * CAST(10.5 AS DOUBLE) AS location_elevation,
                   n_nationkey AS dim_id
            FROM nation JOIN region ON n_regionkey = r_regionkey
            UNION ALL
            SELECT concat(n_name, ', ', r_name), n_nationkey * CAST(10.5 AS DOUBLE) + 1, n_nationkey + 100
            FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _location_inputs(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) do not grow with the scale factor
    nr = n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey)
    dim = nr.select(F.concat("n_name", F.lit(", Centre, "), "r_name").alias("location"),
                    (F.col("n_nationkey") * 10.5).alias("location_elevation"),
                    F.col("n_nationkey").alias("dim_id")).unionByName(
          nr.select(F.concat("n_name", F.lit(", "), "r_name").alias("location"),
                    (F.col("n_nationkey") * 10.5 + 1).alias("location_elevation"),
                    (F.col("n_nationkey") + 100).alias("dim_id")))
    cust = table(spark, sf_dir, "customer").join(
        broadcast_if_small(nr.select("n_nationkey", F.concat("n_name", F.lit(" , somewhere ,"),
                                                      F.lit(" "), "r_name").alias("loc"))),
        F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "loc")
    return cust, dim


_CUSTLOC = """(SELECT c_custkey, concat(n_name, ' , somewhere , ', r_name) AS loc
               FROM customer JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey)"""


@register("location_join_fanout", f"""
SELECT c.c_custkey, d.location_elevation, d.dim_id
FROM {_CUSTLOC} c LEFT JOIN {_DIM} d ON {S.place_key('c.loc')} = {S.place_key('d.location')}
""")
def q_location_join_fanout(spark, sf_dir):
    """J2 with dedupe='none': duplicate place keys in the dimension fan out (Q9)."""
    cust, dim = _location_inputs(spark, sf_dir)
    return J.location_join(cust, dim, "loc", "location").select(
        "c_custkey", "location_elevation", "dim_id")


@register("location_join_first", f"""
WITH d AS (SELECT {S.place_key('location')} AS k, location_elevation, dim_id,
                  row_number() OVER (PARTITION BY {S.place_key('location')} ORDER BY dim_id) AS rk
           FROM {_DIM})
SELECT c.c_custkey, d.location_elevation, d.dim_id
FROM {_CUSTLOC} c LEFT JOIN (SELECT * FROM d WHERE rk = 1) d ON {S.place_key('c.loc')} = d.k
""")
def q_location_join_first(spark, sf_dir):
    """J2 with dedupe='first' (one dimension row per key, smallest dim_id)."""
    cust, dim = _location_inputs(spark, sf_dir)
    return J.location_join(cust, dim, "loc", "location", dedupe="first",
                           dim_order=["dim_id"]).select("c_custkey", "location_elevation",
                                                        "dim_id")


@register("two_role_lookup", """
SELECT l_orderkey, l_linenumber,
       CAST(trunc(p.p_retailprice) AS INTEGER) AS R_price,
       CAST(trunc(s.s_acctbal) AS INTEGER) AS B_acctbal
FROM lineitem
LEFT JOIN part p ON l_partkey = p.p_partkey
LEFT JOIN supplier s ON l_suppkey = s.s_suppkey
""")
def q_two_role_lookup(spark, sf_dir):
    """Red side looks up the part price, blue side the supplier balance."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("R_key"),
        F.col("l_suppkey").alias("B_key"))
    out = J.lookup(li, table(spark, sf_dir, "part"), "R_key", "p_partkey", "p_retailprice",
                   "R_price", cast="int")
    out = J.lookup(out, table(spark, sf_dir, "supplier"), "B_key", "s_suppkey", "s_acctbal",
                   "B_acctbal", cast="int")
    return out.select("l_orderkey", "l_linenumber", "R_price", "B_acctbal")


@register("customers_without_orders", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")
def q_unmatched(spark, sf_dir):
    """Customers without a finished order (left anti join)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("c_custkey"))
    return J.unmatched(c, o, "c_custkey")


_FWD = """
WITH dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT o_orderkey,
       CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT d FROM dates) THEN CAST(o_orderdate AS DATE)
            WHEN CAST(o_orderdate AS DATE) + 1 IN (SELECT d FROM dates) THEN CAST(o_orderdate AS DATE) + 1
       END AS match_date
FROM orders
"""


@register("forward_date_match", _FWD)
def q_forward_date(spark, sf_dir):
    """Same-day block, else the next day, else none."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_shipdate")
    return J.forward_date(o, li, "o_orderdate", "l_shipdate", 1).select(
        "o_orderkey", "match_date")


@register("best_match_join", f"""
WITH f AS ({_FWD}),
l AS (SELECT o.o_orderkey, f.match_date, o.o_orderpriority AS w, o.o_orderstatus AS s
      FROM orders o JOIN f USING (o_orderkey)),
r AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, p_name AS w, l_linestatus AS s
      FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT l.o_orderkey, r.l_orderkey, r.l_linenumber,
             (levenshtein(r.w, l.w) + levenshtein(r.s, l.s)) / 2.0 AS cost,
             row_number() OVER (PARTITION BY l.o_orderkey
                                ORDER BY (levenshtein(r.w, l.w) + levenshtein(r.s, l.s)) / 2.0,
                                         r.l_orderkey, r.l_linenumber) AS rk
      FROM l JOIN r ON r.d = l.match_date)
SELECT l.o_orderkey, l.match_date, c.cost AS match_cost,
       c.l_orderkey AS match_l_orderkey, c.l_linenumber AS match_l_linenumber
FROM l LEFT JOIN (SELECT * FROM c WHERE rk = 1) c USING (o_orderkey)
""")
def q_best_match_join(spark, sf_dir):
    """J5 + J6 + A12: each order's closest shipment of the same (or next) day;
    cost = mean edit distance of (priority, part name) and (status, line status)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority",
                                              "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_shipdate", "l_linestatus")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    r = li.join(p, li.l_partkey == p.p_partkey).drop("l_partkey", "p_partkey")
    out = J.best_match_join(o, r, "o_orderkey", ["l_orderkey", "l_linenumber"],
                            "o_orderdate", "l_shipdate",
                            ("o_orderpriority", "o_orderstatus"), ("p_name", "l_linestatus"),
                            right_cols=["l_orderkey", "l_linenumber"])
    return out.select("o_orderkey", "match_date", "match_cost", "match_l_orderkey",
                      "match_l_linenumber")


@register("update_from_patch", """
WITH p AS (SELECT o_orderkey, o_orderstatus, o_orderdate FROM (
             SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_shipdate AS o_orderdate,
                    row_number() OVER (PARTITION BY l_orderkey
                                       ORDER BY l_linenumber, l_shipdate, l_linestatus) AS rk
             FROM lineitem) WHERE rk = 1)
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN p.o_orderkey IS NOT NULL THEN p.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN p.o_orderkey IS NOT NULL THEN p.o_orderdate ELSE o.o_orderdate END AS o_orderdate
FROM orders o LEFT JOIN p USING (o_orderkey)
""")
def q_update_from(spark, sf_dir):
    """Overwrite two order columns from each order's first line (A11 patch)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
        F.col("l_linestatus").alias("o_orderstatus"), F.col("l_shipdate").alias("o_orderdate"))
    patch = J.dedupe_first(li, "o_orderkey", ["l_linenumber", "o_orderdate", "o_orderstatus"])
    return J.update_from(o, patch.drop("l_linenumber"), "o_orderkey",
                         ["o_orderstatus", "o_orderdate"])


@register("upsert_rows", """
WITH patch AS (
  SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier)
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM patch)
UNION ALL SELECT * FROM patch
""")
def q_upsert(spark, sf_dir):
    """Overwrite BUILDING customers, insert suppliers as new rows."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    base = c.select("c_custkey", "c_name", "c_acctbal")
    patch = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal")).unionByName(
        s.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"),
                 F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")))
    return J.upsert(base, patch, "c_custkey")


@register("zip_rows", """
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer),
b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders)
SELECT position, c_custkey, o_orderkey FROM a JOIN b USING (position)
""")
def q_zip_rows(spark, sf_dir):
    """Positional zip of two ranked lists."""
    a = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    b = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    z = J.zip_rows(a, b, [F.col("c_acctbal").desc(), F.col("c_custkey")],
                   ["o_totalprice", "o_orderkey"])
    return z.select("position", "c_custkey", "o_orderkey")


@register("reattach_labels", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)
""")
def q_reattach(spark, sf_dir):
    """Labels re-attached to documents by id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return J.reattach(d, table(spark, sf_dir, "labels"), "doc_id")


@register("join_suffixed", """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS date FROM orders),
l AS (SELECT l_orderkey AS k, max(CAST(l_shipdate AS DATE)) AS date FROM lineitem GROUP BY l_orderkey)
SELECT o.k, o.date AS date_x, l.date AS date_y FROM o LEFT JOIN l USING (k)
""")
def q_join_suffixed(spark, sf_dir):
    """Equal names get _x / _y."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"),
                                              F.col("o_orderdate").cast("date").alias("date"))
    li = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
          .agg(F.max(F.col("l_shipdate").cast("date")).alias("date")))
    return J.join_suffixed(o, li, "k", "left")


@register("dedupe_first", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rk
  FROM orders) WHERE rk = 1
""")
def q_dedupe_first(spark, sf_dir):
    """Each customer's first order (date, then key)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return J.dedupe_first(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("winner_loser", """
WITH v AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS R_name,
                  CAST(l_suppkey AS VARCHAR) AS B_name,
                  CASE l_returnflag WHEN 'R' THEN 'Red' WHEN 'A' THEN 'Blue' ELSE 'Draw' END AS Winner
           FROM lineitem)
SELECT l_orderkey, l_linenumber, Winner,
       CASE WHEN Winner = 'Red' THEN R_name WHEN Winner = 'Blue' THEN B_name END AS winner_name,
       CASE WHEN Winner = 'Blue' THEN R_name WHEN Winner = 'Red' THEN B_name END AS loser_name
FROM v
""")
def q_winner_loser(spark, sf_dir):
    """Winner / loser names from side + outcome."""
    from duelframe.plans.reshaping import two_sided_lineitem

    v = two_sided_lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.col("R_key").cast("string").alias("R_name"),
        F.col("B_key").cast("string").alias("B_name"), "Winner")
    return winner_loser(v).select("l_orderkey", "l_linenumber", "Winner", "winner_name",
                                  "loser_name")


_CB_NORM_R = S.normalize_name("R_name")
_CB_NORM_B = S.normalize_name("B_name")
_CB_NORM_W = S.normalize_name("winner")
_CB_NORM_L = S.normalize_name("loser")
_COMBINED_SQL = f"""
WITH cust AS (SELECT c_custkey, c_name, n_name, n_nationkey, concat_ws(', ', n_name, r_name) AS location
              FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT o_orderkey AS bout_id, CAST(o_orderdate AS DATE) AS date, c_name AS R_name, n_name AS B_name,
             CASE o_orderstatus WHEN 'F' THEN 'Red' WHEN 'O' THEN 'Blue' ELSE 'Draw' END AS Winner,
             location
      FROM orders JOIN cust ON o_custkey = c_custkey),
cards AS (SELECT l_orderkey * 100 + l_linenumber AS card_id, CAST(l_shipdate AS DATE) AS date,
                 c_name AS winner, n_name AS loser
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey),
bk AS (SELECT *, {S.pair_key(_CB_NORM_R, _CB_NORM_B)} AS k FROM b),
ck AS (SELECT card_id, date, {S.pair_key(_CB_NORM_W, _CB_NORM_L)} AS k FROM cards),
ex AS (SELECT k, date, min(card_id) AS card_id FROM ck GROUP BY k, date),
exact AS (SELECT bk.bout_id, ex.card_id, ex.date AS cdate FROM bk JOIN ex ON bk.k = ex.k AND bk.date = ex.date),
dates AS (SELECT DISTINCT date FROM cards),
todo AS (SELECT bout_id, date,
                CASE WHEN Winner = 'Red' THEN R_name WHEN Winner = 'Blue' THEN B_name END AS wn,
                CASE WHEN Winner = 'Blue' THEN R_name WHEN Winner = 'Red' THEN B_name END AS ln
         FROM b WHERE Winner <> 'Draw' AND bout_id NOT IN (SELECT bout_id FROM exact)),
blk AS (SELECT *, CASE WHEN date IN (SELECT date FROM dates) THEN date
                       WHEN date + 1 IN (SELECT date FROM dates) THEN date + 1 END AS md FROM todo),
cand AS (SELECT blk.bout_id, cards.card_id, cards.date AS cdate,
                row_number() OVER (PARTITION BY blk.bout_id
                                   ORDER BY (levenshtein(cards.winner, blk.wn) + levenshtein(cards.loser, blk.ln)) / 2.0,
                                            cards.card_id) AS rk
         FROM blk JOIN cards ON cards.date = blk.md),
fz AS (SELECT bout_id, card_id, cdate FROM cand WHERE rk = 1),
homes AS (SELECT {S.normalize_name("c_name")} AS hn, min(c_acctbal) AS he FROM customer GROUP BY hn)
SELECT b.bout_id, b.date, CAST(cust_n.n_nationkey AS DOUBLE) * 10.5 AS location_elevation,
       coalesce(exact.card_id, fz.card_id) AS sc_card_id, coalesce(exact.cdate, fz.cdate) AS sc_date,
       CASE WHEN exact.card_id IS NOT NULL THEN 'exact' WHEN fz.card_id IS NOT NULL THEN 'fuzzy' END AS sc_match,
       hr.he AS R_home_elevation, hb.he AS B_home_elevation
FROM b
LEFT JOIN (SELECT DISTINCT n_nationkey, location FROM cust) cust_n ON cust_n.location = b.location
LEFT JOIN exact ON exact.bout_id = b.bout_id
LEFT JOIN fz ON fz.bout_id = b.bout_id
LEFT JOIN homes hr ON hr.hn = {S.normalize_name("b.R_name")}
LEFT JOIN homes hb ON hb.hn = {S.normalize_name("b.B_name")}
"""


@register("combined_bouts", _COMBINED_SQL)
def q_combined_bouts(spark, sf_dir):
    """SURVEY 3.1 in one plan (combine_bouts): orders as bouts (customer vs its
    nation), shipments as independently dated scorecards, nation locations as
    venues, customer balances as home values.  Every step has its own oracle
    above (J1-J6, J8, J3, A11) and the whole flow has one too."""
    from duelframe.operators.bouts import combine_bouts

    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions
    nr = n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", F.concat_ws(", ", "n_name", "r_name").alias("location"),
        (F.col("n_nationkey") * 10.5).alias("location_elevation"))
    cust = c.join(broadcast_if_small(nr), c.c_nationkey == nr.n_nationkey).select(
        "c_custkey", "c_name", "n_name", "location")
    outcome = (F.when(F.col("o_orderstatus") == "F", "Red")
                .when(F.col("o_orderstatus") == "O", "Blue").otherwise("Draw"))
    bouts = o.join(cust, o.o_custkey == cust.c_custkey).select(
        F.col("o_orderkey").alias("bout_id"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("c_name").alias("R_name"), F.col("n_name").alias("B_name"),
        outcome.alias("Winner"), "location")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate",
                                                 "l_returnflag")
    cards = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
               .join(cust, F.col("o_custkey") == cust.c_custkey)
               .select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("card_id"),
                       F.col("l_shipdate").cast("date").alias("date"),
                       F.col("c_name").alias("winner"), F.col("n_name").alias("loser"),
                       F.col("l_returnflag").alias("method")))
    homes = c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("elevation"))
    out = combine_bouts(bouts, cards, nr.select("location", "location_elevation"), homes)
    return out.select("bout_id", "date", "location_elevation", "sc_card_id", "sc_date",
                      "sc_match", "R_home_elevation", "B_home_elevation")
