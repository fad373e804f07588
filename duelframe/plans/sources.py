"""Sources and sinks round trips.

Written tables go to a fresh folder under the session's shared checkpoint
directory (``spark.checkpoint.dir``), never to a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.sources import io
from duelframe.session import scratch_path
from duelframe.plans.registry import register, table

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


@register("csv_round_trip", "SELECT * FROM orders")
def q_csv_round_trip(spark, sf_dir):
    """S1 + S2: write headered CSV without index, read back with the schema."""
    path = scratch_path(spark, "orders-csv")
    io.write_table(table(spark, sf_dir, "orders"), path, "csv")
    return io.read_table(spark, path, ORDERS_SCHEMA)


@register("csv_with_row_id", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS row_id, o_orderkey, o_totalprice FROM orders
""")
def q_csv_row_id(spark, sf_dir):
    """S3: write with a row-id column, read back."""
    path = scratch_path(spark, "orders-rowid")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    io.write_table(o, path, "csv", with_row_id=True, order=["o_orderkey"])
    schema = T.StructType([T.StructField("row_id", T.LongType()),
                           T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    return io.read_table(spark, path, schema)


@register("text_lines_round_trip", "SELECT trim(p_name) AS value FROM part")
def q_lines(spark, sf_dir):
    """S4 + S5: one string column written as lines, read back stripped."""
    path = scratch_path(spark, "part-names")
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("n"))
    io.write_lines(p, "n", path)
    return io.read_lines(spark, path)


PAIR_SCHEMA = T.StructType([
    T.StructField("x", T.StringType(), False), T.StructField("y", T.StringType(), False),
    T.StructField("score", T.IntegerType(), False), T.StructField("ratio", T.DoubleType(), False),
])


@register("records_to_table", """
SELECT p_name AS x, p_brand AS y, CAST(p_size AS INTEGER) AS score, p_retailprice AS ratio FROM part
""")
def q_records(spark, sf_dir):
    """S6 (+ F24): rows turned into JSON records, then parsed back against the
    explicit, non-nullable pair schema (JVM-side, no Python per row)."""
    p = table(spark, sf_dir, "part")
    recs = p.select(F.to_json(F.struct(F.col("p_name").alias("x"), F.col("p_brand").alias("y"),
                                       F.col("p_size").alias("score"),
                                       F.col("p_retailprice").alias("ratio"))).alias("rec"))
    return io.records_from_json(recs, "rec", PAIR_SCHEMA)


# Priority text -> rank.
PRIORITY_RANK = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@register("literal_lookup", """
WITH lit(k, v) AS (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5))
SELECT o_orderkey, v AS priority_rank FROM orders LEFT JOIN lit ON o_orderpriority = k
""")
def q_literal_lookup(spark, sf_dir):
    """Literal lookup table, broadcast (five rows) into a join."""
    lit = io.literal_table(spark, PRIORITY_RANK, "k", "v", "k string, v int")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = o.join(F.broadcast(lit), o.o_orderpriority == lit.k, "left")   # five literal rows
    return j.select("o_orderkey", F.col("v").alias("priority_rank"))
