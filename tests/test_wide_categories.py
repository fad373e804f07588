"""Sparse one-hot of many values, tails of any order, and the chosen features as rows."""

from pyspark.sql import functions as F

from duelframe.operators import prep as M
from duelframe.operators.ordering import preview


def entries(df, vector="one_hot"):
    return {(r.id, r.place, r.value) for r in M.sparse_entries(df, "id", vector).collect()}


def test_sparse_vector_equals_codes(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, None, "y"), (3, "a", None), (4, "b", "x"), (5, "é", "")], "id int, c string, d string")
    out = M.one_hot_vector(df, ["c", "d"])
    assert out.columns == ["id", "one_hot"] and {r.one_hot.size for r in out.collect()} == {6}
    assert entries(out) == {(1, 1, 1.0), (1, 4, 1.0), (2, 5, 1.0), (3, 0, 1.0), (4, 1, 1.0), (4, 4, 1.0), (5, 2, 1.0), (5, 3, 1.0)}
    named = M.one_hot_vector(df, ["c"], "category")
    assert entries(named) == {(1, 2, 1.0), (2, 0, 1.0), (3, 1, 1.0), (4, 2, 1.0), (5, 3, 1.0)}
    assert [tuple(r) for r in M.category_codes(df, "c").orderBy("code").collect()] == [("a", 0, 1), ("b", 1, 2), ("é", 2, 1)]


def test_columns_of_one_value_of_none_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, None, "k")], "id int, c string, d string")
    out = M.one_hot_vector(df, ["c", "d"])
    assert entries(out) == {(1, 0, 1.0), (2, 0, 1.0)}
    assert M.one_hot_vector(df.limit(0), ["c", "d"]).count() == 0


def test_many_values_need_no_list_on_the_driver(spark):
    n = 200_000
    df = spark.range(n).select("id", F.concat(F.lit("v"), F.format_string("%07d", "id")).alias("c"))
    out = M.one_hot_vector(df, ["c"])
    got = M.sparse_entries(out, "id", "one_hot")
    assert got.filter("place = id and value = 1").count() == n == got.count()
    wide = M.prepare_careers(df.withColumn("c", F.when(F.col("id") > 0, F.col("c"))), drop=[], skip=[], vector="hot")
    assert wide.columns == ["id", "hot"] and wide.first().hot.size == n - 1


def test_tail_by_expressions(spark):
    v = spark.createDataFrame([(-5,), (1,), (3,), (None,), (-2,)], "v int")
    assert [r.v for r in preview(v, [F.abs("v").asc()], 2, tail=True).collect()] == [3, -5]
    assert [r.v for r in preview(v, [F.col("v").desc()], 2, tail=True).collect()] == [-5, None]
    assert [r.v for r in preview(v, F.abs("v"), 2, tail=True).collect()] == [3, -5]
    assert [r.v for r in preview(v, "v", 2, tail=True).collect()] == [1, 3]
