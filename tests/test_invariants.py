"""Invariants over the driver tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from duelframe.operators.ordering import global_row_number, key_row_number
from duelframe.operators.reshape import split_sides
from duelframe.operators.prep import split
from duelframe.plans.careers import event_careers
from duelframe.plans.metrics import scored
from duelframe.plans.reshaping import two_sided_lineitem
from duelframe.operators.metrics import confusion_matrix
from duelframe.operators.windows import kfold


def test_split_sides_doubles_rows(spark):
    two = two_sided_lineitem(spark, SF_SMALL)
    assert split_sides(two, drop_draws=False).count() == 2 * two.count()
    non_draw = two.filter(F.col("Winner") != "Draw").count()
    assert split_sides(two).count() == 2 * non_draw


def test_window_rows_match_count_rule(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sizes = [r["count"] for r in ev.groupBy("user_id").count().collect()]
    expect = sum(max(0, s - 5 - 1) for s in sizes)
    assert event_careers(spark, SF_SMALL, 5, 1, True).count() == expect
    a = event_careers(spark, SF_SMALL, 5, 2, False, split_hot_keys=True)
    b = event_careers(spark, SF_SMALL, 5, 2, False, split_hot_keys=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_numbers_match_window(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    a = key_row_number(o, "o_custkey", ["o_orderdate", "o_orderkey"], "rn", None, partitions=5)
    b = o.withColumn("rn", F.row_number().over(
        Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    g = global_row_number(o, ["o_orderkey"], "gid", partitions=7)
    ids = sorted(r["gid"] for r in g.collect())
    assert ids == list(range(1, o.count() + 1))


def test_fold_sizes_differ_by_at_most_one(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    sizes = [r["count"] for r in kfold(o, 7, ["o_orderkey"]).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_split_partitions_rows(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    s = split(o, "o_orderkey", 0.8, 3)
    tr, te = s.filter("is_train").count(), s.filter("not is_train").count()
    assert tr + te == o.count() and 0.7 < tr / o.count() < 0.9


def test_confusion_cells_sum_to_n(spark):
    df = scored(spark, SF_SMALL)
    cm = confusion_matrix(df, "y", "yhat")
    assert cm.agg(F.sum("n")).first()[0] == df.count()
