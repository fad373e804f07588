"""The grid of classes is whole and dealt over tasks, however many classes there are."""

from pyspark.sql import functions as F

from duelframe.operators.metrics import confusion_matrix


def test_many_classes_make_the_whole_grid_in_many_tasks(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("y"), (F.col("id") % 7).cast("string").alias("p"))
    out = confusion_matrix(df, "y", "p")
    assert "collect_set" not in out._jdf.queryExecution().toString()
    got = {(r.y, r.yhat): r.n for r in out.collect()}
    assert len(got) == 300 * 300 and sum(got.values()) == 300
    assert all(got[str(i), str(i % 7)] == 1 for i in range(300))
