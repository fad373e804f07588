"""Classification metrics A16-A19 as aggregates over (y, yhat)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: each side of the grid of classes is dealt over this many parts, and every part meets every other in a key of its own
GRID_PARTS = 16


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(y, yhat, n) for every pair of classes, missing cells as 0.

    Classes are the non-NULL values of either column, of any type; rows
    with a NULL on either side are in no cell.  Counts are one partial
    aggregate, laid on the grid of classes by a null-free join.  The grid is
    an equi-join of parts of the classes, so no task holds all of them.
    """
    cells = df.select(F.col(y).alias("y"), F.col(yhat).alias("yhat")).dropna()
    cells = cells.groupBy("y", "yhat").agg(F.count(F.lit(1)).alias("_n"))
    seen = df.select(F.col(y).alias("c")).union(df.select(F.col(yhat).alias("c"))).dropna().distinct()
    part = F.pmod(F.xxhash64("c"), F.lit(GRID_PARTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(GRID_PARTS - 1)))
    rows = seen.select(F.col("c").alias("y"), part.alias("_a"), every.alias("_b"))
    columns = seen.select(F.col("c").alias("yhat"), part.alias("_b"), every.alias("_a"))
    grid = rows.join(columns, ["_a", "_b"]).select("y", "yhat")
    return grid.join(cells, ["y", "yhat"], "left").select(
        "y", "yhat", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Share of rows with y == yhat."""
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def f1_per_class(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """F1 of each class (0 when undefined): 2·tp / (n_true + n_pred).

    One scan: every row is counted once for its true class and once for its
    predicted class (``inline`` of two structs), then one partial aggregate.
    """
    hit = (F.col(y) == F.col(yhat)).cast("int")
    both = F.array(F.struct(F.col(y).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                            hit.alias("tp")),
                   F.struct(F.col(yhat).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                            F.lit(0).alias("tp")))
    agg = (df.select(F.inline(both)).groupBy("cls")
             .agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum("tp").alias("tp")))
    return agg.select("cls", F.coalesce(F.try_divide(2.0 * F.col("tp"),
                                                     F.col("n_true") + F.col("n_pred")),
                                        F.lit(0.0)).alias("f1"))


def macro_f1(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Mean of the per-class F1."""
    return f1_per_class(df, y, yhat).agg(F.avg("f1").alias("f1_macro"))


def binary_metrics(df: DataFrame, y: str, yhat: str, positive=1) -> DataFrame:
    """Accuracy, precision, recall, F for the positive class (0 if undefined)."""
    yt, yp = F.col(y) == F.lit(positive), F.col(yhat) == F.lit(positive)
    c = df.agg(F.count_if(yt & yp).alias("tp"), F.count_if(~yt & yp).alias("fp"),
               F.count_if(yt & ~yp).alias("fn"), F.count_if(~yt & ~yp).alias("tn"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    acc = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return (c.withColumn("p", p).withColumn("r", r)
             .select("tp", "fp", "fn", "tn", acc.alias("accuracy"), F.col("p").alias("precision"),
                     F.col("r").alias("recall"), f.alias("f1")))
