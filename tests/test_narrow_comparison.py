"""The model comparison carries only the columns its models read."""

from pyspark.sql import functions as F

from duelframe.operators import models as ML


def test_comparison_carries_only_its_columns(spark, monkeypatch):
    seen = []
    size = ML.right_size
    monkeypatch.setattr(ML, "right_size", lambda df: seen.append(set(df.columns)) or size(df))
    df = ML.as_features(spark.range(60).select("id", (F.col("id") % 2).cast("double").alias("label"),
                                               F.array((F.col("id") % 2).cast("double"), F.lit(1.0)).alias("v"), F.lit("x" * 100).alias("wide")), "v")
    _, med = ML.compare_models(df, {"m": lambda n: ML.logreg(1.0, n)}, k=2, inputs=("features",))
    assert {r.metric: r["median"] for r in med.collect()}["accuracy"] == 1.0
    assert "features" in seen[0] and not seen[0] & {"wide", "v"}


def test_rows_are_made_once_for_the_folds(spark, monkeypatch):
    from duelframe.operators import ordering

    monkeypatch.setattr(ordering, "TARGET_PARTITION_BYTES", 1)          # several range partitions, whose bounds are sampled
    made = spark.sparkContext.accumulator(0)

    def one(x):
        made.add(1)
        return float(x % 2)

    rows = spark.range(0, 300, 1, 3).select("id", F.udf(one, "double")("id").alias("label"))
    df = ML.as_features(rows.withColumn("v", F.array("label", F.lit(1.0))), "v")
    _, med = ML.compare_models(df, {"m": lambda n: ML.logreg(1.0, n)}, k=2, inputs=("features",))
    assert {r.metric: r["median"] for r in med.collect()}["accuracy"] == 1.0
    assert made.value == 300
