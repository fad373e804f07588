"""A pass that the quota covers takes every block, also blocks without a token."""

from pyspark.sql import functions as F

from duelframe.llm import mixing


def test_documents_without_a_token_stay_in_a_whole_pass(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"),
                                   F.when(F.col("id") % 4 == 0, "").when(F.col("id") % 4 == 2, None).otherwise("a b").alias("text"))
    for seed in range(1, 4):
        got = [r.doc_id for r in mixing.mix(docs, repeats=2.0, seed=seed).filter("dfx_pass = 1").collect()]
        assert sorted(got) == list(range(100))
