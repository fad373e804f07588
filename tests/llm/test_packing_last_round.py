"""What is left open in different partitions meets in the end."""

import pytest
from pyspark.sql import functions as F

from duelframe.llm import packing
from duelframe.llm.queries import tokenizer_path


def test_few_short_documents_in_ten_partitions_are_one_sequence(spark):
    docs = spark.range(10, numPartitions=10).select(F.col("id").alias("doc_id"), F.lit("a short text").alias("text"))
    out = packing.pack(docs, tokenizer_path(), 1, 2048).collect()
    assert len(out) == 10 and len({r.sequence_id for r in out}) == 1
    at = 0
    for offset, n in sorted((r.offset, r.length) for r in out):
        assert offset == at
        at += n


@pytest.mark.parametrize("parts", [2, 3, 4, 9, 10])
def test_rounds_end_with_one_group(spark, monkeypatch, parts):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    left = spark.range(parts).select(F.col("id").alias("dfx_seq"), F.lit(5).cast("long").alias("used"), F.col("id").alias("part"))
    got = packing.merge_open(left, 64, 4).collect()
    assert len(got) == parts and len({r.to_seq for r in got}) == 1 and sorted(r["shift"] for r in got) == [5 * k for k in range(parts)]
