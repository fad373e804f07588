"""The stages on awkward rows, empty tables, clashing names, and without labels to learn from."""

import pytest
from pyspark.sql import functions as F

from test_operators import AWKWARD, docs_of
from duelframe.llm import toxicity


@pytest.fixture
def labelled(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)
    return write


@pytest.mark.parametrize("rows", [[], [(i, 0, 1) for i in range(20)], [(i, 0, 0) for i in range(20)], [(i, 0, None) for i in range(20)]])
def test_without_labels_of_both_kinds_every_document_stays(spark, labelled, rows):
    import corpus_pipeline as P

    docs = docs_of(spark, [(i, f"some clean words number {i}", "a") for i in range(20)] + [(None, None, None)])
    folder = labelled(rows)
    assert P.drop_toxic(spark, docs, folder).count() == 21
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert scored.filter("dfx_score >= 0.5").count() == 0


def test_stages_on_awkward_rows(spark, labelled):
    import corpus_pipeline as P

    folder = labelled([(1, 1, 0), (3, 0, 0)])
    docs = docs_of(spark, AWKWARD)
    rows = sorted(map(str, docs.select("doc_id", "source").collect()))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        got = sorted(map(str, out.select("doc_id", "source").collect()))
        if name == "toxicity":
            assert got == rows
        elif name == "source_mixing":
            assert set(got) == set(rows) and len(got) >= len(rows)
        else:
            assert set(got) <= set(rows) and 0 < len(got) < len(rows), name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    packed = P.STAGES[-1][1](spark, docs, folder)
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("most"))
    assert {r.doc_id for r in whole.collect()} == {i for i, _, _ in AWKWARD}
    assert P.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
