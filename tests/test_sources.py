"""Sources and sinks on literal inputs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.session import scratch_path
from duelframe.sources import io
from duelframe.sources import pages as H

HTML = ('<html><head><title>T</title></head><body><h1>Main <b>title</b></h1><ul>'
        '<li><a href="/a">Alpha</a></li><li>Plain Beta</li><li><a href="/c">Gamma the third</a></li>'
        '</ul><p><a href="http://x/y">ext</a></p></body></html>')


def _pages(spark):
    return spark.createDataFrame([(1, "u1", HTML), (2, "u2", "<html>none</html>")],
                                 "page_id long, url string, html string")


def test_page_items_links_field_label(spark):
    p = _pages(spark)
    items = [(r.page_id, r.pos, r.item) for r in H.page_items(p).orderBy("page_id", "pos").collect()]
    assert items == [(1, 0, "Alpha"), (1, 1, "Plain Beta"), (1, 2, "Gamma the third")]
    links = [(r.pos, r.text, r.href) for r in H.page_links(p).orderBy("pos").collect()]
    assert links == [(0, "Alpha", "/a"), (1, "Gamma the third", "/c"), (2, "ext", "http://x/y")]
    field = {r.page_id: r.field for r in H.page_field(p, "THE").collect()}
    assert field == {1: "Gamma the third", 2: None}
    lab = {r.page_id: r.value for r in H.page_labelled(
        p, ["h2", "h1", "title"]).collect()}
    assert lab == {1: "Main title", 2: None}


def test_csv_and_lines_round_trip(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()),
                           T.StructField("s", T.StringType())])
    df = spark.createDataFrame([(1, 0.5, "a,b"), (2, None, "")], schema)
    path = scratch_path(spark, "t")
    io.write_table(df, path)
    back = io.read_table(spark, path, schema)
    assert sorted(back.collect(), key=lambda r: r.k)[0] == (1, 0.5, "a,b")
    path2 = scratch_path(spark, "ids")
    io.write_table(df.select("k", "v"), path2, with_row_id=True, order=["k"])
    ids = io.read_table(spark, path2).orderBy("row_id").collect()
    assert [(r.row_id, r.k) for r in ids] == [(1, 1), (2, 2)]
    path3 = scratch_path(spark, "lines")
    io.write_lines(spark.createDataFrame([("  x ",), ("y",)], "n string"), "n", path3)
    assert sorted(r.value for r in io.read_lines(spark, path3).collect()) == ["x", "y"]


def test_records_from_json(spark):
    schema = T.StructType([T.StructField("x", T.StringType(), False),
                           T.StructField("n", T.IntegerType(), False)])
    df = spark.createDataFrame([('{"x": "a", "n": 3}',)], "rec string")
    assert io.records_from_json(df, "rec", schema).collect()[0] == ("a", 3)
    bad = spark.createDataFrame([('{"x": "a"}',)], "rec string")
    try:
        io.records_from_json(bad, "rec", schema).collect()
        raise AssertionError("missing required field accepted")
    except Exception as exc:  # noqa: BLE001
        assert "AssertionError" not in type(exc).__name__


def test_api_exports_every_group():
    import duelframe.api as api

    for name in ("read_table", "page_links", "strip_prefix", "pair_join", "best_match_join",
                 "nearest_names", "group_count", "confusion_matrix", "career_windows",
                 "top_k", "split_sides", "normalize_name", "indel_ratio", "safe_ratio",
                 "label_encode", "compare_models", "knn_classify"):
        assert callable(getattr(api, name))
