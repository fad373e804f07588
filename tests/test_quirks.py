"""Hand-computed cases for the behaviours listed in SURVEY 1.1 and FIXTURES."""

import datetime as dt
import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from duelframe.functions import keys as K
from duelframe.functions import numeric as N
from duelframe.functions import text as T
from duelframe.operators import joins as J
from duelframe.operators import prep as M
from duelframe.operators import project as P
from duelframe.operators.windows import career_windows, kfold


def _careers(spark, sizes):
    rows = []
    for cid, n in enumerate(sizes):
        for i in range(n):
            rows.append((cid, dt.date(2020, 1, 1) + dt.timedelta(days=i), i, i % 2 == 0))
    return spark.createDataFrame(rows, "cid int, d date, v int, won boolean")


def test_q1_window_count_rule(spark):
    df = _careers(spark, [5, 6, 7])
    for drop_last, expect in ((True, {2: 1}), (False, {1: 1, 2: 2})):
        for split in (True, False):
            w = career_windows(df, "cid", ["d"], ["v"], n=5, f=1, label="won",
                               drop_last=drop_last, split_hot_keys=split, block_rows=8)
            got = {r["cid"]: r["count"] for r in w.groupBy("cid").count().collect()}
            assert got == expect


def test_windows_cross_block_boundaries(spark):
    df = _careers(spark, [40])
    w = career_windows(df, "cid", ["d"], ["v"], n=5, f=2, label="won", block_rows=7)
    rows = sorted(w.collect(), key=lambda r: r["win_start"])
    assert len(rows) == 40 - 5 - 2
    for r in rows:
        s = r["win_start"] - 1
        assert [x["v"] for x in r["features"]] == list(range(s, s + 5))
        assert r["labels"] == [(s + 5) % 2 == 0, (s + 6) % 2 == 0]


def test_q2_anchored_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "R_avg_SIG_STR_att int, B_avg_SUB_ATT int")
    assert P.strip_prefix(df, "R_").columns == ["avg_SIG_STR_att", "B_avg_SUB_ATT"]
    assert P.strip_prefix(P.strip_prefix(df, "R_"), "B_").columns == ["avg_SIG_STR_att",
                                                                     "avg_SUB_ATT"]
    assert P.strip_prefix(df, "R_", anchored=False).columns[0] == "avg_SIG_STatt"


def test_q3_elevation_keeps_dot(spark):
    df = spark.createDataFrame([("Elevation 175.9 m",), ("1,234 m high",), ("none",),
                                ("43.0",)], "t string")
    got = [r[0] for r in df.select(K.elevation_m("t")).collect()]
    assert got == [175.9, 1234.0, None, None]
    got = [r[0] for r in df.select(K.digits_and_dot("t")).collect()]
    assert got[0] == "175.9" and got[3] == "43.0"


def test_q4_safe_ratio(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0), (None, 2.0), (1.0, 4.0)], "a double, b double")
    z = [r[0] for r in df.select(N.safe_ratio("a", "b")).collect()]
    i = [r[0] for r in df.select(N.safe_ratio("a", "b", "inf")).collect()]
    assert z == [0.0, 0.0, 0.0, 0.25]
    assert i[0] == 0.0 and math.isinf(i[1]) and i[2] == 0.0 and i[3] == 0.25


def test_q8_top7_ties_by_name(spark):
    from duelframe.operators.name_index import nearest_names

    left = spark.createDataFrame([("aaa",)], "x string")
    right = spark.createDataFrame([(n,) for n in ["aab", "aac", "aad", "abb", "zzz"]], "y string")
    got = nearest_names(left, right, k=3).orderBy("rank").collect()
    assert [r["y"] for r in got] == ["aab", "aac", "aad"]
    assert [r["score"] for r in got] == [1, 1, 1]


def test_q9_location_fanout(spark):
    df = spark.createDataFrame([(1, "Las Vegas, Nevada, U.S")], "id int, loc string")
    dim = spark.createDataFrame([("Las Vegas, Nevada, U.S", 610.0, 1), ("Las Vegas, U.S", 611.0, 2)],
                                "location string, elev double, did int")
    assert J.location_join(df, dim, "loc", "location").count() == 2
    one = J.location_join(df, dim, "loc", "location", "first", ["did"]).collect()
    assert len(one) == 1 and one[0]["elev"] == 610.0


def test_q10_one_hot_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, c string")
    z = {r["id"]: (r["c_a"], r["c_b"]) for r in M.one_hot(df, ["c"]).collect()}
    assert z == {1: (1, 0), 2: (0, 0), 3: (0, 1)}
    c = M.one_hot(df, ["c"], nulls="category")
    assert sorted(c.columns) == ["c_0", "c_a", "c_b", "id"]


def test_q15_empty_strings_and_kitten(spark):
    df = spark.createDataFrame([("", ""), ("a", ""), ("", "abc"), ("kitten", "sitting")],
                               "a string, b string")
    got = df.select(T.indel_ratio("a", "b").alias("r"), T.edit_distance("a", "b").alias("d"),
                    T.lcs_length("a", "b").alias("l")).collect()
    assert got[0]["r"] == 1.0 and got[1]["r"] == 0.0 and got[2]["d"] == 3
    assert got[3]["d"] == 3 and got[3]["l"] == 4 and abs(got[3]["r"] - 8 / 13) < 1e-12


def test_folds_sizes(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    sizes = sorted((r["fold"], r["count"]) for r in kfold(df, 3, ["k"]).groupBy("fold").count().collect())
    assert sizes == [(0, 4), (1, 3), (2, 3)]


OUTCOMES = [
    ("decision", "decision", ""),
    ("decision (unanimous)", "decision", "unanimous"),
    ("decision (unanimous) (29-28, 30-27)", "decision", "29-28, 30-27"),
    ("tko (punches)", "tko", "punches"),
    ("dq (illegal knee)", "disqualification", "illegal knee"),
    ("technical submission (choke)", "submission", "choke"),
    ("submission (rear-naked choke)", "submission", "rearnaked choke"),
    ("referee stoppage", "tko", "stoppage"),
    ("no contest (overturned)", "no contest", "contest overturned"),
]


def test_outcome_text(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in OUTCOMES], "t string")
    got = df.select(T.outcome_method("t"), T.outcome_detail("t")).collect()
    assert [tuple(r) for r in got] == [(m, d) for _, m, d in OUTCOMES]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("José  Aldo!", "Conor McGregor"), ("McGregor, Conor", "Aldo José")],
                               "a string, b string")
    n = df.select(K.normalize_name("a").alias("a"), K.normalize_name("b").alias("b"))
    keys = [r[0] for r in n.select(K.pair_key("a", "b")).collect()]
    assert keys[0] == keys[1] == "aldo jose conor mcgregor"
    assert n.first()["a"] == "jose  aldo"   # inner double space stays


def test_place_key(spark):
    df = spark.createDataFrame([("Las Vegas, Nevada, U.S",), ("Singapore, Singapore",),
                                ("São Paulo",)], "l string")
    got = [r[0] for r in df.select(K.place_key("l")).collect()]
    assert got == ["Las Vegas, U.S", "Marina Bay, Singapore", "Sao Paulo, Sao Paulo"]


def test_parse_dates(spark):
    df = spark.createDataFrame([(" 2019-03-02 ", "Mar 2, 2019"), ("bad", "bad")], "a string, b string")
    got = df.select(K.parse_ymd("a"), K.parse_mdy("b")).collect()
    assert tuple(got[0]) == (dt.date(2019, 3, 2), dt.date(2019, 3, 2))
    assert tuple(got[1]) == (None, None)


def test_best_match_ties_and_fallback(spark):
    left = spark.createDataFrame([(1, dt.date(2020, 1, 1), "ann", "bob"),
                                  (2, dt.date(2020, 1, 5), "cat", "dog"),
                                  (3, dt.date(2020, 1, 9), "x", "y")],
                                 "lid int, d date, w string, l string")
    right = spark.createDataFrame([(10, dt.date(2020, 1, 1), "anne", "bob"),
                                   (11, dt.date(2020, 1, 1), "ann", "bobb"),
                                   (12, dt.date(2020, 1, 6), "cat", "dog")],
                                  "rid int, d date, w string, l string")
    for strategy in ("rounds", "profiles", "auto"):
        out = {r["lid"]: r for r in J.best_match_join(left, right, "lid", "rid", "d", "d",
                                                       ("w", "l"), ("w", "l"),
                                                       strategy=strategy).collect()}
        assert out[1]["match_rid"] == 10 and out[1]["match_cost"] == 0.5   # tie -> smallest id
        assert out[2]["match_rid"] == 12 and out[2]["match_date"] == dt.date(2020, 1, 6)
        assert out[3]["match_rid"] is None


def test_scalers_exact(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, True), (2, 3.0, 5.0, True), (3, 5.0, 5.0, False)],
                               "id int, a double, c double, tr boolean")
    z = M.standardize(df, ["a", "c"], F.col("tr"))
    got = {r["id"]: (r["a"], r["c"]) for r in z.collect()}
    assert got[1] == (-1.0, 0.0) and got[3] == (3.0, 0.0)      # population std, constant -> /1
    mm = {r["id"]: (r["a"], r["c"]) for r in M.minmax(df, ["a", "c"], F.col("tr")).collect()}
    assert mm[2] == (1.0, 0.0) and mm[3] == (2.0, 0.0)


def test_drop_value_keeps_nulls(spark):
    df = spark.createDataFrame([("Draw",), (None,), ("Red",)], "w string")
    assert P.drop_value(df, "w", "Draw").count() == 2


def test_upsert_and_update(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    patch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in J.upsert(base, patch, "k").collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(tuple(r) for r in J.update_from(base, patch, "k", ["v"]).collect()) == [(1, "a"), (2, "B")]


def test_records_and_literals(spark):
    from duelframe.sources import io

    from duelframe.plans.sources import PAIR_SCHEMA
    df = io.from_records(spark, [{"x": "a", "y": "b", "score": 1, "ratio": 0.5}], PAIR_SCHEMA)
    assert df.first() == Row(x="a", y="b", score=1, ratio=0.5)
    lit = io.literal_table(spark, {"a": 1}, "k", "v")
    assert lit.collect()[0]["v"] == 1


def test_hot_key_detection_and_equal_results(spark):
    from duelframe.operators.windows import has_hot_key

    df = _careers(spark, [60, 5, 7, 9])
    assert has_hot_key(df, "cid", 8, partitions=4)
    assert not has_hot_key(df, "cid", 100, partitions=4)
    a = career_windows(df, "cid", ["d"], ["v"], n=3, f=2, label="won", split_hot_keys=True,
                       block_rows=8, partitions=5)
    b = career_windows(df, "cid", ["d"], ["v"], n=3, f=2, label="won", split_hot_keys=False)
    assert a.count() == b.count() == sum(max(0, s - 5) for s in [60, 5, 7, 9])
    assert a.exceptAll(b).count() == 0


def test_best_match_strategies_agree(spark):
    from conftest import SF_SMALL
    from duelframe.plans.joins import q_best_match_join
    import duelframe.operators.joins as JJ

    a = q_best_match_join(spark, SF_SMALL)
    orig = JJ.best_match_join
    try:
        JJ.best_match_join = lambda *x, **k: orig(*x, **{**k, "strategy": "rounds"})
        b = q_best_match_join(spark, SF_SMALL)
    finally:
        JJ.best_match_join = orig
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_sort_quantiles_equal_percentile(spark):
    from duelframe.operators import aggs as A

    df = spark.createDataFrame([(g, float(v)) for g in range(3) for v in range(g * 7 + 2)] +
                               [(0, None)], "g int, v double")
    r = lambda d: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row)
                         for row in d.collect())
    assert r(A.five_number(df, ["v"], "g", method="sort")) == \
        r(A.five_number(df, ["v"], "g", method="aggregate"))
    m = A.median_over_folds(df, "g", ["v"], method="sort")
    assert r(m) == r(A.median_over_folds(df, "g", ["v"], method="aggregate"))


def test_confusion_matrix_all_cells(spark):
    from duelframe.operators.metrics import confusion_matrix

    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 0)], "y int, yhat int")
    got = {(r.y, r.yhat): r.n for r in confusion_matrix(df, "y", "yhat").collect()}
    assert len(got) == 9 and got[(2, 2)] == 0 and got[(0, 2)] == 1 and sum(got.values()) == 4
