"""Cases a reviewer probed: NULL keys and labels, draws, real predictions, ordinary HTML."""

from pyspark.sql import functions as F

from duelframe.operators.joins import update_from
from duelframe.operators.metrics import confusion_matrix
from duelframe.operators.ordering import key_row_number, preview
from duelframe.operators.project import winner_loser
from duelframe.operators.windows import career_windows
from duelframe.sources.pages import page_items, page_links


def test_null_keys_keep_their_row_numbers(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else "ab"[i % 2], i) for i in range(30)], "k string, o long")
    got = key_row_number(df, "k", "o").collect()
    assert len(got) == 30 and sorted(r._rn for r in got if r.k is None) == list(range(1, 11))


def test_career_windows_agree_on_null_competitors_and_labels(spark):
    rows = [(k, i, float(i), None if i == 8 else i % 2) for k in ("a", "b") for i in range(1, 13)]
    rows += [(None, i, 0.0, 1) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "k string, o long, x double, y long")
    out = [sorted(map(str, career_windows(df, "k", "o", ["x"], 3, 2, "y", split_hot_keys=s, block_rows=5).collect())) for s in (False, True)]
    assert out[0] == out[1] and not any("k=None" in r for r in out[0])
    labels = {r.win_start: r.labels for r in career_windows(df.filter("k = 'a'"), "k", "o", ["x"], 3, 2, "y").collect()}
    assert labels[4] == [1, None] and labels[5] == [None, 1]


def test_a_draw_has_no_winner(spark):
    df = spark.createDataFrame([("r", "b", w) for w in ("Red", "Blue", "Draw", None)], "R_name string, B_name string, Winner string")
    assert [(r.winner_name, r.loser_name) for r in winner_loser(df).collect()] == [("r", "b"), ("b", "r"), (None, None), (None, None)]


def test_confusion_matrix_of_doubles_dots_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (2.0, 0.0), (None, 1.0)], "y double, p double")
    got = {(r.y, r.yhat): r.n for r in confusion_matrix(df, "y", "p").collect()}
    assert len(got) == 9 and got[0.0, 1.0] == got[0.0, 0.0] == got[2.0, 0.0] == 1 and sum(got.values()) == 3
    dotted = spark.createDataFrame([("Dr. A", "Dr. A"), ("B", "Dr. A")], "y string, p string")
    assert {(r.y, r.yhat): r.n for r in confusion_matrix(dotted, "y", "p").collect()}["B", "Dr. A"] == 1


def test_items_and_links_of_ordinary_html(spark):
    html = ('<link rel="x"><li class="x">A</li><li>B\nC</li><LI>D</LI><a class=k href="/1">one</a><a name="n">no</a>'
            '<a href=/2 id=i>two\n<b>x</b></a><a href=\'/3\'>three</a>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.item for r in page_items(df).orderBy("pos").collect()] == ["A", "B\nC", "D"]
    assert [(r.text, r.href) for r in page_links(df).orderBy("pos").collect()] == [("one", "/1"), ("two\nx", "/2"), ("three", "/3")]


def test_update_does_not_fan_out_and_tail_is_in_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    patch = spark.createDataFrame([(1, "y"), (1, "x")], "k long, v string")
    assert sorted(map(tuple, update_from(df, patch, "k", ["v"]).collect())) == [(1, "x"), (2, "b")]
    assert [r.id for r in preview(spark.range(9), "id", 3, tail=True).collect()] == [6, 7, 8]


def test_word_pairs_cover_whole_texts(spark):
    from duelframe.functions.keys import word_pairs

    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,), ("a  b",)], "t string")
    got = [None if r[0] is None else [tuple(p) for p in r[0]] for r in df.select(word_pairs("t")).collect()]
    assert got == [[("a", "b"), ("b", "c")], [], [], None, [("a", ""), ("", "b")]]


def test_letters_of_other_scripts(spark):
    from duelframe.functions.keys import normalize_name

    df = spark.createDataFrame([("Ștefan",), ("Nguyễn",), ("Иван Щукин",), ("émile",), ("Øyvind",), (None,)], "n string")
    got = [r[0] for r in df.select(normalize_name("n")).collect()]
    assert got == ["stefan", "nguyen", "ivan shchukin", "emile", "oyvind", None]


def test_nearest_names_equal_brute_force_in_blocks_of_any_size(spark, monkeypatch):
    import random

    from duelframe.operators import name_index as N

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.choice([0, 1, 3, 6, 11, 20])))
    xs, ys = sorted({word() for _ in range(25)}), sorted({word() for _ in range(60)})
    want = {(x, y, n + 1) for x in xs for n, (_, y) in enumerate(sorted((edits(x, y), y) for y in ys)[:4])}
    left = spark.createDataFrame([(x,) for x in xs + xs[:3]] + [(None,)], "x string")
    right = spark.createDataFrame([(y,) for y in ys] + [(None,)], "y string")
    for block, slot, strip in ((8192, 4096, 64), (7, 3, 2), (1, 1, 1)):
        monkeypatch.setattr(N, "BLOCK", block)
        monkeypatch.setattr(N, "SLOT", slot)
        monkeypatch.setattr(N, "STRIP", strip)
        got = {(r.x, r.y, r.rank) for r in N.nearest_names(left, right, k=4).collect()}
        assert got == want, block
    assert N.nearest_names(left, right.limit(0)).count() == 0 and N.nearest_names(left.limit(0), right).count() == 0


def test_best_match_treats_missing_names_alike(spark):
    import datetime as dt

    from duelframe.operators.joins import best_match_join

    day = dt.date(2020, 1, 1)
    left = spark.createDataFrame([(1, day, "abc", "x"), (2, day, None, "x")], "lid int, d date, w string, l string")
    right = spark.createDataFrame([(10, day, "abc", "x"), (11, day, None, "x"), (12, day, "abc", None)], "rid int, d date, w string, l string")
    for how in ("rounds", "profiles"):
        out = {r.lid: r.match_rid for r in best_match_join(left, right, "lid", "rid", "d", "d", ("w", "l"), ("w", "l"), strategy=how).collect()}
        assert out == {1: 10, 2: None}, how


def test_quantiles_keep_null_groups_on_both_plans(spark):
    from duelframe.operators.aggs import five_number, median_over_folds

    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), (None, 5.0, 2.0), ("b", None, 1.0)], "g string, v double, w double")
    both = [[sorted(map(str, f(m).collect())) for m in ("aggregate", "sort")] for f in (
        lambda m: five_number(df, ["v", "w"], "g", method=m), lambda m: median_over_folds(df, "g", ["v", "w"], method=m))]
    for a, b in both:
        assert a == b and any("g=None" in r for r in a) and any("g='b'" in r for r in a)


def test_knn_blocks_equal_brute_force(spark):
    from duelframe.operators.models import knn_classify

    rows = [(i, [float(i % 7), float(i % 3)], i % 2) for i in range(120)] + [(500, None, 1)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label long")
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    want = {}
    for i, v, _ in rows[:120]:
        if i % 4 == 0:
            near = sorted((((v[0] - u[0]) ** 2 + (v[1] - u[1]) ** 2) ** 0.5, j, y) for j, u, y in rows[:120] if j % 4)[:3]
            ones = sum(y for _, _, y in near)
            want[i] = 1 if ones >= 2 else 0
    for size in (4096, 7):
        got = {r.id: r.prediction for r in knn_classify(train, test, 3, query_block=size, train_block=size).collect()}
        assert got == want, size


def test_knn_stands_beside_other_models(spark):
    from duelframe.operators import models as ML

    df = spark.createDataFrame([(f"r{i}", [float(i), float(i % 3)], float(i > 30)) for i in range(60)], "id string, v array<double>, label double")
    long, _ = ML.compare_models(ML.as_features(df, "v"), {"knn": lambda n: ML.Knn(3)}, k=3)
    assert {r.fold for r in long.collect()} == {0, 1, 2}
    assert min(r.value for r in long.filter("metric = 'train_accuracy'").collect()) > 0.8
