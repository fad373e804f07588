"""Property checks against brute force on small generated inputs."""

import random

from pyspark.sql import functions as F

from duelframe.functions import keys as K
from duelframe.functions import text as T
from duelframe.operators.name_index import nearest_names
from duelframe.operators.names import threshold_pairs


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def _words(rng, n, alphabet="abc d", lo=0, hi=12):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(lo, hi)))
                   for _ in range(n)})


def test_threshold_pairs_exact(spark):
    rng = random.Random(7)
    xs, ys = _words(rng, 40), _words(rng, 60)
    left = spark.createDataFrame([(x,) for x in xs], "x string")
    right = spark.createDataFrame([(y,) for y in ys], "y string")
    for t in (0, 1, 2, 3, 5):
        got = {(r.x, r.y, r.score) for r in threshold_pairs(left, right, t).collect()}
        want = {(x, y, lev(x, y)) for x in xs for y in ys if lev(x, y) <= t}
        assert got == want, t


def test_nearest_names_equals_brute_force(spark):
    rng = random.Random(11)
    xs, ys = _words(rng, 30, lo=1), _words(rng, 45, lo=1)
    left = spark.createDataFrame([(x,) for x in xs], "x string")
    right = spark.createDataFrame([(y,) for y in ys], "y string")
    got = {(r.x, r.y, r.score, r.rank) for r in nearest_names(left, right, k=4).collect()}
    want = set()
    for x in xs:
        ranked = sorted(ys, key=lambda y: (lev(x, y), y))[:4]
        want |= {(x, y, lev(x, y), i + 1) for i, y in enumerate(ranked)}
    assert got == want


def test_ratio_and_keys_properties(spark):
    rng = random.Random(3)
    pairs = [(a, b) for a, b in zip(_words(rng, 30, "ab"), _words(rng, 30, "ab"))]
    pairs += [(a, a) for a, _ in pairs[:5]] + [("", ""), ("a", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", T.indel_ratio("a", "b").alias("r"),
                     T.indel_ratio("b", "a").alias("r2"), T.lcs_length("a", "b").alias("l"),
                     K.pair_key("a", "b").alias("k1"), K.pair_key("b", "a").alias("k2"),
                     K.normalize_name("a").alias("n1"),
                     K.normalize_name(K.normalize_name("a")).alias("n2")).collect()
    for r in rows:
        assert 0.0 <= r.r <= 1.0 and r.r == r.r2
        assert (r.r == 1.0) == (r.a == r.b)
        assert r.l == lcs(r.a, r.b)
        assert r.k1 == r.k2 and r.n1 == r.n2


def test_arrow_lcs_matches_expression(spark):
    from duelframe.functions.bits import long_lcs

    assert long_lcs("kitten", "sitting") == 4
    rng = random.Random(5)
    pairs = [(a, b) for a, b in zip(_words(rng, 25, "abcd", 0, 90), _words(rng, 25, "abcd", 0, 90))]
    pairs += [("", "x"), ("kitten", "sitting")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", T.indel_ratio("a", "b").alias("e"),
                     T.indel_ratio("a", "b", method="arrow").alias("u")).collect()
    for r in rows:
        assert abs(r.e - r.u) < 1e-12 and long_lcs(r.a, r.b) == lcs(r.a, r.b)


def test_lcs_forms_agree_on_long_and_short(spark):
    from duelframe.functions.text import _lcs_bitvector, _lcs_table

    rng = random.Random(9)
    pairs = [(a, b) for a, b in zip(_words(rng, 30, "abcde", 1, 80), _words(rng, 30, "abcde", 1, 62))]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", _lcs_bitvector(F.col("a"), F.col("b")).alias("v"),
                     _lcs_table(F.col("a"), F.col("b")).alias("t")).collect()
    for r in rows:
        assert r.v == r.t == lcs(r.a, r.b)


def test_segment_and_deletion_joins_agree(spark):
    import duelframe.operators.names as N

    rng = random.Random(21)
    xs, ys = _words(rng, 50, "abcde", 0, 9), _words(rng, 50, "abcde", 0, 9)
    left = spark.createDataFrame([(x,) for x in xs], "x string")
    right = spark.createDataFrame([(y,) for y in ys], "y string")
    want = {t: {(x, y, lev(x, y)) for x in xs for y in ys if lev(x, y) <= t} for t in range(5)}
    for t in range(5):
        got = {(r.x, r.y, r.score) for r in N.deletion_pairs(left, right, t).collect()}
        assert got == want[t], t
    old = N.DELETION_MAX_T
    try:
        N.DELETION_MAX_T = -1   # force the segment/band join for small t too
        for t in range(5):
            got = {(r.x, r.y, r.score) for r in N.threshold_pairs(left, right, t).collect()}
            assert got == want[t], t
    finally:
        N.DELETION_MAX_T = old
