"""The closest profile of a large block equals brute force, for any size of strips and units."""

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest

from duelframe.operators import profiles as P
from duelframe.operators.joins import best_match_join
from test_whole_names import edits


def names(rng, n, shared):
    pool = ["".join(rng.choice("abAé1") for _ in range(rng.randint(0, 7))) for _ in range(shared)] + ["x" * 70]
    return [rng.choice(pool) for _ in range(n)]


@pytest.mark.parametrize("strip, unit", [(512, 1024), (3, 8), (7, 16)])
@pytest.mark.parametrize("shared", [3, 60])
def test_closest_equals_brute_force(monkeypatch, strip, unit, shared):
    monkeypatch.setattr(P, "STRIP", strip)
    monkeypatch.setattr(P, "CELLS", strip)
    monkeypatch.setattr(P, "UNIT", unit)
    rng = random.Random(strip + shared)
    lw, ll, rw, rl = names(rng, 40, 50), names(rng, 40, shared), names(rng, 60, 50), names(rng, 60, shared)
    order = list(range(60))
    rng.shuffle(order)
    cost, row = P.closest(*(pa.chunked_array([x], pa.string()) for x in (lw, ll, rw, rl)), np.array(order))
    for i in range(40):
        want = min((edits(lw[i], rw[j]) + edits(ll[i], rl[j]), order[j], j) for j in range(60))
        assert (cost[i], row[i]) == (want[0], want[2])


def test_best_match_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "SLOT", 5)
    monkeypatch.setattr(P, "PART", 4)
    day = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 3, 1)]
    rng = random.Random(4)
    left = spark.createDataFrame([(i, day[i % 3], a, b) for i, (a, b) in enumerate(zip(names(rng, 30, 9), names(rng, 30, 4)))]
                                 + [(90, day[0], None, "a"), (91, day[1], "a", None)], "lid int, d date, w string, l string")
    right = spark.createDataFrame([(i, day[1] if i % 4 else day[0], a, b) for i, (a, b) in enumerate(zip(names(rng, 40, 9), names(rng, 40, 4)))]
                                  + [(99, day[0], "a", None)], "rid int, d date, w string, l string")

    def rows(how, most):
        return sorted(map(repr, best_match_join(left, right, "lid", "rid", "d", "d", ("w", "l"), ("w", "l"), strategy=how,
                                                max_block_pairs=10, max_cost=most).collect()))

    for most in (None, 1.5):
        assert rows("bounds", most) == rows("profiles", most) == rows("auto", most)


def test_large_blocks_make_no_threshold_rounds(spark, monkeypatch):
    from duelframe.operators import joins as J

    monkeypatch.setattr(J, "threshold_pairs", None)
    df = spark.createDataFrame([(i, dt.date(2020, 1, 1), f"name {i:04d}", "x") for i in range(60)], "i int, d date, w string, l string")
    out = J.best_match_join(df, df.toDF("j", "e", "v", "m"), "i", "j", "d", "e", ("w", "l"), ("v", "m"), max_block_pairs=100)
    assert all(r.match_j == r.i and r.match_cost == 0 for r in out.collect())


def test_many_small_blocks_are_not_compared_pair_by_pair(spark, monkeypatch):
    from duelframe.operators import joins as J

    bounded, seen = J.closest_profiles, []
    monkeypatch.setattr(J, "closest_profiles", lambda *a: seen.append(a) or bounded(*a))
    first = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(i, first + dt.timedelta(2 * (i % 30)), f"name {i:04d}", "x") for i in range(90)],
                               "i int, d date, w string, l string")

    def match(**limits):
        return J.best_match_join(df, df.toDF("j", "e", "v", "m"), "i", "j", "d", "e", ("w", "l"), ("v", "m"), **limits).collect()

    assert all(r.match_j == r.i for r in match(max_pairs=270)) and not seen      # 30 blocks of 9 pairs
    assert all(r.match_j == r.i for r in match(max_pairs=269)) and seen
