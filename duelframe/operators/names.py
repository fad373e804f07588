"""All name pairs within an edit distance, without a cross product (F12, used by J5).

The pairs within edit distance ``t`` are found exactly with a segment join: an
indexed string of length L is cut into t+1 segments; if ed(x, y) <= t, one
segment of y occurs unchanged in x, shifted by at most (t ± Δ)/2 where
Δ = |x| - |y| (pigeonhole + position filter).  So x only needs to probe
keys (L, segment, substring) and the join is an equi-join — no all-pairs
step.  The k closest names (J7) are found by the index of ``name_index``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _segments(L, t: int):
    """Column expressions for (segment index, start, length) of t+1 segments."""
    q = F.floor(L / (t + 1)).cast("int")
    r = (L % (t + 1)).cast("int")
    short = (t + 1) - r

    def start(i):
        return i * q + F.greatest(i - short, F.lit(0))

    def length(i):
        return q + F.when(i >= short, 1).otherwise(0)

    return start, length


def _deletions(c, t: int):
    """All strings obtained from ``c`` by deleting at most ``t`` characters."""
    out = F.array(c)
    for _ in range(t):
        out = F.array_distinct(F.flatten(F.transform(out, lambda s: F.concat(
            F.array(s), F.transform(F.sequence(F.lit(1), F.length(s)),
                                    lambda i: F.concat(F.substr(s, F.lit(1), i - 1),
                                                       F.substr(s, i + 1, F.length(s))))))))
    return out


def deletion_pairs(left: DataFrame, right: DataFrame, t: int, x: str = "x", y: str = "y",
                   block: list[str] | tuple = ()) -> DataFrame:
    """All (x, y, score) with levenshtein(x, y) <= t via shared deletion variants.

    If ed(x, y) <= t, the characters an optimal alignment keeps form a common
    subsequence reachable from each side with at most t deletions, so the two
    deletion neighbourhoods intersect: an exact equi-join on the variant.  It
    is sharp for small t (few variants, long keys) where length segments are
    too short to filter.
    """
    blk = list(block)
    lv = left.select(F.col(x).alias("_x"), *blk).select(
        "_x", *blk, F.explode(_deletions(F.col("_x"), t)).alias("_v"))
    rv = right.select(F.col(y).alias("_y"), *blk).select(
        "_y", *blk, F.explode(_deletions(F.col("_y"), t)).alias("_v"))
    return _within(lv.join(rv, [*blk, "_v"]), t, x, y, blk)


def _within(cand: DataFrame, t: int, x: str, y: str, blk: list[str]) -> DataFrame:
    """Distinct pairs of at most ``t`` edits.  Scored where the join makes them,
    so that only pairs which qualify are shuffled to remove repeats."""
    scored = cand.select("_x", "_y", *blk, F.levenshtein("_x", "_y", t).alias("score"))
    return scored.filter(F.col("score") >= 0).select(
        F.col("_x").alias(x), F.col("_y").alias(y), *blk, "score").distinct()


# Deletion variants of short strings stay few and selective while t is small;
# measured on 66k x 17k whole-text words: rounds t <= 4 by deletions took
# 68 s where length bands took 185 s.  Long strings keep the segment join:
# deletion variants would grow as C(L, t).
DELETION_MAX_T = 4
# A length band is one key for every string of the length: its rows are dealt
# over this many parts, to which the probing side is copied.
BAND_PARTS = 16


def threshold_pairs(left: DataFrame, right: DataFrame, t: int, x: str = "x",
                    y: str = "y", min_segment: int = 2,
                    block: list[str] | tuple = ()) -> DataFrame:
    """All (x, y, score) with levenshtein(x, y) <= t (both inputs distinct names).

    With ``block`` columns (present on both sides) only pairs of the same
    block are considered; they are part of every join key.  Indexed
    strings long enough for segments of ``min_segment`` characters use the
    segment join; shorter ones use deletion variants when t <=
    ``DELETION_MAX_T`` (few variants for a short string), else a length band.

    Lengths L with segments shorter than ``min_segment`` (L < min_segment·(t+1))
    are matched by length alone (every y of that length is a candidate): the
    segment filter would be no sharper there and only multiply join rows.
    """
    band_below = min_segment * (t + 1)
    use_del = t <= DELETION_MAX_T
    blk = list(block)
    ry = right.select(F.col(y).alias("_y"), *blk).withColumn("_L", F.length("_y"))
    start, length = _segments(F.col("_L"), t)
    short = F.col("_L") < band_below
    long_y = ry.filter(~short).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(t))))
    long_y = long_y.select("_y", *blk, "_L", "_i",
                           F.substr("_y", start(F.col("_i")) + 1, length(F.col("_i"))).alias("_seg"))
    if use_del:   # short y: deletion variants (a short string has few of them)
        short_y = ry.filter(short).select("_y", *blk, F.lit(-1).alias("_L"), F.lit(-2).alias("_i"),
                                          F.explode(_deletions(F.col("_y"), t)).alias("_seg"))
    else:         # short y: every y of the length is a candidate
        part = F.pmod(F.xxhash64("_y"), F.lit(BAND_PARTS)).cast("int")
        short_y = ry.filter(short).select("_y", *blk, "_L", (-1 - part).alias("_i"),
                                          F.lit("").alias("_seg"))
    ry = long_y.unionByName(short_y)

    lx = left.select(F.col(x).alias("_x"), *blk).withColumn("_Lx", F.length("_x"))
    lx = lx.withColumn("_L", F.explode(F.sequence(F.greatest(F.col("_Lx") - t, F.lit(0)),
                                                  F.col("_Lx") + t)))
    if use_del:   # x whose length band reaches short y: its deletion variants, once
        band = (lx.filter(F.col("_L") < band_below).select("_x", *blk).distinct()
                  .select("_x", *blk, F.lit(-1).alias("_L"), F.lit(-2).alias("_i"),
                          F.explode(_deletions(F.col("_x"), t)).alias("_seg")))
    else:
        band = lx.filter(F.col("_L") < band_below).select(
            "_x", *blk, "_L", F.explode(F.sequence(F.lit(-BAND_PARTS), F.lit(-1))).alias("_i"),
            F.lit("").alias("_seg"))
    lx = lx.filter(F.col("_L") >= band_below)
    lx = lx.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(t))))
    start, length = _segments(F.col("_L"), t)
    delta = F.col("_Lx") - F.col("_L")
    s0 = start(F.col("_i"))
    seglen = length(F.col("_i"))
    lo = F.greatest(s0 + F.ceil((delta - t) / 2).cast("int"), F.lit(0))
    hi = F.least(s0 + F.floor((delta + t) / 2).cast("int"), F.col("_Lx") - seglen)
    lx = lx.withColumn("_len", seglen).withColumn("_lo", lo).withColumn("_hi", hi)
    lx = lx.filter(F.col("_lo") <= F.col("_hi"))
    lx = lx.withColumn("_p", F.explode(F.sequence("_lo", "_hi")))
    lx = lx.select("_x", *blk, "_L", "_i",
                   F.substr("_x", F.col("_p") + 1, F.col("_len")).alias("_seg")).distinct()
    probes = lx.unionByName(band)

    return _within(probes.join(ry, [*blk, "_L", "_i", "_seg"]), t, x, y, blk)
