"""Exact closest pair of names in large blocks, without all pairs.

A profile is two names, its cost to another the sum of their edit distances.
The right profiles of a task are laid into units: the rows of one second name
if there are many, else of some neighbouring second names.  A left profile
first meets the unit of its nearest second name, which gives its limit, and
then only units whose second names alone are within the limit.  Inside a unit
popcounts bound the distances (``name_index.Bounds``), and a distance is
measured only where the bound is the least of its row, once per pair of
different names.  No pair is left out: one is passed over only if its bound is
above the cost already found, or equal to it behind a smaller row.

Profiles meet in (block, slot, part) groups of about SLOT left and PART right
profiles, so no task grows with the tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from duelframe.functions.bits import Pairs, Strings
from duelframe.operators.name_index import Bounds

SLOT = 8192                  # left profiles of a block in one task
PART = 32_768                # right profiles of a block in one task
STRIP = 512                  # left profiles compared at once, at least
CELLS = 1 << 22              # second distances kept at once: more left profiles while they are fewer
UNIT = 1024                  # right profiles compared at once
FAR = 1 << 40


class Distances:
    """Distances of the names of two lists: bounds until they are measured."""

    def __init__(self, left: list[str], right: list[str]):
        self.left, self.right = Strings(left), Strings(right)
        self.pairs, self.bounds = Pairs(self.left, self.right), Bounds(self.left, self.right)

    def block(self, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, whether measured) of some left and right names."""
        longer = np.abs(self.left.size[rows, None] - self.right.size[None, cols])
        out = np.maximum(self.bounds.some(rows, cols), longer).astype(np.int32)
        return out, np.zeros(out.shape, bool)

    def measure(self, rows: np.ndarray, cols: np.ndarray, near: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> None:
        """Puts the distances of rows[i] and cols[j] into ``near``, each pair of names once."""
        d, known = near
        new = ~known[i, j]
        cell = np.unique(i[new] * len(cols) + j[new])
        i, j = cell // len(cols), cell % len(cols)
        d[i, j] = self.pairs.edits(rows[i], cols[j])
        known[i, j] = True


def _coded(names: pa.ChunkedArray) -> tuple[np.ndarray, list[str]]:
    """(place of each row's name, the different names)."""
    coded = names.combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _units(second: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of rows sorted by second name: of one name each, or of some names with few rows."""
    edges = np.flatnonzero(np.diff(second, prepend=-1))
    ends = np.append(edges[1:], len(second))
    out, open_at = [], None
    for a, b in zip(edges.tolist(), ends.tolist()):
        if b - a >= UNIT // 8:
            if open_at is not None:
                out.append((open_at, a))
                open_at = None
            out.extend((c, min(c + UNIT, b)) for c in range(a, b, UNIT))
            continue
        open_at = a if open_at is None else open_at
        if b - open_at >= UNIT:
            out.append((open_at, b))
            open_at = None
    return out if open_at is None else [*out, (open_at, len(second))]


def closest(lw: pa.ChunkedArray, ll: pa.ChunkedArray, rw: pa.ChunkedArray, rl: pa.ChunkedArray, order: np.ndarray):
    """(cost, row): of each left profile the right row of least (sum of both distances, ``order``)."""
    (x1, first_l), (x2, second_l) = _coded(lw), _coded(ll)
    (y1, first_r), (y2, second_r) = _coded(rw), _coded(rl)
    one, two = Distances(first_l, first_r), Distances(second_l, second_r)
    by = np.lexsort((order, y2))
    y1, y2, order = y1[by], y2[by], order[by]
    units = _units(y2)
    starts = np.array([a for a, _ in units], np.int64)
    names = np.arange(len(second_r))                              # second names stand in the order of their codes
    cost, row = np.full(len(x1), FAR, np.int64), np.full(len(x1), -1, np.int64)
    place = np.full(len(x1), FAR, np.int64)                       # order of the row found

    def visit(left: np.ndarray, a: int, b: int, codes: np.ndarray, seconds: np.ndarray, near) -> None:
        """Compares left profiles with the rows from a to b; ``codes``: their rows of ``near``, of the names ``seconds``."""
        sort = a + np.argsort(order[a:b], kind="stable")
        same = y2[a] == y2[b - 1]
        if same:                                                  # the second distance is a constant: first names alone
            two.measure(seconds, names, near, np.unique(codes), np.full(len(np.unique(codes)), y2[a]))
            more = near[0][codes, y2[a]].astype(np.int64)
            rows, back = np.unique(x1[left], return_inverse=True)
            limit = np.full(len(rows), -1, np.int64)
            np.maximum.at(limit, back, cost[left] - more)
        else:
            rows, back = x1[left], np.arange(len(left))
            limit = cost[left]
        some, at = np.unique(rows, return_inverse=True)
        cols, col = np.unique(y1[sort], return_inverse=True)
        d1 = one.block(some, cols)
        best, found = np.full(len(rows), FAR, np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            total = d1[0][at[todo]][:, col]
            if not same:
                total = total + near[0][codes[todo]][:, y2[sort]]
            j = total.argmin(axis=1)
            least = total[np.arange(len(todo)), j]
            sure = d1[1][at[todo], col[j]]
            if not same:
                sure = sure & near[1][codes[todo], y2[sort[j]]]
            best[todo[sure]], found[todo[sure]] = least[sure], sort[j[sure]]
            keep = ~sure & (least <= limit[todo])
            todo, total, least = todo[keep], total[keep], least[keep]
            i, j = np.nonzero(total == least[:, None])
            one.measure(some, cols, d1, at[todo[i]], col[j])
            if not same:
                two.measure(seconds, names, near, codes[todo[i]], y2[sort[j]])
        best, found = best[back], found[back]
        if same:
            best = best + more
        better = (best < cost[left]) | ((best == cost[left]) & (order[found] < place[left]))
        better &= best < FAR
        which = left[better]
        cost[which], row[which], place[which] = best[better], found[better], order[found[better]]

    by_second = np.lexsort((x1, x2))
    step = max(STRIP, min(SLOT, CELLS // max(len(names), 1)))
    for at in range(0, len(by_second) if len(y1) else 0, step):
        strip = by_second[at:at + step]
        seconds, codes = np.unique(x2[strip], return_inverse=True)
        near = two.block(seconds, names)
        if near[0].size <= len(strip) * len(y1) // 16:            # few second names: all measured
            two.measure(seconds, names, near, *(c.ravel() for c in np.indices(near[0].shape)))
        bound = np.minimum.reduceat(near[0], y2[starts], axis=1)[codes]
        home = bound.argmin(axis=1)
        for u in np.unique(home).tolist():
            mine = np.flatnonzero(home == u)
            visit(strip[mine], *units[u], codes[mine], seconds, near)
        for u, (a, b) in enumerate(units):
            mine = np.flatnonzero((bound[:, u] <= cost[strip]) & (home != u))
            if len(mine):
                visit(strip[mine], a, b, codes[mine], seconds, near)
    return cost, np.where(row < 0, -1, by[row])


def closest_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """_bd, _lw, _ll, _cost2, _rrow: of each left profile (_bd, _lw, _ll) the row of
    ``right`` (_bd, _rw, _rl, _rrow) of the same block with the least (sum of both
    edit distances, _rrow) in each part of the block."""
    slots = left.groupBy("_bd").agg(F.ceil(F.count(F.lit(1)) / SLOT).cast("int").alias("_slots"))
    parts = right.groupBy("_bd").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("_parts"))
    sizes = slots.join(parts, "_bd").checkpoint(eager=True)       # a row per date
    groups = sizes.agg(F.sum(F.col("_slots") * F.col("_parts"))).first()[0] or 1
    # a group is little data and much work: a stated number of partitions is not coalesced
    n = min(groups, 16 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["_bd", "_slot", "_part"]

    def every(column):
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    lp = (left.join(F.broadcast(sizes), "_bd").withColumn("_slot", F.pmod(F.xxhash64("_lw", "_ll"), "_slots").cast("int"))
              .withColumn("_part", every("_parts")).select(*keys, "_lw", "_ll").repartition(n, *keys))
    rp = (right.join(F.broadcast(sizes), "_bd").withColumn("_part", F.pmod(F.xxhash64("_rw", "_rl"), "_parts").cast("int"))
               .withColumn("_slot", every("_slots")).select(*keys, "_rw", "_rl", "_rrow").repartition(n, *keys))
    rp = rp.withColumn("_order", F.row_number().over(Window.partitionBy(*keys).orderBy("_rrow")))

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not theirs.num_rows:
            mine = mine.slice(0, 0)
        cost, row = closest(mine["_lw"], mine["_ll"], theirs["_rw"], theirs["_rl"], theirs["_order"].to_numpy())
        return pa.table([mine["_bd"], mine["_lw"], mine["_ll"], pa.array(cost), theirs["_rrow"].take(pa.array(row))],
                        names=["_bd", "_lw", "_ll", "_cost2", "_rrow"])

    schema = StructType([*left.select("_bd", "_lw", "_ll").schema.fields, StructField("_cost2", LongType()), right.schema["_rrow"]])
    return lp.groupBy(*keys).cogroup(rp.groupBy(*keys)).applyInArrow(run, schema)
