"""Approximate nearest neighbours (8): a forest of sorted hash-string arrays.

Every vector gets, per tree, a string of ``BITS`` random-hyperplane bits; a
tree is the sorted array of its strings, so all strings with a given prefix
are one slice.  A query descends each tree to its longest matching prefix and
then all trees ascend together, one bit at a time, until their slices hold
``share`` times the rows of the block, a row counted once per slice; the rows
found are scored by exact cosine.

Index rows are dealt by hash into blocks of about ``block_rows`` and the
stated query set into blocks of ``query_rows``; every pair of blocks is one
bounded task with its own forest, and the best of all blocks are merged per
query.  Equal vectors have equal strings, so copies are found together.

On vectors without structure the nearest ones are hardly nearer than the
rest, and a recall of 0.9 needs a large share; clustered vectors need less.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 32
TREES = 48
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
SHARE = 1.5


def hash_strings(x: np.ndarray, trees: int, seed: int = 0) -> np.ndarray:
    """(rows, trees) uint64 strings of BITS bits, first bit highest."""
    planes = np.random.default_rng(seed).standard_normal((x.shape[1], trees * BITS))
    bits = (x @ planes > 0).reshape(len(x), trees, BITS)
    return bits @ (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64))


class Forest:
    """Sorted hash strings of one block of unit vectors."""

    def __init__(self, x: np.ndarray, trees: int, seed: int = 0):
        self.x, self.trees, self.seed = x, trees, seed
        strings = hash_strings(x, trees, seed)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def slices(self, q: np.ndarray, wanted: int):
        """(low, high, depth) per query and tree: the longest common depth with ``wanted`` rows in all slices."""
        strings = hash_strings(q, self.trees, self.seed)
        low = np.zeros((len(q), self.trees), np.int64)
        high = np.full((len(q), self.trees), len(self.x), np.int64)
        depth = np.zeros(len(q), np.int64)
        going = np.arange(len(q))
        for d in range(1, BITS + 1):                       # the deepest level that still has enough
            shift = np.uint64(BITS - d)
            lo, hi = np.empty((len(going), self.trees), np.int64), np.empty((len(going), self.trees), np.int64)
            for t in range(self.trees):
                prefix = strings[going, t] >> shift
                lo[:, t] = np.searchsorted(self.sorted[:, t], prefix << shift, "left")
                hi[:, t] = np.searchsorted(self.sorted[:, t], (prefix + np.uint64(1)) << shift, "left")
            enough = (hi - lo).sum(axis=1) >= wanted
            going, lo, hi = going[enough], lo[enough], hi[enough]
            if not len(going):
                break
            low[going], high[going], depth[going] = lo, hi, d
        return low, high, depth

    def candidates(self, q: np.ndarray, wanted: int):
        """Per query, the rows of all slices, ascending and distinct."""
        low, high, _ = self.slices(q, wanted)
        seen = np.zeros(len(self.x), bool)
        for k in range(len(q)):
            seen[:] = False
            for t in range(self.trees):
                seen[self.order[low[k, t]:high[k, t], t]] = True
            yield np.flatnonzero(seen)


def _block_search(q: pd.DataFrame, rows: pd.DataFrame, k: int, trees: int, share: float) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(q) and len(rows):
        x, y = np.array(rows["v"].tolist(), np.float64), np.array(q["v"].tolist(), np.float64)
        ids, norm, qnorm = rows["id"].to_numpy(), np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
        unit = x / norm[:, None]
        forest = Forest(unit, trees)
        more = k * int(rows["id"].value_counts().iloc[0])     # k rows of different ids are among so many
        wanted = max(int(np.ceil(share * len(rows))), (more + 1) * trees)
        for n, found in enumerate(forest.candidates(y / qnorm[:, None], wanted)):
            mine = int(q["id"].iloc[n])
            found = found[ids[found] != mine]
            if not len(found):
                continue
            near = unit[found] @ (y[n] / qnorm[n])
            if len(found) > more:                          # the best and whatever may tie with them
                found = found[near >= np.partition(near, len(near) - more)[len(near) - more] - 1e-9]
            exact = (x[found] * y[n]).sum(axis=1) / (norm[found] * qnorm[n])
            best = np.lexsort((ids[found], -exact))
            best = best[np.sort(np.unique(ids[found][best], return_index=True)[1])[:k]]
            out["query_id"] += [mine] * len(best)
            out["vec_id"] += ids[found][best].tolist()
            out["score"] += exact[best].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part: an id, all components finite, not all zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(F.coalesce(c, F.lit(0.0)))
                      & (F.abs(F.coalesce(c, F.lit(0.0))) < float("inf")))
    zero = F.forall("v", lambda c: c == 0)
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & ~zero)


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            trees: int = TREES, share: float = SHARE, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``.  Vectors that are
    null, zero or hold null or non-finite components take no part, nor do
    rows without an id.  Vectors are compared with those of their own
    length.  A row with the query's id is never its neighbour; rows that
    repeat an id count once, by their best score.
    """
    rows = usable(vectors, id_col, vec_col)
    n, nq = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, qblocks = max(1, -(-n // block_rows)), max(1, -(-nq // query_rows))
    deal = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(parts)).cast("int")
    index = rows.select("id", "v", F.size("v").alias("dim"), deal(1, blocks).alias("b"),
                        F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))).alias("qb"))
    queries = rows.filter(is_query).select("id", "v", F.size("v").alias("dim"), deal(2, qblocks).alias("qb"),
                                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        return _block_search(q, r, k, trees, share)

    key = ["dim", "b", "qb"]
    found = queries.groupBy(*key).cogroup(index.groupBy(*key)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    # k rows of each block at most; one row of a repeated id
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
