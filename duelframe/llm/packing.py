"""Packing (10): bounded-space online best fit of token sequences.

Each input partition is packed in one pass with ``open_windows`` windows.  A
document is cut into full windows and a rest; a rest goes into the open
window it leaves least room in.  When none fits, the fullest window is
emitted and a new one opened, so a task holds a fixed number of windows
whatever it reads.  The windows still open at the end of a partition are
merged over partitions in rounds of ``FAN_IN`` partitions: their pieces are
lengths only, packed best-fit again, and the windows of a round that are
under half full go on to the next.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import merged_chunks, small_batches, tidy, written
from duelframe.llm.tokens import encoder

FAN_IN = 64
PIECES = ("dfx_id long, start long, length long, doc_tokens long, ids binary, dfx_seq long, offset long, "
          "dfx_open boolean, dfx_part int")


class Windows:
    """Open windows by room left; ``place`` returns (window, offset) and the windows emitted."""

    def __init__(self, size: int, limit: int, first: int):
        self.size, self.limit, self.next = size, limit, first
        self.open: list[tuple[int, int]] = []          # (room left, window), ascending

    def place(self, n: int) -> tuple[int, int]:
        at = bisect_left(self.open, (n, -1))
        if at < len(self.open):
            room, window = self.open.pop(at)
        else:
            if len(self.open) >= self.limit:
                self.open.pop(0)                       # the fullest goes out
            room, window = self.size, self.next
            self.next += 1
        if room > n:
            insort(self.open, (room - n, window))
        return window, self.size - room


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, open_windows: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, ids (little-endian uint32), sequence_id, offset.

    A null or empty text is its end id alone.  Documents of more than
    ``size`` ids are cut; rows that repeat an id are packed as rows of their
    own.  Only the id and the text are read.  An empty table gives no piece.
    """
    small_batches(docs.sparkSession)
    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"),
                       F.spark_partition_id().alias("dfx_part"))

    def run(batches: Iterable[pa.RecordBatch]):
        windows, waiting = None, None
        code = encoder(tokenizer)
        for part in merged_chunks(batches, "dfx_text", 2 << 20):
            if windows is None:
                pid = part.column(2)[0].as_py()
                windows = Windows(size, open_windows, pid << 40)
            ids, bounds = code.encode(part.column(1), end_id)
            rows = {k: [] for k in ("doc", "start", "length", "total", "seq", "offset", "at")}
            for i in range(part.num_rows):
                a, b = int(bounds[i]), int(bounds[i + 1])
                for s in range(a, b, size):
                    n = min(size, b - s)
                    window, offset = windows.place(n)
                    for k, v in (("doc", i), ("start", s - a), ("length", n), ("total", b - a),
                                 ("seq", window), ("offset", offset), ("at", s)):
                        rows[k].append(v)
            yield _pieces(part, rows, ids, pid, False)
        if windows is not None:                        # which windows are still open
            left = [w for _, w in windows.open]
            k = len(left)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([size - r for r, _ in windows.open], pa.int64()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(left, pa.int64()),
                 pa.nulls(k, pa.int64()), pa.array([True] * k, pa.bool_()), pa.array([pid] * k, pa.int32())],
                names=[f.split()[0] for f in PIECES.split(", ")])
        tidy()

    pieces = written(cols.mapInArrow(run, PIECES), "pack-pieces")
    left = pieces.filter("dfx_open").select("dfx_seq", F.col("length").alias("used"), F.col("dfx_part").cast("long").alias("part"))
    moved = merge_open(left, size, open_windows)
    done = pieces.filter("not dfx_open").join(moved, "dfx_seq", "left")
    return done.select(
        F.col("dfx_id").alias(id_col), "start", "length", "doc_tokens", "ids",
        F.coalesce("to_seq", "dfx_seq").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def _pieces(part: pa.RecordBatch, rows: dict, ids: np.ndarray, pid: int, open_: bool) -> pa.RecordBatch:
    n = len(rows["doc"])
    at = np.array(rows["at"], np.int64)
    bounds = np.concatenate([at, [at[-1] + rows["length"][-1]]]) if n else np.zeros(1, np.int64)
    blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids)])
    return pa.RecordBatch.from_arrays(
        [part.column(0).take(pa.array(rows["doc"], pa.int64())), pa.array(rows["start"], pa.int64()),
         pa.array(rows["length"], pa.int64()), pa.array(rows["total"], pa.int64()), blob.cast(pa.binary()),
         pa.array(rows["seq"], pa.int64()), pa.array(rows["offset"], pa.int64()),
         pa.array([open_] * n, pa.bool_()), pa.array([pid] * n, pa.int32())],
        names=[f.split()[0] for f in PIECES.split(", ")])


def merge_open(left: DataFrame, size: int, open_windows: int) -> DataFrame:
    """(dfx_seq, to_seq, shift): where each window left open goes.

    Round by round the open windows of FAN_IN neighbouring groups meet in
    one task: at most FAN_IN * open_windows of them, as a round hands on no
    more than ``open_windows`` windows of a group (the emptiest).
    """
    import pandas as pd

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["used", "to_seq", "dfx_seq"], ascending=[False, True, True], kind="stable")
        heads = rows.drop_duplicates("to_seq")
        windows, place, fill = Windows(size, 1 << 30, 0), {}, {}
        name = []
        for seq, used in zip(heads["to_seq"], heads["used"]):
            w, offset = windows.place(int(used))
            if w == len(name):
                name.append(seq)
            place[seq] = (name[w], offset)
            fill[name[w]] = offset + int(used)
        rows["shift"] += rows["to_seq"].map(lambda s: place[s][1])
        rows["to_seq"] = rows["to_seq"].map(lambda s: place[s][0])
        rows["used"] = rows["to_seq"].map(fill)
        rows["grp"] //= FAN_IN
        emptiest = set(pd.Series(fill).sort_values(kind="stable").index[:open_windows])
        rows["live"] = rows["to_seq"].isin(emptiest)
        return rows

    state = left.select("dfx_seq", F.col("dfx_seq").alias("to_seq"), F.lit(0).cast("long").alias("shift"),
                        "used", F.floor(F.col("part") / FAN_IN).alias("grp"), F.lit(True).alias("live"))
    groups, done = (left.agg(F.max("part")).first()[0] or 0) // FAN_IN + 1, None
    while True:
        state = written(state.groupBy("grp").applyInPandas(meet, state.schema), "pack-open")
        done = state.filter("not live") if done is None else done.unionByName(state.filter("not live"))
        state = state.filter("live")
        if groups <= 1:                                # all that was left has met
            break
        groups = -(-groups // FAN_IN)
    return done.unionByName(state).select("dfx_seq", "to_seq", "shift")
