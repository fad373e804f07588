"""Quality classifier (4): hashed word n-grams, FTRL-proximal logistic regression.

Words are runs of letters and digits or runs of punctuation.  Features are
hashed word 1-grams and 2-grams; a word after itself is the same 2-gram
whatever the word ("repeat"), so repetition is learnt across vocabularies.
A feature's value is the root of its share among the text's n-grams, which
gives every text norm 1 whatever its length.  The weights are fitted by
follow-the-regularised-leader on a bounded sample of labelled rows and a
score is a sparse dot product with the weight table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm import shingles as sh
from duelframe.llm.common import small_batches, text_chunks
from duelframe.llm.labelled import remainder, training_rows

BITS = 20
TRAIN_ROWS = 8_000
_U = np.uint64


def features(column: pa.Array):
    """(feature, value, bounds per document), features sorted within a document."""
    data, offsets = sh.arrow_bytes(column.fill_null(""))
    w, counts = sh.words(data, offsets, sh.SPLIT)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair = sh.mix(w[:-1] * _U(0x9E3779B97F4A7C15) + w[1:]) if len(w) else w
    if len(w):
        pair = np.where(w[:-1] == w[1:], _U(0x5EED), pair)
        inside = doc[:-1] == doc[1:]
        h, d = np.concatenate([w, pair[inside]]), np.concatenate([doc, doc[:-1][inside]])
    else:
        h, d = w, doc
    slot = (sh.mix(h) >> _U(64 - BITS)).astype(np.int64)
    key, n = np.unique(d * (1 << BITS) + slot, return_counts=True)
    d, slot = key >> BITS, key & ((1 << BITS) - 1)
    total = np.bincount(d, weights=n, minlength=len(counts))
    return slot, np.sqrt(n / np.maximum(total, 1)[d]), np.searchsorted(d, np.arange(len(counts) + 1))


def ftrl(slot, value, bounds, y, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over the rows in order; slot 0 is the bias too."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = np.array([1 << BITS])

    def weights(i):
        free = np.abs(z[i]) > l1
        return np.where(free, (np.sign(z[i]) * l1 - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for k in range(len(y)):
            a, b = bounds[k], bounds[k + 1]
            i, x = np.concatenate([slot[a:b], bias]), np.concatenate([value[a:b], [1.0]])
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y[k]) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    return weights(np.arange((1 << BITS) + 1))


def fit(sample: DataFrame, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3,
        l2: float = 1e-3) -> np.ndarray:
    """The weight table (bias last) from (dfx_id, dfx_y, dfx_text); zeros without rows of both labels.

    FTRL takes one row after the other, so the bounded sample is fitted in
    one task, in the order of a hash of the id; each label weighs the same.
    """
    def run(batches):
        parts, ys, at = [], [], 0
        for batch in batches:
            for part in text_chunks(batch, "dfx_text"):
                slot, value, bounds = features(part.column("dfx_text"))
                parts.append((slot.astype(np.int32), value.astype(np.float32), bounds[1:] + at))
                ys.append(part.column("dfx_y").to_numpy(zero_copy_only=False))
                at += len(slot)
        if not parts:
            return
        slot, value = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        bounds, y = np.concatenate([[0], *[p[2] for p in parts]]), np.concatenate(ys)
        if y.min() == y.max():
            return
        w = ftrl(slot, value, bounds, y, epochs, alpha, beta, l1, l2)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["slot", "w"])

    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("dfx_id"), "dfx_id", F.xxhash64("dfx_text"))
    got = ordered.select("dfx_y", "dfx_text").mapInArrow(run, "slot long, w double").toPandas()
    table = np.zeros((1 << BITS) + 1, np.float32)
    table[got["slot"].to_numpy()] = got["w"].to_numpy()
    return table


def score(docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row; empty and null texts get the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(table)      # 4 MB, whatever the input

    def run(batches):
        w = shared.value
        for batch in batches:
            for part in text_chunks(batch, "dfx_text"):
                slot, value, bounds = features(part.column("dfx_text"))
                s = np.concatenate([[0.0], np.cumsum(w[slot] * value)])
                p = 1 / (1 + np.exp(-np.clip(s[bounds[1:]] - s[bounds[:-1]] + w[-1], -35, 35)))
                yield pa.RecordBatch.from_arrays([part.column("dfx_id"), pa.array(p)], names=["dfx_id", "score"])

    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"))
    return cols.mapInArrow(run, "dfx_id long, score double").withColumnRenamed("dfx_id", id_col)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 3, held: int = 1,
            train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Labels of held-out ids (crc32 remainder ``held``) are not read.  Without
    labelled rows of both kinds every score is 0.5.  A null id is not held
    out.  Repeated rows are scored each.
    """
    small_batches(docs.sparkSession)
    sample = training_rows(docs, labels, label, remainder(id_col, mod) != held, train_rows, id_col, text_col)
    out = score(docs, fit(sample), id_col, text_col)
    return out.select(id_col, F.coalesce(remainder(id_col, mod) == held, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
