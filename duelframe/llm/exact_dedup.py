"""Exact dedup (7): tree merge of sorted digest runs, DataFrame functions only.

Every input partition yields one *run*: its distinct digests with their row
count and their keeper.  Runs are merged in binomial rounds: in a round the
runs ``FAN_IN*i .. FAN_IN*i+FAN_IN-1`` meet, cut by digest, and a multiway
merge keeps one row per digest, until one run (spread over all tasks by
digest) is left.  A text held by a third of all rows is one row per run
before the first exchange, and the answer travels back the same way: merged
digests join the leaf runs (one row per run and digest), and those join the
rows of their own run, so no task sees all copies of a text.

Texts are the same when SHA-256, byte length and a 64-bit hash of the
normalised text all agree; the last two verify the digest at every level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import written

FAN_IN = 16
BROADCAST_KEYS = 500_000        # 16 bytes each
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["dfx_sha", "dfx_bytes", "dfx_check"]


def normalised(text):
    """The text with A-Z lower-cased, null as empty; other letters stay."""
    t = F.coalesce(text, F.lit(""))
    return F.translate(t, UPPER, UPPER.lower())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, raw_hash.

    Null texts count as empty.  The row with the largest id of a group is
    kept (null ids are the smallest; of rows with the same id and text one
    is kept, any).  Only the id and the text are read, so further columns may
    have any name.  An empty table gives an empty result.  ``raw_hash`` is
    the 64-bit hash of the text as it was, to find a kept row again.
    """
    norm = normalised(F.col(text_col))
    leaf = docs.select(F.col(id_col).alias("dfx_id"), F.xxhash64(text_col).alias("dfx_raw"),
                       norm.alias("dfx_norm"))
    leaf = leaf.select(
        "dfx_id", "dfx_raw", F.sha2("dfx_norm", 256).alias("dfx_sha"),
        F.octet_length("dfx_norm").cast("long").alias("dfx_bytes"),
        F.xxhash64("dfx_norm").alias("dfx_check"),
        F.spark_partition_id().alias("dfx_run"), F.monotonically_increasing_id().alias("dfx_uid"))
    leaf = written(leaf, "dedup-rows")
    runs = leaf.groupBy(*KEY, "dfx_run").agg(
        F.max(F.struct("dfx_id", "dfx_uid")).alias("dfx_keep"), F.count(F.lit(1)).alias("dfx_n"))
    runs = written(runs.sortWithinPartitions(*KEY), "dedup-runs")
    root, left = runs, (runs.agg(F.max("dfx_run")).first()[0] or 0) + 1
    while True:
        root = (root.groupBy(*KEY, F.floor(F.col("dfx_run") / FAN_IN).alias("dfx_run"))
                .agg(F.max("dfx_keep").alias("dfx_keep"), F.sum("dfx_n").alias("dfx_n")))
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    root = root.drop("dfx_run")
    down = runs.select(*KEY, "dfx_run").join(root, KEY)
    return leaf.join(down, [*KEY, "dfx_run"]).select(
        F.col("dfx_id").alias(id_col), F.col("dfx_keep.dfx_id").alias("keep_id"),
        F.col("dfx_n").alias("group_size"), (F.col("dfx_uid") == F.col("dfx_keep.dfx_uid")).alias("kept"),
        F.col("dfx_sha").alias("text_sha256"), F.col("dfx_raw").alias("raw_hash"))


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one row per text."""
    found = written(exact_dedup(docs, id_col, text_col).select(
        F.col(id_col).alias("dfx_kid"), F.col("raw_hash").alias("dfx_kraw"), "kept"), "dedup-kept")
    rows = docs.withColumn("dfx_raw", F.xxhash64(F.col(text_col)))
    return kept_rows(rows, found, [(id_col, "dfx_kid"), ("dfx_raw", "dfx_kraw")]).drop("dfx_raw")


def kept_rows(rows: DataFrame, found: DataFrame, key: list[tuple[str, str]]) -> DataFrame:
    """The rows whose key (column, column of ``found``) is kept; of rows that repeat a whole key, one.

    Up to BROADCAST_KEYS kept keys are broadcast, so the texts stay where
    they are; beyond that both sides are joined by shuffle.  Only when a key
    repeats at all are rows brought together by key.
    """
    theirs = [b for _, b in key]
    kept = found.filter("kept").select(*theirs)
    if kept.count() <= BROADCAST_KEYS:
        kept = F.broadcast(kept)
    on = [F.col(a).eqNullSafe(F.col(b)) for a, b in key]
    rows = rows.join(kept, on, "left_semi")
    if found.groupBy(*theirs).count().filter("count > 1").isEmpty():
        return rows
    w = Window.partitionBy(*[a for a, _ in key]).orderBy(key[0][0])
    return rows.withColumn("dfx_rn", F.row_number().over(w)).filter("dfx_rn = 1").drop("dfx_rn")
