"""Global row numbers without a single-partition window (P17, W7 support).

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
Instead the table is range-partitioned (sampling spreads hot values over
several tasks), sorted inside each partition, and numbered with
``monotonically_increasing_id`` which is contiguous inside a partition.  A
table with one row per (partition[, key]) then turns local positions into
global ones; that table is bounded by the partition count (or by keys ×
partitions) and is joined back, broadcast only when AQE sees it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


TARGET_PARTITION_BYTES = 32 * 1024 * 1024   # on-disk (compressed) bytes per range partition


def _num_partitions(df: DataFrame, partitions: int | None) -> int:
    """Range-partition count: explicit, else sized from Catalyst's estimate
    (one partition per ~32 MB of input), capped by spark.sql.shuffle.partitions."""
    if partitions:
        return partitions
    from duelframe.operators.joins import estimated_bytes

    cap = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    est = estimated_bytes(df)
    return max(1, min(cap, -(-est // TARGET_PARTITION_BYTES)))


def _materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder."""
    from duelframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def global_row_number(df: DataFrame, order, name: str = "row_id",
                      partitions: int | None = None, total_name: str | None = None) -> DataFrame:
    """Add a contiguous 1-based row number in ``order`` (must be a total order).

    Helper columns are dropped; ``total_name`` optionally adds the row count.
    The partition count table has one row per range partition, so its
    broadcast is size-bounded.
    """
    order_cols = _as_cols(order)
    p = _num_partitions(df, partitions)
    s = (df.repartitionByRange(p, *order_cols)
           .sortWithinPartitions(*order_cols)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = _materialize(s)
    stats = (s.groupBy("_pid")
               .agg(F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_cnt")))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    keep = ["_pid", "_mid0", "_off"]
    if total_name:
        stats = stats.withColumn(total_name, F.sum("_cnt").over(Window.partitionBy()))
        keep.append(total_name)
    out = s.join(F.broadcast(stats.select(*keep)), "_pid")
    return (out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_mid0") + 1)
               .drop("_pid", "_mid", "_mid0", "_off"))


def key_row_number(df: DataFrame, key, order, name: str = "_rn",
                   size_name: str | None = "_size",
                   partitions: int | None = None) -> DataFrame:
    """Row number (1-based) inside each ``key`` in ``order``, hot-key safe.

    Equivalent to ``row_number().over(partitionBy(key).orderBy(order))`` but a
    key holding a third of all rows is spread over many range partitions
    instead of one task.  Optionally adds the group size.
    """
    key_names = [key] if isinstance(key, str) else list(key)
    if not all(isinstance(k, str) for k in key_names):
        raise TypeError("key must be column name(s)")
    keys = _as_cols(key_names)
    order_cols = _as_cols(order)
    p = _num_partitions(df, partitions)
    s = (df.repartitionByRange(p, *keys, *order_cols)
           .sortWithinPartitions(*keys, *order_cols)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = _materialize(s)
    stats = (s.groupBy(*key_names, "_pid")
               .agg(F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_cnt")))
    wk = Window.partitionBy(*key_names).orderBy("_pid")
    stats = stats.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    if size_name:
        stats = stats.withColumn(size_name, F.sum("_cnt").over(Window.partitionBy(*key_names)))
    stats = stats.drop("_cnt").withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(key_names)})
    stats = stats.withColumnRenamed("_pid", "_key_pid")
    same = s["_pid"] == stats["_key_pid"]             # a null key is a key like any other
    for i, k in enumerate(key_names):
        same = same & s[k].eqNullSafe(stats[f"_key_{i}"])
    out = s.join(stats, same).drop("_key_pid", *[f"_key_{i}" for i in range(len(key_names))])
    return (out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_mid0") + 1)
               .drop("_pid", "_mid", "_mid0", "_off"))


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """O3: global top-k (planned as TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*_as_cols(order)).limit(k)


def preview(df: DataFrame, order, n: int = 5, tail: bool = False) -> DataFrame:
    """Head (or tail) rows in ``order``, shown in ``order``.

    ``order`` holds column names (ascending) or any sort expressions.  The
    head, and the tail by names, is a per-task top-n; the tail by expressions,
    whose direction cannot be turned round, goes by the distributed row number.
    """
    cols = _as_cols(order)
    if not tail:
        return df.orderBy(*cols).limit(n)
    names = [order] if isinstance(order, str) else order if isinstance(order, (list, tuple)) else [order]
    if all(isinstance(c, str) for c in names):
        return df.orderBy(*[F.col(c).desc_nulls_last() for c in names]).limit(n).orderBy(*cols)
    numbered = global_row_number(df, cols, "_row")
    return numbered.orderBy(F.desc("_row")).limit(n).orderBy("_row").drop("_row")


def shuffle_key(id_col, seed: int | None = 0) -> Column:
    """Repeatable pseudo-random key: md5 of ``id:seed`` (same in any engine)."""
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string") if isinstance(id_col, str)
                             else id_col.cast("string"), F.lit(str(seed))))


def shuffle_rows(df: DataFrame, id_col: str, seed: int = 0, name: str = "shuffle_pos") -> DataFrame:
    """Repeatable shuffle; ``name`` gives the new position (1-based)."""
    keyed = df.withColumn("_shuf", shuffle_key(id_col, seed))
    return global_row_number(keyed, ["_shuf", id_col], name).drop("_shuf")


def reverse_order(df: DataFrame, pos: str) -> DataFrame:
    """O6."""
    return df.orderBy(F.col(pos).desc())


def top_half(corr: DataFrame, feature: str = "feature", value: str = "corr",
             exclude: list[str] | None = None) -> DataFrame:
    """Keep the floor(n/2) (at least 1) features with the largest |corr|·100.

    Ascending sort by the score, keep the last half (Q16: never all when n < 2).
    The correlation table has one row per feature (bounded by the schema).
    """
    c = corr
    if exclude:
        c = c.filter(~F.col(feature).isin(exclude))
    c = c.withColumn("score", F.abs(F.col(value)) * 100)
    w = Window.orderBy(F.col("score").desc(), F.col(feature).desc())
    keep = F.greatest(F.floor(F.col("_n") / 2), F.lit(1))
    ranked = (c.withColumn("_r", F.row_number().over(w))
               .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy())))
    return ranked.filter(F.col("_r") <= keep).drop("_r", "_n")
