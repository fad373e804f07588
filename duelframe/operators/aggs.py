"""Aggregations A1-A15, A20.  One pass per table wherever possible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_count(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """A1: rows per group (partial aggregate before the shuffle)."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias(name))


def value_counts_multi(df: DataFrame, cols: list[str], value: str = "value",
                       name: str = "count") -> DataFrame:
    """A2: frequency of values over the union of several columns (nulls dropped)."""
    v = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(value))
    return v.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, cols: list[str], name: str = "count") -> DataFrame:
    """A3: frequency table for each column: (column, value, count); nulls dropped."""
    long = df.select(*[F.col(c).cast("string") for c in cols]).unpivot(
        [], cols, "column", "value")
    return (long.where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias(name)))


def group_mean(df: DataFrame, key, cols: list[str], suffix: str = "") -> DataFrame:
    """A4: NULL-ignoring mean per group."""
    return df.groupBy(*_names(key)).agg(*[F.avg(c).alias(c + suffix) for c in cols])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A5: (column, nulls) for every column in one aggregate pass."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column", "nulls")


def null_totals(df: DataFrame, threshold: int = 0) -> DataFrame:
    """Total nulls, and the number of columns with more than ``threshold``."""
    prof = null_profile(df)
    return prof.agg(F.sum("nulls").alias("total_nulls"),
                    F.count_if(F.col("nulls") > threshold).alias("columns_over"))


def has_null(df: DataFrame, col: str) -> DataFrame:
    """One row, true if ``col`` holds a NULL."""
    return df.agg(F.coalesce(F.bool_or(F.col(col).isNull()), F.lit(False)).alias("has_null"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def column_stats(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) - the schema listing with counts."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column", "non_null")
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return counts.withColumn("dtype", mapping[F.col("column")])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A10: distinct values, sorted."""
    return df.select(col).distinct().orderBy(col)


def mean_over_runs(df: DataFrame, key, metrics: list[str]) -> DataFrame:
    """Mean of each metric across repetitions."""
    return group_mean(df, key, metrics)


def median_over_folds(df: DataFrame, key, metrics: list[str], method: str = "auto") -> DataFrame:
    """Exact (interpolated) median of each metric across folds."""
    keys = _names(key)
    if _use_sort(df, keys, method):
        long = None
        for m in metrics:
            q = exact_quantiles(df, keys, m, [0.5]).withColumn("_metric", F.lit(m))
            long = q if long is None else long.unionByName(q)
        return long.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == m, F.col("value"))).alias(m)
                                         for m in metrics])
    return df.groupBy(*keys).agg(*[F.median(m).alias(m) for m in metrics])


HOT_GROUP_ROWS = 1 << 20


def _use_sort(df: DataFrame, keys: list[str], method: str) -> bool:
    """'sort' when a group is large enough that buffering it in one task is a
    risk (measured with one partial aggregate), 'aggregate' otherwise."""
    if method in ("sort", "aggregate"):
        return method == "sort"
    if not keys:
        n = df.count()
        return n > HOT_GROUP_ROWS
    mx = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0]
    return (mx or 0) > HOT_GROUP_ROWS


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs: list[float]) -> DataFrame:
    """Exact interpolated quantiles (same definition as ``percentile``) without
    buffering a group in one task.

    Values are numbered inside each group by a range-partitioned sort (a hot
    group spreads over many tasks); only the <= 2 rows per probability that
    bracket position p·(n-1) are kept and interpolated.  Output: keys, p, value;
    a group whose values are all NULL has NULL quantiles.
    """
    from duelframe.operators.ordering import key_row_number

    v = df.select(*keys, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if keys:
        numbered = key_row_number(v, keys, ["_v"], "_rn", "_n")
    else:
        from duelframe.operators.ordering import global_row_number

        numbered = global_row_number(v, ["_v"], "_rn", total_name="_n")
    pos = [(p, F.lit(p) * (F.col("_n") - 1)) for p in probs]
    wanted = F.array(*[x for _, ps in pos for x in (F.floor(ps) + 1, F.ceil(ps) + 1)])
    near = numbered.filter(F.array_contains(wanted.cast("array<bigint>"), F.col("_rn")))
    rows = near.groupBy(*keys).agg(F.first("_n").alias("_n"),
                                   F.map_from_entries(F.collect_list(F.struct("_rn", "_v")))
                                   .alias("_m"))
    if keys:   # groups without any value keep their rows
        groups = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(keys)]).distinct()
        on = F.lit(True)
        for i, c in enumerate(keys):
            on = on & F.col(f"_g{i}").eqNullSafe(F.col(c))
        rows = groups.join(rows, on, "left").select(
            *[F.col(f"_g{i}").alias(c) for i, c in enumerate(keys)], "_n", "_m")
    outs = []
    for p, _ in pos:
        ps = F.lit(p) * (F.col("_n") - 1)
        lo, hi = F.floor(ps), F.ceil(ps)
        vlo = F.element_at("_m", (lo + 1).cast("bigint"))
        vhi = F.element_at("_m", (hi + 1).cast("bigint"))
        val = F.when(lo == hi, vlo).otherwise((hi - ps) * vlo + (ps - lo) * vhi)
        outs.append(F.struct(F.lit(p).alias("p"), val.alias("value")))
    return rows.select(*keys, F.inline(F.array(*outs)))


def label_correlation(df: DataFrame, label: str, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with ``label``.

    One aggregate pass; constant columns (NULL / NaN correlation) removed.
    """
    from duelframe.operators.project import columns_by_type

    cols = cols or [c for c in columns_by_type(df)[0] if c != label]
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                   for c in cols])
    long = row.unpivot([], cols, "feature", "corr")
    return long.where(F.col("corr").isNotNull() & ~F.isnan("corr"))


FIVE = [0.0, 0.25, 0.5, 0.75, 1.0]


def five_number(df: DataFrame, cols: list[str], key=None, method: str = "auto") -> DataFrame:
    """Min, q1, median, q3, max (exact, interpolated) per column [per group].

    ``method='auto'`` measures the largest group; above ``HOT_GROUP_ROWS`` it
    uses ``exact_quantiles`` (sort-based) instead of ``percentile``, which
    buffers a whole group in one task.
    """
    keys = _names(key) if key else []
    names = ["min", "q1", "median", "q3", "max"]
    if _use_sort(df, keys, method):
        parts = []
        for c in cols:
            q = exact_quantiles(df, keys, c, FIVE)
            wide = q.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("p", "value")))
                                        .alias("_m"))
            parts.append(wide.select(*keys, F.lit(c).alias("column"),
                                     *[F.element_at("_m", F.lit(p)).alias(n)
                                       for p, n in zip(FIVE, names)]))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    aggs = [F.percentile(F.col(c), F.array(*[F.lit(p) for p in FIVE])).alias(c) for c in cols]
    wide = df.groupBy(*keys).agg(*aggs)
    long = wide.unpivot(keys, cols, "column", "q") if keys else wide.unpivot(
        [], cols, "column", "q")
    return long.select(*keys, "column", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
