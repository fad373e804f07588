"""Projections, filters and predicates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """P1."""
    return df.drop(*cols)


def select_matching(df: DataFrame, regex: str, invert: bool = False) -> DataFrame:
    """Columns whose name matches ``regex`` (or does not, with ``invert``)."""
    rx = re.compile(regex)
    keep = [c for c in df.columns if bool(rx.search(c)) != invert]
    return df.select(*keep)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def strip_prefix(df: DataFrame, prefix: str, anchored: bool = True) -> DataFrame:
    """Remove a side prefix from column names.

    ``anchored=True`` removes it only at the start (Q2 fix);
    ``anchored=False`` removes it everywhere, as the reference's helper did.
    """
    if anchored:
        names = [c[len(prefix):] if c.startswith(prefix) else c for c in df.columns]
    else:
        names = [c.replace(prefix, "") for c in df.columns]
    return df.toDF(*names)


def split_label(df: DataFrame, label: str) -> tuple[list[str], str]:
    """(feature columns, label column)."""
    return [c for c in df.columns if c != label], label


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def columns_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, categorical columns) from the schema."""
    num, cat = [], []
    for f in df.schema.fields:
        (num if isinstance(f.dataType, NUMERIC) else cat).append(f.name)
    return num, cat


def drop_value(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to ``value``; NULL rows are kept (pandas semantics)."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def null_rows(df: DataFrame, col: str, null: bool = True) -> DataFrame:
    """Rows where ``col`` is (not) NULL."""
    return df.filter(F.col(col).isNull() if null else F.col(col).isNotNull())


def drop_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    """P10: drop rows where any of ``cols`` is the empty string."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~F.col(c).eqNullSafe(F.lit(""))
    return df.filter(cond)


def binary_label(col, positive) -> Column:
    """1 where ``col == positive`` else 0 (NULL stays 0)."""
    return F.when(_c(col) == F.lit(positive), 1).otherwise(0)


def replace_where(df: DataFrame, cond: Column, col: str, value) -> DataFrame:
    """Overwrite ``col`` with ``value`` where ``cond`` holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(F.col(col)))


def try_cast(col, to: str) -> Column:
    """Cast that yields NULL instead of raising under ANSI mode."""
    return _c(col).try_cast(to)


def int_or_null(col) -> Column:
    """Digits of the text as a bigint; NULL if there are none."""
    return F.nullif(F.regexp_replace(_c(col), r"\D", ""), F.lit("")).try_cast("bigint")


def with_row_id(df: DataFrame, order, name: str = "row_id", key=None) -> DataFrame:
    """Stable 1-based row id in ``order`` (a total order).

    With ``key`` the id restarts per key (window partitioned by key); without
    it the id is global and computed without a single-partition window.
    """
    from duelframe.operators.ordering import global_row_number, key_row_number

    if key is None:
        return global_row_number(df, order, name)
    return key_row_number(df, key, order, name, size_name=None)


def winner_loser(df: DataFrame, red: str = "R_name", blue: str = "B_name",
                 outcome: str = "Winner") -> DataFrame:
    """Winner / loser names from the two sides and the outcome; NULL for a draw."""
    w = F.col(outcome)
    return df.withColumns({
        "winner_name": F.when(w == "Red", F.col(red)).when(w == "Blue", F.col(blue)),
        "loser_name": F.when(w == "Blue", F.col(red)).when(w == "Red", F.col(blue)),
    })


def if_column(df: DataFrame, col: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``fn`` only if ``col`` exists."""
    return fn(df) if col in df.columns else df


__all__ = [n for n in dir() if not n.startswith("_")] + ["Window"]
