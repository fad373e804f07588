"""A bounded sample of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(id_col, mod: int):
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def training_rows(docs: DataFrame, labels: DataFrame, label: str, fold, limit: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(dfx_id, dfx_y, dfx_text) of about ``limit`` labelled documents at most.

    ``fold`` is a condition on the id.  The rows are chosen by a hash of the
    id, so the same ids are chosen whatever the partitioning.  A document
    labelled both ways and null labels are left out.
    """
    rows = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).filter(fold)
    rows = rows.groupBy(F.col(id_col).alias("dfx_lid")).agg(
        F.min(label).alias("dfx_y"), F.max(label).alias("dfx_y2")).filter("dfx_y = dfx_y2")
    n = rows.count()
    if n > limit:
        rows = rows.filter(F.pmod(F.xxhash64("dfx_lid"), F.lit(1 << 20)) < int((1 << 20) * limit / n))
    rows = F.broadcast(rows.select("dfx_lid", F.col("dfx_y").cast("int").alias("dfx_y")))   # about ``limit`` rows
    return docs.join(rows, F.col(id_col) == F.col("dfx_lid")).select(
        F.col("dfx_lid").alias("dfx_id"), "dfx_y", F.coalesce(F.col(text_col), F.lit("")).alias("dfx_text"))
