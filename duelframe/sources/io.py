"""Tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "csv") -> DataFrame:
    """Headered CSV (explicit schema preferred; inference is a full extra scan)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                with_row_id: bool = False, order=None, row_id: str = "row_id",
                partition_by: list[str] | None = None) -> str:
    """Write a headered CSV (or parquet), optionally with a row-id column.

    The row id is a stable global row number in ``order`` (S3); it is
    computed without a single-partition window.
    """
    if with_row_id:
        from duelframe.operators.ordering import global_row_number

        df = global_row_number(df, order or df.columns, row_id)
        df = df.select(row_id, *[c for c in df.columns if c != row_id])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(fmt)
    return path


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Text lines, stripped of surrounding whitespace."""
    from duelframe.functions.keys import strip_ws

    return spark.read.text(path).select(strip_ws("value").alias(name))


def write_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> str:
    """One string column as text lines."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)
    return path


def from_records(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """Records (a list of dicts, or an RDD of dicts) -> table with an explicit schema."""
    names = schema.fieldNames()
    if hasattr(rows, "map"):
        tuples = rows.map(lambda d: tuple(d.get(n) for n in names))
    else:
        tuples = [tuple(d.get(n) for n in names) for d in rows]
    return spark.createDataFrame(tuples, schema)


def records_from_json(df: DataFrame, col: str, schema: StructType) -> DataFrame:
    """S6 for records that already live in a table (one JSON object per row):
    parsed against the explicit schema with ``from_json`` - JVM-side, no
    Python per row.  Non-nullable fields of the schema are enforced."""
    parsed = df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        cond = F.lit(True)
        for c in required:
            cond = cond & F.col(c).isNotNull()
        parsed = parsed.filter(F.assert_true(cond).isNull())
    return parsed


def literal_table(spark: SparkSession, mapping: dict, key: str = "key",
                  value: str = "value", schema: str | None = None) -> DataFrame:
    """A small literal lookup table (broadcast it when joining)."""
    return spark.createDataFrame(list(mapping.items()), schema or [key, value])
