"""Columnar table scans and writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def scan(spark: SparkSession, folder: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """Read ``folder/name.parquet``, only ``columns`` when given."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Truncate and reload. ``df`` must not read from ``path`` itself."""
    df.write.mode("overwrite").parquet(path)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """Rows typed in by hand, as in an insert of literal values."""
    return spark.createDataFrame(list(rows), schema)
