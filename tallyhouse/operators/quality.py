"""Checks of keys, references and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.joins import union_all


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "duplicate_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)


def orphan_rows(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks; a NULL key is an orphan too."""
    return fact.join(dimension.select(key), key, "left_anti").select(*fact.columns)


def orphan_counts(fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Number of unmatched fact rows for each named ``(dimension, key)``.

    Facts are counted per key before the join, so a hot key is one row in it.
    """
    results = []
    for name, (dimension, key) in dimensions.items():
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        lost = per_key.join(dimension.select(key), key, "left_anti")
        results.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("unmatched_rows"))
                       .select(F.lit(name).alias("dimension"), "unmatched_rows"))
    return union_all(results)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()])


def key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """For each table: rows, rows with a NULL in the key, and key values held more than once."""
    results = []
    for name, (df, keys) in tables.items():
        has_null = reduce(or_, [F.col(k).isNull() for k in keys])
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        results.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(has_null, F.col("_n"))), F.lit(0)).alias("null_keys"),
            F.count_if(~has_null & (F.col("_n") > 1)).alias("repeated_keys"))
            .select(F.lit(name).alias("table_name"), "row_count", "null_keys", "repeated_keys"))
    return union_all(results)
