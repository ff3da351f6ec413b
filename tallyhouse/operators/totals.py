"""Grouped totals over a fact table and its dimensions.

The fact is reduced to one row per foreign key before it meets a dimension.
The first, map-side step of that aggregation folds a hot key inside each
task, so the shuffle and the join see every key once per task at most,
however many rows it owns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

Measures = Mapping[str, tuple[str, str]]

_FIRST = {"sum": F.sum, "count": F.count}


def _aggregates(measures: Measures) -> list[Column]:
    return [_FIRST[kind](column).alias(name) for name, (kind, column) in measures.items()]


def _recombined(measures: Measures) -> list[Column]:
    """Both kinds are additive: partial sums and partial counts are summed."""
    return [F.sum(name).alias(name) for name in measures]


def totals_by(fact: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """``measures`` maps an output name to ``("sum" | "count", column)``."""
    return fact.groupBy(*keys).agg(*_aggregates(measures))


def grand_total(fact: DataFrame, measures: Measures) -> DataFrame:
    return fact.agg(*_aggregates(measures))


def totals_by_entity(fact: DataFrame, dimension: DataFrame, key: str,
                     attributes: Sequence[str], measures: Measures,
                     how: str = "inner") -> DataFrame:
    """One row per dimension key. ``key`` must be unique in ``dimension``."""
    totals = totals_by(fact, [key], measures)
    return (totals.join(dimension.select(key, *attributes), key, how)
            .select(key, *attributes, *measures))


def totals_by_attribute(fact: DataFrame, dimension: DataFrame, key: str,
                        attributes: Sequence[str], measures: Measures,
                        count_keys_as: str | None = None) -> DataFrame:
    """One row per combination of dimension attributes.

    ``count_keys_as`` adds the number of different keys that have facts: after
    the first step that is a plain count, no distinct is needed.
    """
    joined = totals_by(fact, [key], measures).join(dimension.select(key, *attributes), key)
    counted = [F.count(key).alias(count_keys_as)] if count_keys_as else []
    return joined.groupBy(*attributes).agg(*counted, *_recombined(measures))


def count_per_entity(fact: DataFrame, dimension: DataFrame, key: str,
                     attributes: Sequence[str], name: str) -> DataFrame:
    """Number of facts per dimension row; rows without facts get 0."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    kept = dimension.select(key, *attributes).join(counts, key, "left")
    return kept.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))


def key_number(df: DataFrame, column: str) -> Column | None:
    """The value as a whole number, for types that bitmaps can hold; None for others."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    return F.col(column).cast("long") if isinstance(kind, T.IntegralType) else None


def key_profile(fact: DataFrame, keys: Mapping[str, str], rows_as: str) -> DataFrame:
    """Row count and the number of different values of each key, in one row.

    ``keys`` maps an output name to a column. Whole numbers and dates are set
    as bits: one scan lists the numbers of all keys, each task folds them to a
    bitmap for each key and stretch of 32,768 numbers, and only bitmaps are
    shuffled and united. Keys of other types get a two-step count of their
    own. A NULL is no value.
    """
    numbers = {name: key_number(fact, column) for name, column in keys.items()}
    set_as_bits = [name for name, number in numbers.items() if number is not None]
    others = [fact.select(keys[name]).distinct().agg(F.count(keys[name])).scalar().alias(name)
              for name in keys if name not in set_as_bits]
    if not set_as_bits:
        return fact.agg(F.count(F.lit(1)).alias(rows_as)).select(rows_as, *others)
    listed = fact.select(F.inline(F.array(*(F.struct(F.lit(i).alias("_key"), numbers[name].alias("_number"))
                                            for i, name in enumerate(set_as_bits)))))
    bits = listed.groupBy("_key", F.bitmap_bucket_number("_number").alias("_stretch")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_number"))).alias("_values"), F.count(F.lit(1)).alias("_rows"))
    of_key = lambda i, column: F.coalesce(F.sum(F.when(F.col("_key") == i, F.col(column))), F.lit(0))
    counted = bits.agg(of_key(0, "_rows").alias(rows_as), *(of_key(i, "_values").alias(name) for i, name in enumerate(set_as_bits)))
    return counted.select(rows_as, *(others[[n for n in keys if n not in set_as_bits].index(name)] if name not in set_as_bits else name
                                     for name in keys))


def above_scalar(totals: DataFrame, column: str, level: DataFrame) -> DataFrame:
    """Rows whose ``column`` exceeds the single value held by ``level``."""
    return totals.filter(F.col(column) > level.scalar())
