"""Building, splitting and flattening dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import calendar_attributes
from tallyhouse.operators.joins import join_on_same
from tallyhouse.operators.ordering import numbered


def assign_keys(rows: DataFrame, key_name: str, order: Sequence[str], after: int = 0) -> DataFrame:
    """Give every row a number in the given order, starting at ``after + 1``."""
    return numbered(rows, order, number_as=key_name, after=after).select(key_name, *rows.columns)


def extract_lookup(flat: DataFrame, natural_key: Sequence[str], id_name: str,
                   existing: DataFrame | None = None) -> DataFrame:
    """A lookup table of the different ``natural_key`` values, with an id for each.

    Distinct comes before numbering. With ``existing`` only values new to it
    get ids, so ids given once stay.
    """
    values = flat.select(*natural_key).distinct()
    if existing is None:
        return assign_keys(values, id_name, natural_key)
    unseen = join_on_same(values, existing.select(*natural_key), natural_key, "left_anti")
    largest = existing.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("long").alias("n"))
    added = assign_keys(unseen, "_number", natural_key)
    keyed = added.withColumn(id_name, F.col("_number") + largest.scalar())
    return existing.unionByName(keyed.select(*existing.columns))


def add_parent(child: DataFrame, parent: DataFrame, natural_key: Sequence[str],
               parent_id: str) -> DataFrame:
    """Add the parent's id to a child lookup; children without a parent stay, with NULL."""
    return join_on_same(child, parent.select(*natural_key, parent_id), natural_key, "left")


def normalise_dimension(flat: DataFrame, lookup: DataFrame, natural_key: Sequence[str],
                        id_name: str) -> DataFrame:
    """Replace the ``natural_key`` columns by the lookup's id; no row is lost or multiplied."""
    joined = join_on_same(flat, lookup.select(*natural_key, id_name), natural_key, "left")
    return joined.drop(*natural_key)


def flatten_dimension(dimension: DataFrame, chain: Sequence[tuple[DataFrame, str]],
                      how: str = "left") -> DataFrame:
    """Follow a chain of lookups, dimension side first, before any fact is touched.

    Lookups are joined by plain equi-joins: Spark broadcasts those whose size
    is known to be small and shuffles the others.
    """
    flat = dimension
    for lookup, key in chain:
        flat = flat.join(lookup, key, how)
    return flat


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` with its calendar attributes."""
    span = spark.range(1).select(F.lit(first).cast("date").alias("first"),
                                 F.lit(last).cast("date").alias("last"))
    return _days_of(span)


def date_dimension_for(df: DataFrame, day: str) -> DataFrame:
    """The date dimension that covers the days found in ``df``."""
    return _days_of(df.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def _days_of(span: DataFrame) -> DataFrame:
    days = span.select("first", F.explode(F.sequence("first", "last")).alias("date"))
    return days.select((F.date_diff("date", "first") + 1).alias("date_id"), "date",
                       *[e.alias(n) for n, e in calendar_attributes("date").items()])
