"""Ranks, positions and running totals that no single task has to sort.

A window without a partition key, or with one hot partition, sorts all its
rows in one task. Here rows are range-partitioned on the sort key instead,
every range is treated on its own, and a small table with one row per range
(and group) carries the totals of the earlier ranges over. Equal sort keys
are folded beforehand or told apart by a unique last key, so a hot value
cannot fill a range either.

Sort keys are column names; a leading ``-`` means descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.operators.joins import few, join_on_same
from tallyhouse.session import written

RANGE = "_range"
PLACE = "_place"
# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
PLACE_BITS = (1 << 33) - 1


def column_name(key: str) -> str:
    return key.lstrip("-")


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_first(k) for k in order]


def running_total(df: DataFrame, order: Sequence[str], value: str, total_as: str,
                  within: Sequence[str] = (), count_as: str | None = None,
                  unique: bool = False) -> DataFrame:
    """Cumulative sum of ``value`` in the given order; ties share one result.

    ``unique`` promises that the order (with ``within``) tells all rows apart;
    then the rows go through once and are not joined back.
    """
    keys = [*within, *map(column_name, order)]
    if unique:
        keyed = df.withColumns({"_sum": F.col(value), "_n": F.col(value).isNotNull().cast("long")})
    else:
        keyed = df.groupBy(*keys).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    ranged = written(
        keyed.repartitionByRange(*sort_columns([*within, *order]))
        .withColumn(RANGE, F.spark_partition_id()), "running-total")

    so_far = (Window.partitionBy(RANGE, *within).orderBy(*sort_columns(order))
              .rowsBetween(Window.unboundedPreceding, 0))
    inside = ranged.withColumns({"_run": F.sum("_sum").over(so_far), "_seen": F.sum("_n").over(so_far)})

    before = (Window.partitionBy(*within).orderBy(RANGE)
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (ranged.groupBy(RANGE, *within)
               .agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
               .select(RANGE, *within, F.sum("_sum").over(before).alias("_sum_before"),
                       F.sum("_n").over(before).alias("_n_before")))
    joined = join_on_same(inside, carried, [RANGE, *within])
    zero = F.lit(0)
    total = F.when(F.col("_run").isNotNull() | F.col("_sum_before").isNotNull(),
                   F.coalesce("_run", zero) + F.coalesce("_sum_before", zero))
    result = joined.withColumn(total_as, total)
    if count_as:
        result = result.withColumn(count_as, F.col("_seen") + F.coalesce("_n_before", zero))
    outputs = [total_as, *([count_as] if count_as else [])]
    if unique:
        return result.select(*df.columns, *outputs)
    return join_on_same(df, result.select(*keys, *outputs), keys)


def running_by_day(df: DataFrame, day: str, value: str, total_as: str | None = None,
                   average_as: str | None = None, descending: bool = False) -> DataFrame:
    """Running sum and average over a DATE column, every row kept.

    Rows are folded to one per calendar day first. The number of days is
    bounded by the calendar (36,525 in a century) and not by the data, so the
    prefix sum over days may be a plain window and its result a broadcast.
    """
    if dict(df.dtypes)[day] != "date":
        raise TypeError(f"{day} must be a date column; use running_total for other types")
    days = df.groupBy(day).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    order = sort_columns([f"-{day}" if descending else day])
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run, seen = F.sum("_sum").over(so_far), F.sum("_n").over(so_far)
    outputs = []
    if total_as:
        outputs.append(run.alias(total_as))
    if average_as:
        outputs.append(F.when(seen > 0, run.cast("double") / seen.cast("double")).alias(average_as))
    return join_on_same(df, F.broadcast(days.select(day, *outputs)), [day])


def rank_all(df: DataFrame, by: str, rank_as: str = "rank") -> DataFrame:
    """``rank()`` by ``by`` descending over the whole frame, ties sharing a rank."""
    ties = df.groupBy(by).agg(F.count(F.lit(1)).alias("_ties"))
    placed = running_total(ties, [f"-{by}"], "_ties", "_up_to", unique=True)
    ranks = placed.select(by, (F.col("_up_to") - F.col("_ties") + 1).alias(rank_as))
    return join_on_same(df, ranks, [by])


def rank_top(df: DataFrame, by: str, n: int, rank_as: str = "rank") -> DataFrame:
    """Rows with ``rank() <= n`` by ``by`` descending; all ties of the last rank stay.

    The ``n`` best values are found with a distributed top-k. They alone decide
    the ranks, so at most those ``n`` values are broadcast, if they are few.
    """
    best = df.select(by).orderBy(*sort_columns([f"-{by}"])).limit(n)
    ranks = best.select(by, F.rank().over(Window.orderBy(*sort_columns([f"-{by}"])))
                        .cast("long").alias(rank_as)).distinct()
    return join_on_same(df, few(ranks, n), [by]).select(*df.columns, rank_as)


def top_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows; end ``order`` with a unique key to make ties definite."""
    return df.orderBy(*sort_columns(order)).limit(n)


def top_entities(totals: DataFrame, dimension: DataFrame, key: str,
                 attributes: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` best keys known to the dimension, with their attributes.

    Only keys take part in the big join; the attributes are fetched for the
    ``n`` winners, which are broadcast if they are few.
    """
    known = totals.join(dimension.select(key), key, "left_semi")
    winners = top_n(known, order, n)
    named = dimension.select(key, *attributes).join(few(winners, n), key)
    return named.select(key, *attributes, *[c for c in totals.columns if c != key]) \
        .orderBy(*sort_columns(order))


def numbered(df: DataFrame, order: Sequence[str], within: Sequence[str] = (),
             number_as: str = "row_number", after: int = 0) -> DataFrame:
    """Gapless ``row_number()`` in the given order, per group if ``within`` is set.

    ``within`` and ``order`` together must tell all rows apart. The place of a
    row in its sorted range comes from the generated row id;
    the group's rows in earlier ranges are added. A big group spans many
    ranges, so the join on (range, group) is spread as evenly as the ranges.
    """
    sort = sort_columns([*within, *order])
    ranged = written(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .select("*", F.spark_partition_id().alias(RANGE),
                F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)).alias(PLACE)),
        "numbered")
    before = (Window.partitionBy(*within).orderBy(RANGE)
              .rowsBetween(Window.unboundedPreceding, -1))
    spans = (ranged.groupBy(RANGE, *within)
             .agg(F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first"))
             .select(RANGE, *within, "_first",
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    placed = join_on_same(ranged, spans, [RANGE, *within])
    number = F.col("_before") + F.col(PLACE) - F.col("_first") + F.lit(1 + after)
    return placed.select(*df.columns, number.cast("long").alias(number_as))


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The best row of each group. Spark cuts each task to one row per group before the shuffle."""
    best = Window.partitionBy(*group).orderBy(*sort_columns(order))
    return df.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")
