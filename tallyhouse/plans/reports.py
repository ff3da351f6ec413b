"""The report catalogue.

Each report takes the fact and the dimension it needs, so it serves the star
model and, after flattening, the snowflake model alike. Column names are
parameters with the usual names as defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.ordering import (
    column_name, first_per_group, numbered, rank_all, rank_top, sort_columns, top_entities, top_n)
from tallyhouse.operators.totals import (
    Measures, above_scalar, count_per_entity, grand_total, totals_by, totals_by_attribute,
    totals_by_entity)

REVENUE: Measures = {"total_revenue": ("sum", "total_amount")}


def dashboard(amount: str = "total_amount", quantity: str = "quantity",
              sale: str = "sale_id") -> Measures:
    return {"total_transactions": ("count", sale), "units_sold": ("sum", quantity),
            "total_revenue": ("sum", amount)}


def revenue(sales: DataFrame, measures: Measures = REVENUE) -> DataFrame:
    """Business totals in one row."""
    return grand_total(sales, measures)


def revenue_by(sales: DataFrame, columns: Sequence[str], measures: Measures = REVENUE,
               order: Sequence[str] = ("-total_revenue",)) -> DataFrame:
    """Totals by columns of the fact itself, such as a status."""
    return totals_by(sales, columns, measures).orderBy(*sort_columns(order))


def revenue_per_entity(sales: DataFrame, dimension: DataFrame, key: str,
                       attributes: Sequence[str], measures: Measures = REVENUE,
                       order: Sequence[str] = ("-total_revenue",)) -> DataFrame:
    """One line per customer, product or branch that has sales."""
    totals = totals_by_entity(sales, dimension, key, attributes, measures)
    return totals.orderBy(*sort_columns([*order, key]))


def revenue_per_attribute(sales: DataFrame, dimension: DataFrame, key: str,
                          attributes: Sequence[str], measures: Measures = REVENUE,
                          order: Sequence[str] = ("-total_revenue",),
                          count_keys_as: str | None = None) -> DataFrame:
    """One line per category, brand, place, month and so on."""
    totals = totals_by_attribute(sales, dimension, key, attributes, measures, count_keys_as)
    return totals.orderBy(*sort_columns(order))


def _calendar(dates: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Date columns for a broadcast: one row per calendar day, however large the facts are."""
    return F.broadcast(dates.select(*dict.fromkeys([key, "date", *attributes])))


def revenue_per_period(sales: DataFrame, dates: DataFrame, key: str, attributes: Sequence[str],
                       measures: Measures = REVENUE) -> DataFrame:
    """Totals per month or quarter, listed in calendar order.

    The first day of a period is computed beside the totals, sorts the result
    and is dropped.
    """
    per_day = totals_by(sales, [key], measures)
    sums = [F.sum(name).alias(name) for name in measures]
    periods = (per_day.join(_calendar(dates, key, attributes), key)
               .groupBy(*attributes).agg(F.min("date").alias("_first_day"), *sums))
    return periods.orderBy("_first_day").select(*attributes, *measures)


def top_sellers(sales: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str],
                n: int, measures: Measures = REVENUE, by: str = "total_revenue") -> DataFrame:
    """The ``n`` best customers, products or branches; equal totals are ordered by key."""
    totals = totals_by(sales, [key], measures)
    return top_entities(totals, dimension, key, attributes, [f"-{by}", key], n)


def ranked(sales: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str],
           measures: Measures = REVENUE, by: str = "total_revenue", n: int | None = None) -> DataFrame:
    """Entities with their ``rank()``; with ``n`` only ranks up to ``n``, ties included."""
    totals = totals_by_entity(sales, dimension, key, attributes, measures)
    placed = rank_all(totals, by) if n is None else rank_top(totals, by, n)
    return placed.orderBy("rank", key)


def numbered_in_group(sales: DataFrame, dimension: DataFrame, key: str,
                      attributes: Sequence[str], group: str, measures: Measures = REVENUE,
                      by: str = "total_revenue") -> DataFrame:
    """Every entity with its ``row_number()`` inside its group, best first."""
    totals = totals_by_entity(sales, dimension, key, [*attributes, group], measures)
    return numbered(totals, [f"-{by}", key], [group])


def best_in_group(sales: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str],
                  group: str, measures: Measures = REVENUE, by: str = "total_revenue") -> DataFrame:
    totals = totals_by_entity(sales, dimension, key, [*attributes, group], measures)
    return first_per_group(totals, [group], [f"-{by}", key])


def above_average_sale(sales: DataFrame, dimension: DataFrame, key: str,
                       attributes: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Entities whose total exceeds the average single sale."""
    totals = totals_by_entity(sales, dimension, key, attributes, {"total_revenue": ("sum", amount)})
    return above_scalar(totals, "total_revenue", sales.agg(F.avg(amount)))


def above_average_entity(sales: DataFrame, dimension: DataFrame, key: str,
                         attributes: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Entities whose total exceeds the average total of all entities."""
    totals = totals_by_entity(sales, dimension, key, attributes, {"total_revenue": ("sum", amount)})
    return above_scalar(totals, "total_revenue", totals.agg(F.avg("total_revenue")))


def purchase_frequency(sales: DataFrame, dimension: DataFrame, key: str,
                       attributes: Sequence[str], counted: str) -> DataFrame:
    """Number of purchases of every customer who bought, most frequent first."""
    return revenue_per_entity(sales, dimension, key, attributes,
                              {"purchases": ("count", counted)}, ["-purchases"])


def purchase_frequency_all(sales: DataFrame, dimension: DataFrame, key: str,
                           attributes: Sequence[str]) -> DataFrame:
    """As above, customers without purchases included with 0, least frequent first."""
    return count_per_entity(sales, dimension, key, attributes, "purchases").orderBy("purchases", key)


def purchase_trend(sales: DataFrame, customers: DataFrame, dates: DataFrame, customer_key: str,
                   date_key: str, attributes: Sequence[str], period: Sequence[str],
                   measures: Measures) -> DataFrame:
    """Purchases per customer and period of the year."""
    dated = sales.join(_calendar(dates, date_key, period), date_key)
    sums = totals_by(dated.withColumn("_month", F.trunc("date", "month")),
                     [customer_key, *period, "_month"], measures)
    return (sums.join(customers.select(customer_key, *attributes), customer_key)
            .orderBy(customer_key, "_month")
            .select(customer_key, *attributes, *period, *measures))


def first_rows(report: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The head of any report, such as the single best customer of a view."""
    missing = [k for k in map(column_name, order) if k not in report.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return top_n(report, order, n)
