"""Scalar expressions shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

MONEY = "decimal(15,2)"


def money(column: str) -> Column:
    """Exact money: sums of it do not depend on the order of addition."""
    return F.col(column).cast(MONEY)


def cents(column: str) -> Column:
    """An amount held as a double with two decimals, as whole cents.

    As exact as a decimal, but sums of it stay machine integers: a grouped sum
    takes a third of the time. A sum beyond 2**63 cents raises an error under
    the default ANSI mode.
    """
    return F.rint(F.col(column) * 100).cast("long")


def from_cents(column: str) -> Column:
    return F.col(column) / F.lit(100.0)


def full_name(first: str, last: str) -> Column:
    """First and last name with a blank; NULL if either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def month_start(day: str) -> Column:
    return F.trunc(F.col(day), "month")


def day_before(day: str | Column) -> Column:
    return F.date_sub(day, 1)


def after_day(moment: str, day: str) -> Column:
    """True when the calendar day of ``moment`` is later than ``day``."""
    return F.to_date(F.col(moment)) > F.lit(day).cast("date")


def code_of(name: str | Column, codes: Mapping[str, int]) -> Column:
    """The code for a name; NULL for a name without one."""
    pairs = [F.lit(part) for entry in codes.items() for part in entry]
    column = F.col(name) if isinstance(name, str) else name
    return F.try_element_at(F.create_map(*pairs), column)


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True if any pair differs; NULL against a value counts as a difference."""
    return reduce(or_, [~old.eqNullSafe(new) for old, new in pairs])


def calendar_attributes(day: str) -> dict[str, Column]:
    """The attributes a date dimension holds for one day."""
    d = F.col(day)
    return {
        "day": F.dayofmonth(d),
        "day_name": F.date_format(d, "EEEE"),
        "week_no": F.weekofyear(d),
        "month": F.date_format(d, "MMMM"),
        "month_no": F.month(d),
        "quarter": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "year": F.year(d),
        "is_weekend": F.when(F.dayofweek(d).isin(1, 7), "Yes").otherwise("No"),
    }
