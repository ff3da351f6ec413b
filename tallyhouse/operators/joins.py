"""Joins and unions by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


#: Rows that may be broadcast by hint; a larger side is left to Spark's own size check.
MOST_BROADCAST = 100_000


def few(df: DataFrame, n: int) -> DataFrame:
    """``df``, which has about ``n`` rows, as a broadcast side if that is few enough."""
    return F.broadcast(df) if n <= MOST_BROADCAST else df


def join_on_same(left: DataFrame, right: DataFrame, columns: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join on equally named columns, where NULL equals NULL.

    The right copies of the columns are dropped. The condition stays an
    equality for Spark, so it is hashed or sorted like any other equi-join.
    """
    marked = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns],
                          *[c for c in right.columns if c not in columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    return left.join(marked, same, how).drop(*[f"_r_{c}" for c in columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
