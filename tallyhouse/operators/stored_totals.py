"""Stored aggregates that take in new batches, or changes, without rereading old rows.

Three kinds of state, each a folder with one subfolder per batch or version, so
that one that is added again replaces itself:

* totals: sums and counts of each batch; reading adds them up;
* a dashboard: also averages, kept as sum and count, and exact numbers of
  distinct keys, kept as bitmaps that are united when read;
* maintained totals: signed sums of inserted and deleted rows, and extremes,
  which are worked out again only for groups whose extreme has left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.operators.joins import join_on_same
from tallyhouse.operators.totals import key_number, totals_by
from tallyhouse.session import written


def add_totals(batch: DataFrame, path: str, keys: Sequence[str], measures: Mapping[str, tuple[str, str]], name: str) -> None:
    """Store the totals of one batch. ``measures`` are sums and counts by result name."""
    totals_by(batch, keys, measures).write.mode("overwrite").parquet(f"{path}/batch={name}")


def read_totals(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The totals of all batches together."""
    return spark.read.parquet(path).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])


class Dashboard(NamedTuple):
    """Totals per group of ``keys`` that take batches of new rows.

    ``sums``, ``averages`` and ``distincts`` map a result name to a column;
    distinct columns are whole numbers or dates. A batch leaves one row per
    group for sums and counts, and one bitmap for each group and stretch of
    32,768 numbers a distinct column has there.
    """
    path: str
    keys: Sequence[str]
    rows_as: str
    sums: Mapping[str, str] = {}
    averages: Mapping[str, str] = {}
    distincts: Mapping[str, str] = {}

    def add(self, batch: DataFrame, name: str) -> None:
        """Take in one batch; the same ``name`` again replaces what it left."""
        parts = {**{f"sum_{n}": F.sum(c) for n, c in {**self.sums, **self.averages}.items()},
                 **{f"n_{n}": F.count(c) for n, c in {**self.sums, **self.averages}.items()}}
        rows = batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"), *(e.alias(n) for n, e in parts.items()))
        rows.write.mode("overwrite").parquet(f"{self.path}/totals/batch={name}")
        if self.distincts:
            entries = F.array(*(F.struct(F.lit(n).alias("counted"), key_number(batch, c).alias("number")) for n, c in self.distincts.items()))
            numbers = batch.select(*self.keys, F.inline(entries)).where("number is not null")
            bits = numbers.groupBy(*self.keys, "counted", F.bitmap_bucket_number("number").alias("stretch")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
            bits.write.mode("overwrite").parquet(f"{self.path}/distincts/batch={name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches together: a group's rows, sums, averages and numbers of distinct values."""
        parts = [f"{kind}_{n}" for n in (*self.sums, *self.averages) for kind in ("sum", "n")]
        totals = spark.read.parquet(f"{self.path}/totals").groupBy(*self.keys).agg(
            F.sum("n_rows").alias(self.rows_as), *(F.sum(part).alias(part) for part in parts))
        named = [*self.keys, self.rows_as, *(F.col(f"sum_{n}").alias(n) for n in self.sums),
                 *((F.col(f"sum_{n}").cast("double") / F.nullif(f"n_{n}", F.lit(0))).alias(n) for n in self.averages)]
        result = totals.select(*named)
        if not self.distincts:
            return result
        united = (spark.read.parquet(f"{self.path}/distincts").groupBy(*self.keys, "counted", "stretch")
                  .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
        counts = united.groupBy(*self.keys).agg(*(F.sum(F.when(F.col("counted") == n, F.col("n"))).alias(n) for n in self.distincts))
        return join_on_same(result, counts, self.keys, "left").na.fill(0, list(self.distincts))


class Maintained(NamedTuple):
    """Totals per group of ``keys`` that follow inserts, deletes and updates.

    ``sums`` maps a result name to a column, ``extremes`` to ``("min" | "max",
    column)``. Versions are whole numbers and are applied in ascending order.
    """
    path: str
    keys: Sequence[str]
    rows_as: str
    sums: Mapping[str, str] = {}
    extremes: Mapping[str, tuple[str, str]] = {}

    def apply(self, feed: DataFrame, version: int, now: DataFrame) -> None:
        """Take in the net changes that lead to ``version``; the same version again replaces what it left.

        ``feed`` has the rows with ``action`` INSERT or DELETE, an update as
        both. ``now`` is the table after them: it is read only for groups from
        which a row at the extreme has left, and not at all if there is none.
        """
        spark = feed.sparkSession
        came = F.col("action") == "INSERT"
        sign = F.when(came, 1).otherwise(-1)
        parts = {"n_rows": F.sum(sign)}
        for name, column in self.sums.items():
            parts |= {f"sum_{name}": F.sum(sign * F.col(column)), f"n_{name}": F.sum(F.when(F.col(column).isNotNull(), sign).otherwise(0))}
        for name, (kind, column) in self.extremes.items():
            of = getattr(F, kind)
            parts |= {f"in_{name}": of(F.when(came, F.col(column))), f"out_{name}": of(F.when(~came, F.col(column)))}
        delta = feed.groupBy(*self.keys).agg(*(e.alias(n) for n, e in parts.items()))
        if self.extremes:
            delta = written(delta, "delta")  # read for the groups in doubt and again for the result
            delta = self._with_extremes(delta, self._stored(spark, version - 1), now)
        delta.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def _with_extremes(self, delta: DataFrame, held: DataFrame | None, now: DataFrame) -> DataFrame:
        """What came in, or the group's extreme in ``now`` with ``reset_`` true where the one held may have left."""
        names = list(self.extremes)
        kinds = {name: kind for name, (kind, _) in self.extremes.items()}
        if held is None:
            return delta.select("*", *(F.col(f"in_{n}").alias(f"ext_{n}") for n in names),
                                *(F.lit(False).alias(f"reset_{n}") for n in names))
        met = join_on_same(delta, held.select(*self.keys, *(F.col(n).alias(f"held_{n}") for n in names)), self.keys, "left")

        def left(n: str) -> Column:
            reached = F.col(f"out_{n}") <= F.col(f"held_{n}") if kinds[n] == "min" else F.col(f"out_{n}") >= F.col(f"held_{n}")
            return F.col(f"out_{n}").isNotNull() & F.coalesce(reached, F.lit(True))

        marked = written(met.select(*delta.columns, *(left(n).alias(f"reset_{n}") for n in names)), "marked")
        doubtful = marked.where(reduce(or_, [F.col(f"reset_{n}") for n in names])).select(*self.keys)
        again = join_on_same(now, doubtful, self.keys, "left_semi").groupBy(*self.keys).agg(
            *(getattr(F, kind)(column).alias(f"again_{n}") for n, (kind, column) in self.extremes.items()))
        return join_on_same(marked, again, self.keys, "left").select(
            *marked.columns, *(F.when(F.col(f"reset_{n}"), F.col(f"again_{n}")).otherwise(F.col(f"in_{n}")).alias(f"ext_{n}") for n in names))

    def _stored(self, spark: SparkSession, upto: int | None) -> DataFrame | None:
        """All groups up to a version, emptied ones included; None before the first."""
        if upto is not None and upto < 1:
            return None
        rows = spark.read.parquet(self.path)
        rows = rows if upto is None else rows.where(F.col("version") <= upto)
        parts = ["n_rows", *(f"{kind}_{n}" for n in self.sums for kind in ("sum", "n"))]
        entries = [F.collect_list(F.struct("version", F.col(f"reset_{n}").alias("reset"), F.col(f"ext_{n}").alias("value"))).alias(f"all_{n}")
                   for n in self.extremes]
        folded = rows.groupBy(*self.keys).agg(*(F.sum(part).alias(part) for part in parts), *entries)

        def extreme(n: str, kind: str) -> Column:
            """Over what came since the last time it was worked out again."""
            entries = F.col(f"all_{n}")
            since = F.coalesce(F.array_max(F.transform(entries, lambda e: F.when(e["reset"], e["version"]))), F.lit(0))
            values = F.transform(F.filter(entries, lambda e: e["version"] >= since), lambda e: e["value"])
            return F.array_min(values) if kind == "min" else F.array_max(values)

        return folded.select(*self.keys, *parts, *(extreme(n, kind).alias(n) for n, (kind, _) in self.extremes.items()))

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The totals after the last version, or after ``upto``; groups without rows are left out.

        A sum over no value is NULL, as in SQL.
        """
        stored = self._stored(spark, upto)
        sums = [F.when(F.col(f"n_{n}") > 0, F.col(f"sum_{n}")).alias(n) for n in self.sums]
        return stored.where("n_rows > 0").select(*self.keys, F.col("n_rows").alias(self.rows_as), *sums, *self.extremes)
