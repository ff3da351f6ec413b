"""Row changes as functions ``(target, change) -> new target``.

Plain Parquet tables take no row-level update, so each function returns the
whole new content, to be written as a new version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.expressions import any_differs


def one_per_key(df: DataFrame, keys: Sequence[str], last_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the one greatest by ``last_by``, then by the other columns.

    A maximum, unlike ``dropDuplicates``, gives the same row in every run, and
    it is folded inside each task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in last_by]
    if not rest and not last_by:
        return df.select(*keys).distinct()
    row = F.max(F.struct(*last_by, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def keys_among(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Those keys of ``candidates`` that the target holds.

    The target is cut by a semi join first: a small set of candidates is
    broadcast by Spark, and then hardly anything of the target is shuffled.
    """
    wanted = candidates.select(*keys).distinct()
    return target.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def _with_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def unknown_rows(source: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key is not among ``known``: one per key, and every row with a NULL in its key."""
    named = one_per_key(without_null_keys(source, keys), keys)
    return (named.join(known, list(keys), "left_anti").select(*source.columns)
            .unionByName(_with_null_keys(source, keys)))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target lacks: one per key, and every row with a NULL in its key."""
    return unknown_rows(source, keys_among(target, source, keys), keys)


def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert what is new; matched rows stay as they are.

    A NULL in a key matches nothing, as in SQL: each such row is inserted, and
    again if the merge is repeated. Rows with whole keys are inserted once.
    """
    return target.unionByName(new_rows(target, source, keys))


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which ``condition`` is true; unknown (NULL) keeps the row."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def same_key(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys of the frames aliased ``left`` and ``right``; here NULL is a value."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def restore_rows(target: DataFrame, earlier: DataFrame, keys: Sequence[str],
                 condition: Column) -> DataFrame:
    """Bring back rows of an earlier state that meet ``condition`` and are gone now.

    Both are states of one table, so a NULL key is the same key in both.
    """
    return target.unionByName(lost_rows(target, earlier, keys, condition).select(*target.columns))


def lost_rows(target: DataFrame, earlier: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows of an earlier state that meet ``condition`` and are gone now."""
    wanted, here = earlier.filter(condition).alias("w"), target.select(*keys).alias("t")
    return wanted.join(here, same_key(keys, "w", "t"), "left_anti")


def state_of(log: DataFrame, keys: Sequence[str], upto: int) -> DataFrame:
    """The rows present after version ``upto`` of a log of inserts (op ``I``) and deletes (op ``D``).

    ``log`` has the columns of the table, ``op`` and ``version``; within a
    version an insert follows a delete. A hash maximum over the keys finds
    each key's last entry, and only then whole rows are moved.
    """
    moment = F.col("version") * 2 + (F.col("op") == "I").cast("long")
    entries = log.filter(F.col("version") <= upto).withColumn("_moment", moment)
    last = entries.groupBy(*keys).agg(F.max("_moment").alias("_moment")).filter("_moment % 2 = 1")
    same = same_key([*keys, "_moment"], "e", "l")
    rows = [c for c in log.columns if c not in ("op", "version")]
    return entries.alias("e").join(last.alias("l"), same, "left_semi").select(*rows)


def row_spans(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row a log has inserted, with the versions ``since`` and ``until`` (NULL: still there) it came and went.

    Same contract as :func:`state_of`. One shuffle serves all versions: once
    stored, each state and each version's changes are a filter of the spans.
    """
    log = log.withColumn("_moment", F.col("version") * 2 + (F.col("op") == "I").cast("long"))
    back = Window.partitionBy(*keys).orderBy(F.desc("_moment"))
    # Entries of one moment end together, at the key's next moment.
    log = log.withColumn("_later", F.lag("_moment").over(back))
    later = F.when(F.col("_later") > F.col("_moment"), F.col("_later"))
    following = F.last(later, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    rows = [c for c in log.columns if c not in ("op", "version", "_moment", "_later")]
    return (log.withColumn("_following", following).filter("op = 'I'")
            .select(*rows, F.col("version").alias("since"), F.shiftright("_following", 1).alias("until")))


def present_at(spans: DataFrame, version: int) -> DataFrame:
    """The rows of ``row_spans`` present after ``version``."""
    there = (F.col("since") <= version) & F.coalesce(F.col("until") > version, F.lit(True))
    return spans.filter(there).drop("since", "until")


def changes_at(spans: DataFrame, version: int) -> DataFrame:
    """What ``version`` did to the rows of ``row_spans``, with ``action`` INSERT or DELETE; an update is both."""
    actions = F.filter(F.array(F.when(F.col("until") == version, "DELETE"), F.when(F.col("since") == version, "INSERT")),
                       lambda action: action.isNotNull())
    touched = spans.filter((F.col("until") == version) | (F.col("since") == version))
    return touched.withColumn("action", F.explode(actions)).drop("since", "until")


def net_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns one state into the other, as rows with ``action`` and ``is_update``.

    An update is a DELETE row with the old and an INSERT row with the new
    content. One full outer join; NULL counts as a value.
    """
    rest = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(F.lit("DELETE").alias("action"), *rest).alias("_old"))
    new = after.select(*keys, F.struct(F.lit("INSERT").alias("action"), *rest).alias("_new"))
    joined = old.alias("o").join(new.alias("n"), same_key(keys, "o", "n"), "full_outer")
    state = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in rest])
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    same = both & state("_old").eqNullSafe(state("_new")) if rest else both
    feed = F.filter(F.array("_old", "_new"), lambda entry: entry.isNotNull())
    return (joined.filter(~same)
            .select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], both.alias("is_update"),
                    F.explode(feed).alias("_e"))
            .select(*keys, *[F.col(f"_e.{c}").alias(c) for c in rest], "_e.action", "is_update"))


def _paired(dimension: DataFrame, updates: DataFrame, key: str,
            columns: Sequence[str]) -> DataFrame:
    """``old_x`` / ``new_x`` columns for every updated key the dimension has."""
    old = dimension.select(key, *[F.col(c).alias(f"old_{c}") for c in columns])
    new = one_per_key(updates.select(key, *columns), [key]).select(
        key, *[F.col(c).alias(f"new_{c}") for c in columns])
    return old.join(new, key)


def changed_rows(dimension: DataFrame, updates: DataFrame, key: str,
                 columns: Sequence[str]) -> DataFrame:
    """One row per key with any difference, old and new value side by side."""
    pairs = [(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in columns]
    side_by_side = [name for c in columns for name in (f"old_{c}", f"new_{c}")]
    return (_paired(dimension, updates, key, columns)
            .filter(any_differs(pairs)).select(key, *side_by_side))


def changed_attributes(dimension: DataFrame, updates: DataFrame, key: str,
                       columns: Sequence[str]) -> DataFrame:
    """One row per changed attribute. One join serves all attributes."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(f"old_{c}").cast("string").alias("old_value"),
                 F.col(f"new_{c}").cast("string").alias("new_value")) for c in columns])
    return (_paired(dimension, updates, key, columns)
            .select(key, F.inline(entries))
            .filter(~F.col("old_value").eqNullSafe(F.col("new_value"))))


def overwrite_attributes(dimension: DataFrame, updates: DataFrame, key: str,
                         columns: Sequence[str]) -> DataFrame:
    """Type 1: updated keys take the new values, the old ones are lost."""
    new = one_per_key(updates.select(key, *columns), [key]).select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = dimension.join(new, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in dimension.columns])
