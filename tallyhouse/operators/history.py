"""Dimension history: previous value (type 3), versions (type 2), both (type 6).

A version is valid from ``effective_date`` to ``expiry_date``, both included;
the open end is 9999-12-31. Changes are folded to one row per key and day
before any window, so a group holds at most one row per calendar day even if
one key owns a third of the feed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyhouse.operators.changes import one_per_key, same_key
from tallyhouse.operators.ordering import numbered
from tallyhouse.session import written

# Fixed value: the expiry date of a version that is still valid.
OPEN_END = "9999-12-31"
PERIOD = ("effective_date", "expiry_date", "is_current")


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


# --- type 3 -----------------------------------------------------------------

def start_previous_value(dimension: DataFrame, column: str) -> DataFrame:
    """Split ``column`` into ``current_column`` and an empty ``previous_column``."""
    kind = dimension.schema[column].dataType
    return _with_replaced(dimension, column, {
        f"current_{column}": F.col(column),
        f"previous_{column}": F.lit(None).cast(kind)})


def shift_previous_value(dimension: DataFrame, updates: DataFrame, key: str, column: str,
                         others: Sequence[str] = ()) -> DataFrame:
    """Type 3: the current value moves to previous where it really changes."""
    current, previous = f"current_{column}", f"previous_{column}"
    new = one_per_key(updates.select(key, column, *others), [key]).select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in (column, *others)])
    changed = F.col("_hit") & ~F.col(current).eqNullSafe(F.col(f"_new_{column}"))
    replaced = {current: F.when(F.col("_hit"), F.col(f"_new_{column}")).otherwise(F.col(current)),
                previous: F.when(changed, F.col(current)).otherwise(F.col(previous))}
    replaced.update({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in others})
    joined = dimension.join(new, key, "left")
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in dimension.columns])


# --- types 2 and 6: loading ---------------------------------------------------

def start_versions(dimension: DataFrame, effective: str) -> DataFrame:
    """Type 2 load: every row becomes the current version since ``effective``."""
    return dimension.withColumns({
        "effective_date": F.lit(effective).cast("date"),
        "expiry_date": _open_end(),
        "is_current": F.lit(True)})


def start_hybrid(dimension: DataFrame, column: str, effective: str) -> DataFrame:
    """Type 6 load: current and historical value are the same, none is previous."""
    kind = dimension.schema[column].dataType
    return start_versions(_with_replaced(dimension, column, {
        f"current_{column}": F.col(column),
        f"previous_{column}": F.lit(None).cast(kind),
        f"historical_{column}": F.col(column)}), effective)


def _with_replaced(df: DataFrame, column: str, by: Mapping[str, Column]) -> DataFrame:
    """Put the ``by`` columns where ``column`` was."""
    parts = []
    for c in df.columns:
        parts += [e.alias(n) for n, e in by.items()] if c == column else [F.col(c)]
    return df.select(*parts)


# --- types 2 and 6: applying changes ------------------------------------------

def _folded(updates: DataFrame, key: str, tracked: Sequence[str], last_by: Sequence[str]) -> DataFrame:
    """One row per key: its changes, at most one per day, in the order of their dates."""
    daily = one_per_key(updates.select(key, *tracked, "effective_date", *last_by),
                        [key, "effective_date"], last_by)
    change = F.struct("effective_date", F.struct(*tracked).alias("state"))
    return daily.groupBy(key).agg(F.array_sort(F.collect_list(change)).alias("_changes"))


def late_changes(dimension: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str],
                 last_by: Sequence[str] = ()) -> DataFrame:
    """Changes dated on or before the current version: reported, never applied."""
    since = current_rows(dimension).select(key, F.col("effective_date").alias("current_since")).alias("c")
    changes = _folded(updates, key, tracked, last_by).alias("u")
    late = F.filter("_changes", lambda change: change["effective_date"] <= F.col("current_since"))
    return (since.join(changes, same_key([key], "c", "u"))
            .select(f"c.{key}", "current_since", F.explode(late).alias("_change"))
            .select(key, "_change.state.*", "_change.effective_date", "current_since"))


def _steps(changes: Column, base: Column) -> Column:
    """The changes that differ from the state before them; ``base`` is the state before the first."""
    def differs(change: Column, at: Column) -> Column:
        return ~change["state"].eqNullSafe(F.coalesce(F.get(changes, at - 1)["state"], base))
    return F.filter(changes, differs)


def _version(step: Column, at: Column, steps: Column, base: Column) -> Column:
    """A step with the state it replaces and the end of its period."""
    following = F.get(steps, at + 1)["effective_date"]
    return F.struct(
        step["state"].alias("state"), F.coalesce(F.get(steps, at - 1)["state"], base).alias("before"),
        step["effective_date"].alias("effective_date"),
        F.coalesce(F.date_sub(following, 1), _open_end()).alias("expiry_date"),
        following.isNull().alias("is_current"))


def _versions(steps: str, base: Column) -> Column:
    return F.transform(steps, lambda step, at: _version(step, at, F.col(steps), base))


def _applied(dimension: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str],
             last_by: Sequence[str], state_before: Column, row_of: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Current rows meet the folded changes of their key once; a row leaves as it was or closed, with its new versions.

    ``state_before`` is the tracked state of a current row, ``row_of`` gives
    the columns of a new version. Closed versions pass through without a join.
    Keys that the dimension lacks start with their first change.
    """
    kind = T.StructType([T.StructField(c, updates.schema[c].dataType) for c in tracked])
    nothing = F.lit(None).cast(kind)
    changes = _folded(updates, key, tracked, last_by)
    current = dimension.filter("is_current")
    met = (current.alias("d").join(changes.alias("u"), same_key([key], "d", "u"), "left")
           .select("d.*", "_changes").withColumn("_base", state_before.cast(kind))
           .withColumn("_later", F.filter("_changes", lambda c: c["effective_date"] > F.col("effective_date")))
           .withColumn("_steps", _steps(F.col("_later"), F.col("_base"))))
    first = F.get("_steps", F.lit(0))["effective_date"]
    period = {"expiry_date": F.coalesce(F.date_sub(first, 1), F.col("expiry_date")), "is_current": first.isNull()}
    own = F.struct(*[period.get(c, F.col(c)).cast(dimension.schema[c].dataType).alias(c) for c in dimension.columns])

    def new_row(version: Column) -> Column:
        columns = {key: F.col(key), **row_of(version), **{c: version[c] for c in PERIOD}}
        return F.struct(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dimension.schema])

    rows = met.select(F.explode(F.concat(F.array(own), F.coalesce(
        F.transform(_versions("_steps", F.col("_base")), new_row), F.array().cast(T.ArrayType(dimension.schema))))).alias("_row"))
    starts = (changes.alias("u").join(current.select(key).alias("d"), same_key([key], "u", "d"), "left_anti")
              .withColumn("_steps", _steps(F.col("_changes"), nothing))
              .select(key, F.explode(_versions("_steps", nothing)).alias("_v")).select(new_row(F.col("_v")).alias("_row")))
    return (dimension.filter(~F.col("is_current"))
            .unionByName(rows.select("_row.*")).unionByName(starts.select("_row.*")))


def _require_known(dimension: DataFrame, known: Sequence[str]) -> None:
    """A new version can only hold what the change or the rule gives it."""
    unknown = [c for c in dimension.columns if c not in known]
    if unknown:
        raise ValueError(f"columns {unknown} would be lost in new versions: track them or drop them")


def apply_versions(dimension: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str],
                   last_by: Sequence[str] = (), surrogate: str | None = None) -> DataFrame:
    """Type 2: close the current version and add the new ones, in one result.

    A batch may hold several changes per key. A change equal to the state
    before it adds no version, so a repeated batch changes nothing; keys new
    to the dimension simply start. NULL is a key like any other. A
    ``surrogate`` column stays empty in new versions, for :func:`fill_surrogates`.
    """
    _require_known(dimension, [key, *tracked, *PERIOD, surrogate])
    return _applied(dimension, updates, key, tracked, last_by, F.struct(*tracked),
                    lambda version: {c: version["state"][c] for c in tracked})


def apply_hybrid(dimension: DataFrame, updates: DataFrame, key: str, column: str,
                 others: Sequence[str] = (), last_by: Sequence[str] = (),
                 surrogate: str | None = None) -> DataFrame:
    """Type 6: as type 2, and a new version also keeps the value it replaced.

    The closed version keeps its own current value.
    """
    current, previous, historical = (f"{when}_{column}" for when in ("current", "previous", "historical"))
    _require_known(dimension, [key, *others, *PERIOD, surrogate, current, previous, historical])
    before = F.struct(F.col(current).alias(column), *others)
    return _applied(dimension, updates, key, [column, *others], last_by, before, lambda version: {
        **{c: version["state"][c] for c in others}, current: version["state"][column],
        previous: version["before"][column], historical: version["state"][column]})


def fill_surrogates(dimension: DataFrame, surrogate: str, order: Sequence[str]) -> DataFrame:
    """Number the versions that have no surrogate yet, after the largest one given."""
    dimension = written(dimension, "versions")  # read three times below
    held = dimension.filter(F.col(surrogate).isNotNull())
    bare = dimension.filter(F.col(surrogate).isNull()).drop(surrogate)
    largest = held.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long").alias("n"))
    fresh = numbered(bare, order, number_as="_number")
    keyed = fresh.withColumn(surrogate, F.col("_number") + largest.scalar()).drop("_number")
    return held.unionByName(keyed.select(*dimension.columns))


# --- reading ------------------------------------------------------------------

def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter("is_current")


def as_of(dimension: DataFrame, day: str) -> DataFrame:
    """The versions valid on ``day``; both ends of a period count."""
    return dimension.filter(F.lit(day).cast("date").between(F.col("effective_date"), F.col("expiry_date")))


def history_of(dimension: DataFrame, key: str, values: Sequence) -> DataFrame:
    return dimension.filter(F.col(key).isin(*values)).orderBy(key, "effective_date")


def version_counts(dimension: DataFrame) -> DataFrame:
    """Total, current and historical records in one pass."""
    return dimension.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_current")).alias("current_records"),
        F.count_if(~F.col("is_current")).alias("historical_records"))


def version_faults(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that break a rule of versions, one row per key and broken rule.

    Rows are folded per key and day first: a key then has at most one row per
    calendar day, and two versions starting on one day are already an overlap.
    """
    days = dimension.groupBy(key, "effective_date").agg(
        F.count(F.lit(1)).alias("_n"), F.max("expiry_date").alias("_end"),
        F.count_if(F.col("is_current")).alias("_current"),
        F.count_if(F.col("expiry_date") < F.col("effective_date")).alias("_reversed"))
    following = Window.partitionBy(key).orderBy("effective_date")
    earlier = following.rowsBetween(Window.unboundedPreceding, -1)
    marked = days.withColumn("_overlap", (F.col("_n") > 1) | F.coalesce(
        F.max("_end").over(earlier) >= F.col("effective_date"), F.lit(False)))
    per_key = marked.groupBy(key).agg(
        F.sum("_current").alias("_current"), F.count_if("_overlap").alias("_overlaps"),
        F.sum("_reversed").alias("_reversed"))
    rules = {"not exactly one current version": F.col("_current") != 1,
             "overlapping versions": F.col("_overlaps") > 0,
             "expiry before start": F.col("_reversed") > 0}
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]),
                      lambda name: name.isNotNull())
    return per_key.select(key, F.explode(broken).alias("fault"))
