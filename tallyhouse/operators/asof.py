"""Facts with the version of their dimension row that was valid on their own day.

Versions of a key are folded to one per day and end where the next begins, so
they cannot overlap. Time is cut into spans of equal length; a version stands
in every span it touches, within the days the facts have. A fact then meets
the few versions of its key in its own span by an equality of (key, span),
which Spark sorts or hashes once. A key that owns a third of the facts is so
dealt over as many tasks as it has spans, and what is still too large for one
task Spark may split, as the versions' side of it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.operators.changes import one_per_key

_KEY, _SPAN, _SINCE, _UNTIL = "_key", "_span", "_since", "_until"


def _span_of(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days)


def version_periods(versions: DataFrame, key: str, columns: Sequence[str], since: str, until: str | None = None) -> DataFrame:
    """``_key``, ``_since``, ``_until`` and ``columns``, one row per key and first day.

    Of several versions that begin on one day the greatest row counts. A
    version ends on the day before the next one, or with its own ``until`` if
    that is earlier; the last has no end unless ``until`` gives one. Rows
    without a key or first day are left out.
    """
    period = [F.col(since).cast("date").alias(_SINCE), *([F.col(until).cast("date").alias(_UNTIL)] if until else [])]
    named = versions.select(F.col(key).alias(_KEY), *period, *columns).dropna(subset=[_KEY, _SINCE])
    days = one_per_key(named, [_KEY, _SINCE])
    following = F.date_sub(F.lead(_SINCE).over(Window.partitionBy(_KEY).orderBy(_SINCE)), 1)
    end = F.least(following, F.col(_UNTIL)) if until else following
    return days.select(_KEY, _SINCE, end.alias(_UNTIL), *columns)


def asof_join(facts: DataFrame, versions: DataFrame, key: str, day: str, columns: Sequence[str],
              since: str = "effective_date", until: str | None = None, how: str = "left", days: int = 366,
              version_key: str | None = None) -> DataFrame:
    """``facts`` with ``columns`` of the version valid on ``day``, both ends of a period included.

    ``how="left"`` keeps facts without such a version, with NULLs: those
    before the first version, in a gap, without a key or without a day.
    ``"inner"`` drops them. ``columns`` must not be among the facts' own. No
    fact is multiplied, whatever the versions hold. ``days`` is the length of a
    span: shorter ones deal a hot key wider and repeat long versions more often.
    """
    clash = set(columns) & set(facts.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the facts' own: rename them in the versions")
    periods = version_periods(versions, version_key or key, columns, since, until)
    reach = facts.agg(F.min(F.col(day).cast("date")).alias("first"), F.max(F.col(day).cast("date")).alias("last"))
    first, last = reach.select("first").scalar(), reach.select("last").scalar()
    end = F.least(F.coalesce(F.col(_UNTIL), last), last)
    begin = F.greatest(F.col(_SINCE), first)
    spans = F.sequence(_span_of(begin, days), _span_of(end, days))
    placed = periods.where(begin <= end).withColumn(_SPAN, F.explode(spans))
    fact_day = F.col(f"f.{day}").cast("date")
    valid = ((F.col(f"f.{key}") == F.col(f"v.{_KEY}")) & (_span_of(fact_day, days) == F.col(f"v.{_SPAN}"))
             & (fact_day >= F.col(f"v.{_SINCE}")) & (F.col(f"v.{_UNTIL}").isNull() | (fact_day <= F.col(f"v.{_UNTIL}"))))
    return (facts.alias("f").join(placed.alias("v"), valid, how)
            .select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"v.{c}") for c in columns]))
