"""As-of snapshots and cumulative figures over a day spine.

None of these compares every row with every day. A row is valid from its own day until its key's
next day; both are spine days, so the interval is expanded by counting spine positions. Cumulative
figures become daily differences that are summed along the spine.

A spine holds at most one row per calendar day: that bounds every broadcast and every window group
below, whatever the tables hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.keyed import validity_intervals


def number_days(spine: DataFrame, day: str = "stat_date") -> DataFrame:
    """Spine positions 0..n-1 as ``day_no``, with the position after the last day as ``day_count``."""
    whole = Window.orderBy(day)
    return spine.withColumns({
        "day_no": F.row_number().over(whole) - 1,
        "day_count": F.count("*").over(Window.partitionBy()),
    })


def expand_days(df: DataFrame, spine: DataFrame, start: str = "date", end: str = "next_date",
                day: str = "stat_date") -> DataFrame:
    """One row per spine day from ``start`` up to, not including, ``end`` (NULL: to the last).

    ``start`` and ``end`` have to be spine days; rows whose start is none are dropped.
    """
    days = number_days(spine, day)
    first = days.select(F.col(day).alias(start), F.col("day_no").alias("_from"), F.col("day_count").alias("_count"))
    until = days.select(F.col(day).alias(end), F.col("day_no").alias("_to"))
    back = days.select(F.col("day_no").alias("_no"), day)
    out = df.join(F.broadcast(first), start).join(F.broadcast(until), end, "left")
    stop = F.coalesce(F.col("_to"), F.col("_count")).cast("int")
    out = out.withColumn("_no", F.explode(F.sequence(F.col("_from"), stop - 1)))
    return out.join(F.broadcast(back), "_no").drop("_no", "_from", "_to", "_count")


def asof_expand(df: DataFrame, keys, spine: DataFrame, date_col: str = "date", day: str = "stat_date") -> DataFrame:
    """Per key and spine day the latest row dated on or before that day.

    ``df`` has one row per key and day, and its days belong to the spine.
    """
    intervals = validity_intervals(df, keys, date_col, "_next")
    return expand_days(intervals, spine, date_col, "_next", day).drop("_next")


def with_carry(rows: DataFrame, spine: DataFrame, carry: DataFrame | None = None, date_col: str = "date",
               day: str = "stat_date") -> DataFrame:
    """``rows`` of a range of days and those of ``carry``, which have the same columns and hold from its first day on.

    Adds ``valid_from`` and ``own``, false for carried rows; keys are to be ordered by both.
    """
    rows = rows.withColumns({"valid_from": F.col(date_col), "own": F.lit(True)})
    if carry is None:
        return rows
    begin = spine.agg(F.min(day).alias("valid_from"))  # one row
    return rows.unionByName(carry.withColumn("own", F.lit(False)).join(F.broadcast(begin)).select(*rows.columns))


def continued(rows: DataFrame, keys, spine: DataFrame, carry: DataFrame | None = None, running: dict[str, str] | None = None,
              more: dict[str, Column] | None = None, date_col: str = "date", day: str = "stat_date") -> DataFrame:
    """W2/W3/W4 for a range of days: the rows of its days and, before them, what held the day before the range.

    ``carry`` has the columns of ``rows``, one row per key: its latest row with its ``running`` columns (name to ``min`` or
    ``sum``) so far. That row is valid from the first spine day on, unless its key has a row on that day. Adds ``valid_from``
    and ``next_date``, and ``more`` columns over the window of a key's rows; :func:`right_edge` of the result is the next
    range's ``carry``.
    """
    history = Window.partitionBy(*keys).orderBy("valid_from", "own")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = with_carry(rows, spine, carry, date_col, day).withColumns({
        "next_date": F.lead("valid_from").over(history),
        **{c: getattr(F, kind)(c).over(so_far).alias(c) for c, kind in (running or {}).items()},
        **{name: column.over(history) for name, column in (more or {}).items()}})
    return found.where("valid_from is not null and (next_date is null or next_date > valid_from)").drop("own")


def right_edge(valid: DataFrame) -> DataFrame:
    """The latest row per key of a range of days, to be carried into the next one."""
    return valid.where("next_date is null").drop("valid_from", "next_date")


def next_distinct(today: DataFrame, keys, id_col: str, index: DataFrame, totals: DataFrame,
                  out: str = "distinct_count") -> tuple[DataFrame, DataFrame]:
    """A15 from one day to the next: (totals up to today, ids new today).

    ``index`` holds the ids of each group seen before, ``totals`` their number as of the day before. Only today's rows are
    counted; the new ids are to be added to the index. Ids are compared group by group, so no group meets in one task.
    """
    new = today.select(*keys, id_col).dropna().distinct().join(index.select(*keys, id_col), [*keys, id_col], "left_anti")
    added = new.groupBy(*keys).agg(F.count("*").alias(out))
    both = totals.select(*keys, out).unionByName(added)
    return both.groupBy(*keys).agg(F.sum(out).alias(out)), new


def distinct_so_far(df: DataFrame, keys, id_col: str, spine: DataFrame, out: str, seen: DataFrame | None = None,
                    carry: DataFrame | None = None, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """A15 for a range of days: (running totals with the days they hold for, ids new in the range with their first day).

    ``seen`` holds the ids of each key before the range, ``carry`` the totals at its edge.
    """
    first = df.where(F.col(id_col).isNotNull()).groupBy(*keys, id_col).agg(F.min(date_col).alias(date_col))
    if seen is not None:
        first = first.join(seen.select(*keys, id_col), [*keys, id_col], "left_anti")
    daily = first.groupBy(*keys, date_col).agg(F.count("*").alias(out))
    return continued(daily, keys, spine, carry, {out: "sum"}, date_col=date_col), first


def asof_latest_day(df: DataFrame, keys, spine: DataFrame, date_col: str = "date",
                    out: str = "latest_date", day: str = "stat_date") -> DataFrame:
    """Per key and spine day the latest day with a row; reduced to key-days first."""
    reduced = df.select(*keys, date_col).dropna().distinct()
    return asof_expand(reduced, keys, spine, date_col, day).withColumnRenamed(date_col, out)


def first_seen_asof(first: DataFrame, spine: DataFrame, first_col: str, day: str = "stat_date") -> DataFrame:
    """A2: the first day per key, on every spine day it is already known.

    The minimum over days up to d is the overall minimum as soon as that is not after d, so the
    one row per key is valid from its own day on.
    """
    return expand_days(first.withColumn("_next", F.lit(None).cast("date")), spine, first_col, "_next", day).drop("_next")


def cumulative_sum(daily: DataFrame, keys, spine: DataFrame, sums: list[str], date_col: str = "date",
                   day: str = "stat_date") -> DataFrame:
    """Running totals per key on every spine day from the key's first day on.

    ``daily`` has one row per key and day, so a window group is no longer than the calendar.
    """
    w = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = daily.withColumns({c: F.sum(c).over(w) for c in sums})
    return asof_expand(totals, keys, spine, date_col, day)


def cumulative_distinct(df: DataFrame, keys, id_col: str, spine: DataFrame, date_col: str = "date",
                        out: str = "distinct_count", day: str = "stat_date") -> DataFrame:
    """Per key and spine day the number of ids seen on or before that day.

    Each id counts once, on its first day. Both aggregations combine before their shuffle and the
    first one is spread over ids, so no key is gathered in one task.
    """
    first = df.where(F.col(id_col).isNotNull()).groupBy(*keys, id_col).agg(F.min(date_col).alias(date_col))
    daily = first.groupBy(*keys, date_col).agg(F.count("*").alias(out))
    return cumulative_sum(daily, keys, spine, [out], date_col, day).drop(date_col)


def cumulative_latest_sum(df: DataFrame, group_keys, id_keys, spine: DataFrame, values: dict[str, Column],
                          date_col: str = "date", day: str = "stat_date") -> DataFrame:
    """Per group and spine day the sum over ids of each id's latest value up to that day.

    A new value of an id counts as the difference to its previous one; the differences of a day are
    added up per group and summed along the spine. ``df`` has one row per group, id and day.
    """
    w = Window.partitionBy(*group_keys, *id_keys).orderBy(date_col)
    steps = {n: v - F.coalesce(F.lag(v).over(w), F.lit(0)) for n, v in values.items()}
    daily = (
        df.withColumns(steps).groupBy(*group_keys, date_col)
        .agg(*[F.sum(n).alias(n) for n in values])
    )
    return cumulative_sum(daily, group_keys, spine, list(values), date_col, day).drop(date_col)
