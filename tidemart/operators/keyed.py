"""Latest, first, next and running values per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """The last row per key, ``order_cols`` descending.

    The rank limit is applied on each side of the shuffle, so a key that owns a third of the rows
    still sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_cols])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_seen(df: DataFrame, keys, date_col: str | Column = "date", out: str = "first_date") -> DataFrame:
    """A1/A3: earliest day per key, combined before the shuffle; rows without a key are left out."""
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    return (
        df.select(*keys, col.alias(out)).dropna(subset=[*keys, out])
        .groupBy(*keys).agg(F.min(out).alias(out))
    )


def epoch_day(seconds: Column) -> Column:
    """A3: calendar day of epoch seconds in the session zone."""
    return F.to_date(F.timestamp_seconds(seconds))


def validity_intervals(df: DataFrame, keys, date_col: str = "date", out: str = "next_date") -> DataFrame:
    """Each row with the day its successor takes over; one row per key and day is expected,
    so a group is never longer than the calendar."""
    return df.withColumn(out, F.lead(date_col).over(Window.partitionBy(*keys).orderBy(date_col)))


def running_min(df: DataFrame, keys, date_col: str, cols: dict[str, Column]) -> DataFrame:
    """Minimum so far per key in day order."""
    w = (Window.partitionBy(*keys).orderBy(date_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({name: F.min(col).over(w) for name, col in cols.items()})


def date_spine(*dfs: DataFrame, date_col: str = "date", out: str = "stat_date") -> DataFrame:
    """The distinct days of one or several tables; each table is reduced before the union."""
    parts = [df.select(F.col(date_col).alias(out)).where(F.col(out).isNotNull()).distinct() for df in dfs]
    return parts[0] if len(parts) == 1 else reduce(DataFrame.union, parts).distinct()


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    """A13."""
    return df.select(*cols).distinct() if cols else df.distinct()
