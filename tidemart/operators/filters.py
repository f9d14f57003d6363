"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_required(df: DataFrame, keys) -> DataFrame:
    """every key present; text keys also non-blank."""
    kinds = dict(df.dtypes)
    tests = [
        F.trim(F.col(k)) != "" if kinds[k] == "string" else F.col(k).isNotNull()
        for k in keys
    ]
    return df.where(reduce(lambda a, b: a & b, tests))


def for_day(df: DataFrame, biz_date, offset: int = 0, col: str = "date") -> DataFrame:
    """rows of the business day, or of the day ``offset`` days away.

    The day is a literal, so it prunes day partitions at planning time.
    """
    return df.where(F.col(col) == F.date_add(F.lit(biz_date).cast("date"), offset))
