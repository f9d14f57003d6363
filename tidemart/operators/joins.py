"""Joins (J1, J2, J5-J8, A14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.jsonpath import json_elements


def enrich(df: DataFrame, dim: DataFrame, keys, text_keys=()) -> DataFrame:
    """Left join on ``keys``; keys typed differently on the two sides are compared as text.

    ``dim`` has to be unique on the keys. The strategy is left to the optimizer: a small ``dim`` is
    broadcast by its size, a skewed key of ``df`` is split at run time.
    """
    right = dim.withColumnsRenamed({k: f"_{k}" for k in keys})
    tests = [
        F.col(k).cast("string") == F.col(f"_{k}").cast("string") if k in text_keys else F.col(k) == F.col(f"_{k}")
        for k in keys
    ]
    return df.join(right, tests, "left").drop(*[f"_{k}" for k in keys])


def on_days(df: DataFrame, spine: DataFrame, date_col: str = "date", day: str = "stat_date") -> DataFrame:
    """Rows whose day is a spine day; the spine has one row per calendar day."""
    return df.join(F.broadcast(spine), F.col(date_col) == F.col(day))


def with_parameter(df: DataFrame, name: str, value, kind: str = "date") -> DataFrame:
    """A one-row parameter is a literal column."""
    return df.withColumn(name, F.lit(value).cast(kind))


def listed_ids(list_text: Column, field: str) -> Column:
    """Ids named by the objects of a JSON list, only where the id itself is a whole JSON number.

    The whole value is compared, so neither ``"5"`` nor 5.5 names 5; each id counts once.
    """
    entries = json_elements(list_text)
    kinds = F.transform(entries, lambda e: F.struct(
        F.try_variant_get(F.try_parse_json(e), f"$.{field}", "bigint").alias("id"),
        F.schema_of_variant(F.try_variant_get(F.try_parse_json(e), f"$.{field}", "variant")).alias("kind"),
    ))
    numeric = F.filter(kinds, lambda k: k.kind.rlike(r"^(BIGINT|DECIMAL\(\d+,\s*0\))$"))
    return F.array_distinct(F.filter(F.transform(numeric, lambda k: k.id), lambda i: i.isNotNull()))


def explode_listed(df: DataFrame, list_col: str, field: str, out: str) -> DataFrame:
    """One row per listed id, so that containment becomes an equi-join."""
    return df.withColumn("_id", F.explode(listed_ids(F.col(list_col), field))).drop(out).withColumnRenamed("_id", out)


def contains_join(left: DataFrame, right: DataFrame, list_col: str, field: str, left_id: str, keys) -> DataFrame:
    """Rows of ``right`` whose JSON list names the row's id, on equal ``keys`` (inner join)."""
    listed = explode_listed(right, list_col, field, "_listed")
    renamed = listed.withColumnsRenamed({k: f"_{k}" for k in keys})
    tests = [F.col(k) == F.col(f"_{k}") for k in keys]
    return left.join(renamed, [F.col(left_id) == F.col("_listed"), *tests]).drop("_listed", *[f"_{k}" for k in keys])


def count_listing(left: DataFrame, right: DataFrame, list_col: str, field: str, left_id: str, keys,
                  counted: str, out: str) -> DataFrame:
    """Per row of ``left`` how many distinct ``counted`` list it, 0 when none does.

    The lists are counted before the join, so no pair is ever produced.
    """
    counts = (
        explode_listed(right, list_col, field, left_id)
        .select(*keys, left_id, counted).where(F.col(counted).isNotNull()).distinct()
        .groupBy(*keys, left_id).agg(F.count("*").alias(out))
    )
    return enrich(left, counts, [*keys, left_id]).withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def stored_minimum(target: DataFrame, keys, cols) -> DataFrame:
    """Smallest stored values per key of the table about to be written."""
    return target.groupBy(*keys).agg(*[F.min(c).alias(c) for c in cols])
