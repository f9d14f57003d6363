"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.jsonpath import once, shared
from tidemart.operators.explode import json_structs


def rollup_map(df: DataFrame, col: str, stock: str = "stockQuantity", on_sale: str = "maxSkuIsOnsale") -> DataFrame:
    """A4: stock sum and on-sale maximum over the values of a JSON map, inside the row.

    One row holds all its SKUs, so no shuffle is needed; an empty or missing map gives NULL.
    """
    entries = F.map_values(F.from_json(F.col(col), "map<string,string>"))
    parsed = F.transform(entries, lambda e: F.from_json(e, "stockQuantity string, isOnsale string"))
    df = df.withColumn("_skus", once(F.filter(parsed, lambda e: F.lit(True))))

    def number(value: Column) -> Column:
        return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))

    zero = F.lit(0).cast("bigint")
    total = F.aggregate("_skus", zero, lambda acc, e: acc + number(e.stockQuantity))
    highest = F.array_max(F.transform("_skus", lambda e: number(e.isOnsale)))
    filled = F.size("_skus") > 0
    return df.withColumns({stock: F.when(filled, total), on_sale: F.when(filled, highest)}).drop("_skus")


def ordered_json_list(items: Column) -> Column:
    """A5: distinct URLs ordered by their smallest priority, then URL, as a JSON list.

    ``items`` is an array of ``struct<url:string,priority:int>``. URLs without any priority come
    first. NULL when there is no URL.
    """
    def listed(named: Column) -> Column:
        ranked = F.array_sort(F.transform(
            F.filter(named, lambda e: e.priority.isNotNull()), lambda e: F.struct(e.priority, e.url)))
        bare = F.transform(F.filter(named, lambda e: e.priority.isNull()), lambda e: e.url)
        return shared(F.array_distinct(F.transform(ranked, lambda e: e.url)),
                      lambda ordered: F.concat(F.array_sort(F.array_except(bare, ordered)), ordered))

    named = F.filter(items, lambda e: F.coalesce(e.url != "", F.lit(False)))
    return shared(shared(named, listed), lambda urls: F.when(F.size(urls) > 0, F.to_json(urls)))


def gallery_urls(gallery: Column) -> Column:
    """T7 + A5: the image list of a gallery that is a list or one bare object."""
    entries = json_structs(gallery, "url string, priority string")
    return ordered_json_list(F.transform(entries, lambda e: F.struct(
        e.url.alias("url"), e.priority.try_cast("int").alias("priority"))))


def revenue(sold: Column, *prices: Column) -> Column:
    """Sold times the first known price, 0 when unknown, in minor units."""
    return F.coalesce(sold, F.lit(0)) * F.coalesce(*prices, F.lit(0))


def to_units(minor: Column, kind: str = "decimal(20,2)") -> Column:
    """A10: minor units as an amount with two decimals; NULL where it has more digits than that type."""
    return F.round(minor.try_cast("decimal(30,0)") / F.lit(100).cast("decimal(3,0)"), 2).try_cast(kind)


def daily_metrics(df: DataFrame, keys, id_col: str, sums: dict[str, Column] | None = None,
                  flags: dict[str, Column] | None = None, count: str = "id_count") -> DataFrame:
    """Distinct ids, distinct ids that satisfy a flag, and sums, in two combining steps.

    The first step is keyed by the id as well, so a group holding a third of all rows is spread
    over its ids instead of being gathered for a distinct count.
    """
    sums, flags = sums or {}, flags or {}
    per_id = df.groupBy(*keys, id_col).agg(
        *[F.max(F.when(c, F.lit(1)).otherwise(F.lit(0))).alias(n) for n, c in flags.items()],
        *[F.sum(c).alias(n) for n, c in sums.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    known = F.col(id_col).isNotNull()
    return per_id.groupBy(*keys).agg(
        F.count(id_col).alias(count),
        *[F.coalesce(F.sum(F.when(known, F.col(n))), F.lit(0)).alias(n) for n in flags],
        *[F.sum(n).alias(n) for n in sums],
    )


def previous_day(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """Figures of a day, dated one day later."""
    return daily.withColumn(date_col, F.date_add(date_col, 1))
