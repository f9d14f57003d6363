"""Row-expanding operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.jsonpath import json_elements, json_get, once


def explode_list_outer(df: DataFrame, list_col: str, item: str = "item") -> DataFrame:
    """One row per list entry; a missing or empty list keeps one row with a NULL item."""
    return df.withColumn(item, F.explode_outer(json_elements(F.col(list_col))))


def explode_crumbs(df: DataFrame, list_col: str, item: str = "item", pos: str = "pos") -> DataFrame:
    """One row per breadcrumb of a JSON list, or of an object keyed by position."""
    text = F.col(list_col)
    listed = F.transform(json_elements(text), lambda e, i: F.struct(i.alias("pos"), e.alias("item")))
    by_key = F.when(F.ltrim(text).startswith("{"), F.map_entries(F.from_json(text, "map<string,string>")))
    numbered = F.array_sort(F.transform(
        F.filter(by_key, lambda e: e.key.rlike(r"^\d+$")),
        lambda e: F.struct(e.key.try_cast("int").alias("pos"), e.value.alias("item")),
    ))
    rows = df.withColumn("_crumb", F.explode(F.coalesce(listed, numbered)))
    return rows.withColumns({pos: F.col("_crumb.pos"), item: F.col("_crumb.item")}).drop("_crumb")


def list_items(text: Column) -> Column:
    """Objects of a JSON list, nested lists flattened; a single object is one item."""
    nested = F.transform(
        json_elements(text),
        lambda e: F.coalesce(json_elements(e), F.array(e)),
    )
    items = F.coalesce(F.flatten(nested), F.when(F.ltrim(text).startswith("{"), F.array(text)))
    return F.filter(items, lambda e: e.startswith("{"))


def map_items(text: Column) -> Column:
    """Objects below every value of a JSON map (its ``value`` key when it has one)."""
    entries = F.when(F.ltrim(text).startswith("{"), F.from_json(text, "map<string,string>"))
    own = F.map_contains_key(entries, "value")
    whole = F.when(own, F.array(F.element_at(entries, "value"))).otherwise(F.map_values(entries))
    empty = F.array().cast("array<string>")
    return F.flatten(F.transform(whole, lambda v: F.coalesce(list_items(v), empty)))


def explode_aligned_sources(df: DataFrame, sources: list[Column]) -> DataFrame:
    """Rows of several parallel lists; ``source`` and ``pos`` keep source order, then position."""
    empty = F.array().cast("array<struct<source:int,pos:int,item:string>>")

    def tagged(source: int, items: Column) -> Column:
        return F.coalesce(F.transform(items, lambda e, i: F.struct(
            F.lit(source).alias("source"), i.cast("int").alias("pos"), e.alias("item"))), empty)

    rows = df.withColumn("_row", F.explode(F.concat(*[tagged(n, items) for n, items in enumerate(sources)])))
    return rows.withColumns({n: F.col(f"_row.{n}") for n in ("source", "pos", "item")}).drop("_row")


def explode_history(df: DataFrame, list_col: str, schema: str, entry: str = "entry") -> DataFrame:
    """E5: one row per object of the list, parsed; anything but a list gives no rows."""
    objects = F.filter(json_elements(F.col(list_col)), lambda e: e.startswith("{"))
    return df.withColumn("_entry", F.explode(objects)).withColumn(
        entry, once(F.from_json(F.col("_entry"), schema))).drop("_entry")


def json_structs(text: Column, schema: str) -> Column:
    """JSON list (or one bare object) as an array of structs; unreadable entries become NULL fields."""
    bare = F.when(F.ltrim(text).startswith("{"), F.array(text))
    return F.transform(F.coalesce(json_elements(text), bare), lambda e: F.from_json(e, schema))


def explode_json_array(df: DataFrame, col: str, schema: str, item: str = "item") -> DataFrame:
    """One row per entry of a JSON list or for one bare object; no rows for anything else."""
    return df.withColumn(item, F.explode(json_structs(F.col(col), schema)))


def explode_json_map(df: DataFrame, col: str, schema: str, key: str = "key", item: str = "item") -> DataFrame:
    """One row per key of a JSON object, the value parsed."""
    rows = df.select("*", F.explode(F.from_json(F.col(col), "map<string,string>")).alias(key, "_value"))
    return rows.withColumn(item, F.from_json(F.col("_value"), schema)).drop("_value")


def path_ids(path: Column, fallback: Column, levels: int = 3) -> Column:
    """Ids of the first ``levels`` breadcrumbs; the row's own id only when no level has one.

    A level whose id is no whole number is dropped, and still rules the fallback out.
    """
    found = F.filter(
        F.array(*[json_get(path, [str(n), "optId"]) for n in range(levels)]), lambda x: x.isNotNull())
    own = F.filter(F.array(fallback.try_cast("int")), lambda x: x.isNotNull())
    ids = F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda x: x.isNotNull())
    return F.array_distinct(F.when(F.size(found) > 0, ids).otherwise(own))


def unpivot_path(df: DataFrame, path_col: str, fallback_col: str, out: str = "optId") -> DataFrame:
    """One row per distinct category of a row's path, in one pass over the table."""
    ids = path_ids(F.col(path_col), F.col(fallback_col))
    return df.withColumn("_id", F.explode(ids)).drop(out).withColumnRenamed("_id", out)
