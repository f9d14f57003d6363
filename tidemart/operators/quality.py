"""Load rules and row serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import clean
from tidemart.functions.jsonpath import once
from tidemart.operators.project import SPARK_TYPES
from tidemart.schemas import TABLES, TEXT_BYTES, Table


def _loaded(df: DataFrame, name: str, kind: str) -> tuple[Column, Column]:
    """Typed value, and whether the given value cannot be loaded."""
    if name not in df.columns:
        return F.lit(None).cast(SPARK_TYPES.get(kind, kind)), F.lit(False)
    raw = F.col(name)
    is_text = dict(df.dtypes)[name] == "string"
    if kind == "JSON":
        # Text that is no JSON is kept as a JSON string rather than costing the row.
        return clean.to_json_text(raw), F.lit(False)
    if kind == "STRING":
        return raw.cast("string"), F.lit(False)
    value = raw.try_cast(SPARK_TYPES.get(kind, kind)) if is_text or kind != "DATE" else raw.cast("date")
    return value, raw.isNotNull() & value.isNull()


def check_schema(df: DataFrame, table: Table) -> DataFrame:
    """Typed columns of the table plus ``reasons``: the columns that keep a row from being loaded.

    Text that has more bytes than its column may hold keeps its row out, too; such a reason names the bound.
    """
    values, reasons, bounds = [], [], TEXT_BYTES.get(table.name, {})
    for name, kind in table.types.items():
        value, bad = _loaded(df, name, kind)
        if name in table.required:
            bad = bad | value.isNull()
        values.append(value.alias(name))
        reasons.append(F.when(bad, F.lit(name)))
        if name in bounds and name in df.columns:
            reasons.append(F.when(F.octet_length(value) > bounds[name], F.lit(f"{name}: over {bounds[name]} bytes")))
    given = F.struct(*[F.col(c) for c in df.columns])
    checked = df.select(*values, once(F.array_compact(F.array(*reasons))).alias("reasons"), given.alias("_row"))
    # Only rejected rows carry what they came as: a batch that is kept would hold every value twice.
    return checked.withColumn("_row", F.when(F.size("reasons") > 0, F.col("_row")))


def enforce_schema(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """K8: (loadable rows, rejected rows with reasons); both read the same checked frame."""
    checked = check_schema(df, table)
    good = checked.where(F.size("reasons") == 0).drop("reasons", "_row")
    rejects = checked.where(F.size("reasons") > 0).select(
        F.lit(table.name).alias("table"), "reasons",
        F.to_json("_row", {"ignoreNullFields": "false"}).alias("row"),
    )
    return good, rejects


def row_to_json(df: DataFrame, exclude=(), json_columns=()) -> DataFrame:
    """Every row as one JSON object, NULLs written out, JSON columns embedded unquoted."""
    names = [c for c in df.columns if c not in exclude]
    parts = []
    for name in names:
        if name in json_columns:
            body = F.coalesce(F.col(name), F.lit("null"))
        else:
            whole = F.to_json(F.struct(F.col(name).alias("v")), {"ignoreNullFields": "false"})
            body = F.substring(whole, F.lit(6), F.length(whole) - 6)
        parts.append(F.concat(F.lit(f'"{name}":'), body))
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("json"))


# Store columns that are read as human numbers, and as yes/no words, when loaded raw.
MALL_NUMBERS = ("siteId", "appCode", "goodsNum", "goodsSalesNum", "followerNum", "reviewNum",
                "marketPriceType", "serverTime")
MALL_FLAGS = ("mallReviewLabelShow", "isExpire")


def coerce_mall_row(df: DataFrame) -> DataFrame:
    """Load coercion of raw store rows."""
    rules = {c: clean.parse_human_number(F.col(c).cast("string")) for c in MALL_NUMBERS}
    rules["mallStar"] = clean.parse_decimal_text(F.col("mallStar").cast("string")).try_cast("decimal(38,10)")
    rules.update({c: clean.to_boolean(F.col(c).cast("string"), numeric=False) for c in MALL_FLAGS})
    return df.withColumns(rules).drop("lastUpdateTime")


def write_audit(df: DataFrame, layer: str, table: str, keys, batch_id) -> DataFrame:
    """K9: rows written per composite key; missing key parts print as ``null``."""
    parts = [
        F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys
    ]
    return (
        df.select(F.concat_ws(",", *parts).alias("key"))
        .groupBy("key").agg(F.count("*").alias("rows"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table"),
                F.lit(str(batch_id)).alias("batch_id"), "key", "rows")
    )


def audit_keys(table: str) -> tuple[str, ...]:
    return TABLES[table].keys if table in TABLES else ("id",)
