"""Cleaning rules: each takes a text column and returns a typed column.

All rules are built-in expressions, so they stay inside whole-stage codegen, and none of them
raises: a value that cannot be read is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number pattern, the day pattern and the unit factors of the cleaning rules.
NUMBER_PATTERN = r"-?\d+(?:\.\d+)?"
DAY_PATTERN = r"\d{4}-\d{2}-\d{2}"
UNIT_FACTORS = (("万", 10_000.0), ("K", 1_000.0), ("M", 1_000_000.0))

TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


def is_container(c: Column) -> Column:
    """The text is a JSON object or array."""
    return F.ltrim(c).rlike(r"^[\[{]")


def first_number(c: Column) -> Column:
    """First number in the text, thousands separators removed."""
    return F.nullif(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), NUMBER_PATTERN, 0), F.lit(""))


def unit_factor(c: Column) -> Column:
    upper = F.upper(c)
    factor = None
    for unit, value in UNIT_FACTORS:
        seen = upper.contains(unit)
        factor = F.when(seen, F.lit(value)) if factor is None else factor.when(seen, F.lit(value))
    return factor.otherwise(F.lit(1.0))


def _half_up(x: Column) -> Column:
    # Halves go towards positive infinity; floor of a double already yields a BIGINT.
    return F.floor(x + F.lit(0.5))


def parse_human_number(c: Column) -> Column:
    """C1: '4.8K' -> 4800, '1,324 items' -> 1324, '4.8万' -> 48000."""
    return _half_up(first_number(c).try_cast("double") * unit_factor(c))


def parse_decimal_text(c: Column) -> Column:
    """First number as plain decimal text without trailing zeros."""
    number = F.regexp_replace(first_number(c), r"^(-?)0+(?=\d)", "$1")
    number = F.when(number.contains("."), F.regexp_replace(number, r"\.?0+$", "")).otherwise(number)
    return F.when(number == "-0", F.lit("0")).otherwise(number)


def number_with_unit_fallback(c: Column, unit_list: Column) -> Column:
    """The value itself, else the first entry of a JSON list such as ["4.8K","Sold"]."""
    return F.coalesce(parse_human_number(c), parse_human_number(F.get_json_object(unit_list, "$[0]")))


def to_long(c: Column) -> Column:
    """C4: whole numbers exactly, everything else through the human-number rule."""
    number = first_number(c)
    plain = (unit_factor(c) == 1.0) & ~number.contains(".")
    value = F.when(plain, number.try_cast("bigint")).otherwise(parse_human_number(c))
    # Plain digits, by far the most common form, never reach the patterns.
    return F.coalesce(c.try_cast("bigint"), F.when(~is_container(c), value))


def to_double(c: Column) -> Column:
    """C5."""
    return F.when(~is_container(c), first_number(c).try_cast("double"))


def to_boolean(c: Column, numeric: bool = True) -> Column:
    """The listed words; with ``numeric`` any other number is true unless its whole part is 0."""
    word = F.lower(F.trim(c))
    rule = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    if numeric:
        whole = F.when(word.rlike(r"^-?\d+(\.\d+)?$"), word.try_cast("double"))
        rule = rule.when(whole.isNotNull(), F.abs(whole) >= 1)
    return rule


def to_date(c: Column) -> Column:
    """First yyyy-MM-dd in the text, NULL when it is no calendar day."""
    return F.nullif(F.regexp_extract(c, DAY_PATTERN, 0), F.lit("")).try_cast("date")


def to_scaled_decimal(c: Column, scale: int, precision: int = 20) -> Column:
    """Half-up to ``scale``; unreadable text or overflow is NULL."""
    return F.round(F.trim(c).try_cast("decimal(38,18)"), scale).try_cast(f"decimal({precision},{scale})")


def to_exact_long(c: Column) -> Column:
    """C9: '12.0' -> 12, '12.5' -> NULL."""
    exact = F.trim(c).try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def to_exact_int(c: Column) -> Column:
    """C9 with the 32-bit range check."""
    return to_exact_long(c).try_cast("int")


def json_long(v: Column) -> Column:
    """C9 on a typed JSON value: a number loses its fraction, text must be whole ('12.0', not '12.5')."""
    kind = F.schema_of_variant(v)
    number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    # Beyond a long, a number is NULL as text is.
    cut = F.try_variant_get(v, "$", "decimal(38,10)")
    cut = F.when(cut < 0, F.ceil(cut)).otherwise(F.floor(cut)).try_cast("bigint")
    text = to_exact_long(F.try_variant_get(v, "$", "string"))
    return F.when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint")).when(number, cut).otherwise(text)


def json_int(v: Column) -> Column:
    """The same with the 32-bit range check."""
    return json_long(v).try_cast("int")


def normalise_datetime(c: Column) -> Column:
    """Keep the wall clock, drop the offset: 'yyyy-MM-dd HH:mm:ss' text or NULL."""
    raw = F.trim(c)
    no_seconds = raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(Z|[+-].*)?$")
    return (
        F.when(no_seconds, F.concat(F.translate(F.substring(raw, 1, 16), "T", " "), F.lit(":00")))
        .when(F.length(raw) >= 19, F.translate(F.substring(raw, 1, 19), "T", " "))
    )


def blank_to_null(c: Column) -> Column:
    """C11: blank text is NULL, other text is kept untrimmed."""
    return F.when(F.trim(c) != "", c)


_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_valid_json(c: Column) -> Column:
    """The text is one JSON value. Objects with a repeated key, which Variant refuses, are read as text twice: as the only
    entry of a list and as one of two fields, so that nothing can follow them."""
    listed = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", _STRICT)
    field = F.from_json(F.concat(F.lit('{"v":'), c, F.lit(',"end":1}')), "v string, end int", _STRICT)
    return F.when(F.try_parse_json(c).isNotNull(), F.lit(True)).otherwise(
        is_container(c) & F.coalesce((F.size(listed) == 1) & (field.end == 1), F.lit(False)))


def quote_json(c: Column) -> Column:
    """The text as one JSON string literal."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def to_json_text(c: Column) -> Column:
    """JSON text stays; any other text becomes a JSON string."""
    return F.when(is_valid_json(c), c).otherwise(F.when(c.isNotNull(), quote_json(c)))


CONVERTERS = {
    "STRING": blank_to_null,
    "BIGINT": to_long,
    "DOUBLE": to_double,
    "BOOLEAN": to_boolean,
    "DATE": to_date,
    "JSON": to_json_text,
}


def clean_types(df, spec: dict[str, str]):
    """Apply the converter named per column: ``{"price": "BIGINT", ...}``."""
    return df.withColumns({name: CONVERTERS[kind](F.col(name)) for name, kind in spec.items()})


def clean_numbers(df, columns):
    """Apply C1 to every listed column."""
    return df.withColumns({name: parse_human_number(F.col(name)) for name in columns})
