"""Derived-column rules of the daily tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Languages whose comments need no translation.
CHINESE_LANGUAGES = ("zh-Hans", "zh-CN", "zh")


def first_non_empty(*cols: Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def image_list(gallery: Column | None, main_image: Column) -> Column:
    """Gallery list, else a list of the main image, else an empty list (JSON text)."""
    single = F.when(main_image.isNotNull(), F.to_json(F.array(main_image))).otherwise(F.lit("[]"))
    return single if gallery is None else F.coalesce(gallery, single)


def stock_status(on_sale: Column, quantity: Column) -> Column:
    """D3: 0 = on sale with stock, 2 = otherwise."""
    available = (F.coalesce(on_sale, F.lit(0)) == 1) & (F.coalesce(quantity, F.lit(0)) > 0)
    return F.when(available, F.lit(0)).otherwise(F.lit(2)).cast("bigint")


def earliest(default: Column, *dates: Column) -> Column:
    """Smallest non-NULL date, the default when there is none."""
    return F.coalesce(F.least(*dates) if len(dates) > 1 else dates[0], default)


def to_minor_units(price: Column, cents: Column) -> Column:
    """Price times minor units per unit (100 when unknown), half-up."""
    return F.round(price * F.coalesce(cents, F.lit(100)), 0).cast("bigint")


def guarded_average(amount: Column, volume: Column) -> Column:
    """0 when there is no volume."""
    quotient = F.round(amount.cast("decimal(28,6)") / volume.cast("decimal(20,0)"), 2)
    return F.when(F.coalesce(volume, F.lit(0)) == 0, F.lit(0)).otherwise(quotient).cast("decimal(20,2)")


def change_rate(current: Column, previous: Column) -> Column:
    """Relative change, NULL when there is nothing to compare with."""
    before = F.coalesce(previous, F.lit(0))
    rate = F.round((current - previous).cast("decimal(28,6)") / previous.cast("decimal(20,0)"), 4)
    return F.when(before != 0, rate).cast("decimal(18,4)")


def flag_code(flag: Column) -> Column:
    """True -> 1, anything else -> 0."""
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))


def chinese_comment(lang: Column, comment: Column, translations: Column) -> Column:
    """Chinese comments as they are, others translated where a translation exists."""
    translated = F.coalesce(F.get_json_object(translations, "$.translateComment"), comment)
    return F.when(lang.isin(*CHINESE_LANGUAGES), comment).otherwise(translated)


def media_list(items: Column, pictures: Column) -> Column:
    """D10."""
    return F.coalesce(items, pictures)


def derive(df, rules: dict[str, Column]):
    """Add named rule columns in one projection."""
    return df.withColumns(rules)
