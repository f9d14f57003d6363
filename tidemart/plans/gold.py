"""Daily tables: increments for one business day and full-history rebuilds.

``tables`` maps table names to frames. Clean tables hold one row per key and day. A builder called
with a day builds that day; without one it rebuilds the history. The two modes differ where the
daily tables define them differently, and are not meant to be merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce, wraps

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import derive as d
from tidemart.functions.jsonpath import once
from tidemart.operators.aggregates import daily_metrics, gallery_urls, revenue, rollup_map, to_units
from tidemart.operators.asof import (
    continued,
    distinct_so_far,
    expand_days,
    right_edge,
    with_carry,
)
from tidemart.operators.explode import unpivot_path
from tidemart.operators.filters import for_day, keep_required
from tidemart.operators.joins import count_listing, enrich, explode_listed
from tidemart.operators.keyed import date_spine
from tidemart.schemas import STATES, TABLES
from tidemart.sources.tables import Warehouse

Tables = Mapping[str, DataFrame]
_GOODS = ["goodsId", "siteId"]
_MALL = ["mallId", "siteId"]


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """The table's columns, and ``_lost``: figures that a column's type can't hold. They are NULL and don't stop the build.

    Where every figure has its column's type there are none, and the metadata of ``_lost`` says so.
    """
    schema = TABLES[table].schema
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
               F.concat(F.lit(f"{f.name}: "), F.col(f.name).cast("string"), F.lit(f" is no {f.dataType.simpleString()}")))
        for f in schema if isinstance(df.schema[f.name].dataType, T.NumericType) and df.schema[f.name].dataType != f.dataType]
    found = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array().cast("array<string>")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
                     found.alias("_lost", metadata={"none": not lost}))


def _daily(build):
    """A builder whose rows have just the table's columns unless ``_lost`` is asked for."""
    @wraps(build)
    def run(tables: Tables, biz_date=None, lost: bool = False) -> DataFrame:
        rows = build(tables, biz_date)
        return rows if lost else rows.drop("_lost")

    return run


def _load(lake: Warehouse, rows: DataFrame, table: str, batch: str, seq: int, writer: str) -> None:
    """Write the rows all of whose figures fit; the others go to the rejects with the figures that don't."""
    bad = F.size("_lost") > 0
    names = [name for name in rows.columns if name != "_lost"]
    if not rows.schema["_lost"].metadata["none"]:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # built once for both
    try:
        lake.upsert_latest(rows.where(~bad).drop("_lost"), table, batch, seq, writer=writer)
        rejects = rows.where(bad).select(F.col("_lost").alias("reasons"), F.to_json(F.struct(*names)).alias("row"))
        lake.keep_rejects(rejects, f"{table}-{writer}", batch)
    finally:
        rows.unpersist()


def _kept(tables: Tables, name: str) -> DataFrame:
    """Smallest values per key: the state kept from day to day, or found in the whole table where there is none."""
    return tables[name] if name in tables else STATES[name].minima(tables[STATES[name].source])


def _wide(name: str) -> Column:
    """A whole number whose products and sums don't overflow."""
    return F.col(name).cast("decimal(19,0)")


# -- products ----------------------------------------------------------------------------------

def _goods_figures(goods: DataFrame, image_order: tuple[str, str]) -> DataFrame:
    """Columns that follow from one product row: images, stock, and renamed fields.

    Gallery and SKU map live inside the row, so neither needs a self-join.
    """
    image_url = F.get_json_object("image", "$.url")
    main = d.first_non_empty(*[F.col(c) for c in image_order], image_url)
    single = d.first_non_empty(F.col("imageUrl"), F.col("thumbUrl"), image_url)
    rolled = rollup_map(goods, "skuList")
    return rolled.withColumns({
        "goodsTitleEnglish": F.col("title"),
        "goodsTitleChinese": F.col("title"),
        "mainImageUrl": main,
        "carouselImageUrls": once(d.image_list(gallery_urls(F.col("gallery")), single)),
        "isAdultGoods": F.col("adultGoods"),
        "videoInfo": F.col("video"),
        "propertyList": F.col("goodsProperty"),
        "currency": F.col("selectedCurrency"),
        "score": F.col("goodsScore"),
        "stockStatus": d.stock_status(F.coalesce("isOnsale", "maxSkuIsOnsale"), F.col("stockQuantity")),
        "stockQuantity": F.coalesce("stockQuantity", F.lit(0)),
        "skuInfoList": F.col("skuList"),
    })


@_daily
def build_goods_daily(tables: Tables, biz_date=None) -> DataFrame:
    """G1/G2."""
    return _goods_increment(tables, biz_date) if biz_date is not None else _goods_rows(tables, goods_history(tables))


def _goods_increment(tables: Tables, biz_date) -> DataFrame:
    goods = tables["dwd_goods_base"]
    today = for_day(goods, biz_date).where("goodsId is not null and siteId is not null")
    rows = _goods_figures(today, ("thumbUrl", "imageUrl"))
    rows = enrich(rows, _kept(tables, "first_goods"), _GOODS)
    rows = enrich(rows, _kept(tables, "first_review"), _GOODS, text_keys=("goodsId",))
    rows = enrich(rows, _kept(tables, "stored_goods"), _GOODS)
    biz = F.lit(biz_date).cast("date")
    return _shaped(rows.withColumns({
        "addToRegionTime": d.earliest(
            biz, F.col("storedRegion"), F.col("firstCollectDate"), F.col("firstReviewDate")),
        # The stored first day stays, even when an earlier one is found later.
        "firstAddTime": F.coalesce("storedFirst", "firstCollectDate", "date"),
        "lastUpdateTime": F.col("date"),
    }), "dws_goods_daily")


#: Columns of a product row that its daily rows come from.
_GOODS_READ = (
    "goodsId", "siteId", "date", "mallId", "optId", "catId", "title", "imageUrl", "thumbUrl", "image", "gallery", "skuList", "video",
    "adultGoods", "goodsProperty", "salesNum", "selectedCurrency", "minOnSalePrice", "maxOnSalePrice", "goodsScore", "reviewNum",
    "isOnsale")


def _in_range(df: DataFrame, days) -> DataFrame:
    """Rows of the days from the first to the last given one, or all that have a day."""
    return df.where("date is not null") if days is None else df.where(F.col("date").between(*[F.lit(x).cast("date") for x in days]))


def goods_history(tables: Tables, days=None, carry: DataFrame | None = None) -> DataFrame:
    """Product rows with the days they hold for, in the history or in a range of days that goes on from ``carry``.

    The rows are as they were read, so that an edge costs no images and stock of rows that it doesn't hold.
    """
    goods = _in_range(tables["dwd_goods_base"], days)
    rows = goods.where("goodsId is not null and siteId is not null").withColumn("firstCollectDate", F.col("date"))
    rows = rows.select(*[c for c in rows.columns if c in _GOODS_READ], "firstCollectDate")
    if carry is not None and not set(rows.columns) <= set(carry.columns):  # an edge of daily columns, as they were once kept
        carry = right_edge(goods_history(tables, _before(days[0])))
    return continued(rows, _GOODS, date_spine(goods), carry, {"firstCollectDate": "min"})


def _goods_rows(tables: Tables, valid: DataFrame, days=None) -> DataFrame:
    """The daily rows of :func:`goods_history`."""
    # Images and stock are derived once per source row, before it is repeated per day.
    rows = _goods_figures(valid, ("imageUrl", "thumbUrl")).withColumn("lastUpdateTime", F.col("date")).drop("date")
    types = TABLES["dws_goods_daily"].types
    rows = rows.select(*[c for c in rows.columns if c in types], "firstCollectDate", "valid_from", "next_date")
    rows = enrich(rows, _kept(tables, "first_review"), _GOODS, text_keys=("goodsId",))
    rows = expand_days(rows, date_spine(_in_range(tables["dwd_goods_base"], days)), "valid_from")
    known_review = F.when(F.col("firstReviewDate") <= F.col("stat_date"), F.col("firstReviewDate"))
    return _shaped(rows.withColumns({
        "date": F.col("stat_date"),
        "addToRegionTime": d.earliest(F.col("stat_date"), F.col("firstCollectDate"), known_review),
        "firstAddTime": F.coalesce("firstCollectDate", "stat_date"),
    }), "dws_goods_daily")


def _external_figures(rows: DataFrame) -> DataFrame:
    main = d.first_non_empty(F.col("thumbnail"), F.col("thumbnailCn"))
    return rows.withColumns({
        "goodsTitleEnglish": d.first_non_empty(F.col("goodsNameEn"), F.col("goodsName"), F.col("goodsNameCn")),
        "goodsTitleChinese": d.first_non_empty(F.col("goodsNameCn"), F.col("goodsName"), F.col("goodsNameEn")),
        "mainImageUrl": main,
        "thumbUrl": F.col("thumbnail"),
        "carouselImageUrls": d.image_list(None, main),
        "isAdultGoods": F.lit(None),
        "videoInfo": F.lit(None),
        "propertyList": F.lit(None),
        "salesNum": F.col("sold"),
        "minOnSalePrice": d.to_minor_units(F.col("minPrice"), F.col("cents")),
        "maxOnSalePrice": d.to_minor_units(F.col("maxPrice"), F.col("cents")),
        "score": F.col("goodsScore"),
        "stockStatus": d.stock_status(F.col("status"), F.col("quantity")),
        "stockQuantity": F.col("quantity"),
        "skuInfoList": F.col("skuInfo"),
    })


def external_history(tables: Tables, days=None, carry: DataFrame | None = None) -> DataFrame:
    """Like :func:`goods_history`, from the external feed."""
    goods = _in_range(tables["dwd_external_goods_daily"], days)
    on_sale = F.to_date("onSaleTime")
    rows = _external_figures(goods.where("goodsId is not null and siteId is not null")).withColumns({
        "lastUpdateTime": F.col("date"), "firstCollectDate": F.col("date"),
        "onSaleDate": on_sale, "firstOnSaleDate": on_sale})
    types = TABLES["dws_goods_daily"].types
    rows = rows.select(*[c for c in rows.columns if c in types], "firstCollectDate", "onSaleDate", "firstOnSaleDate")
    return continued(rows, _GOODS, date_spine(goods), carry,
                     {"firstCollectDate": "min", "firstOnSaleDate": "min"})


def _external_rows(tables: Tables, valid: DataFrame, days=None) -> DataFrame:
    spine = date_spine(_in_range(tables["dwd_external_goods_daily"], days))
    return _shaped(expand_days(valid.drop("date"), spine, "valid_from").withColumns({
        "date": F.col("stat_date"),
        "addToRegionTime": F.coalesce("onSaleDate", "firstOnSaleDate", "firstCollectDate", "stat_date"),
        "firstAddTime": F.coalesce("firstCollectDate", "stat_date"),
    }), "dws_goods_daily")


@_daily
def build_external_goods_daily(tables: Tables, biz_date=None) -> DataFrame:
    """The same product table from the external feed; whichever is written last wins."""
    if biz_date is None:
        return _external_rows(tables, external_history(tables))
    goods, on_sale = tables["dwd_external_goods_daily"], F.to_date("onSaleTime")
    today = for_day(goods, biz_date).where("goodsId is not null and siteId is not null")
    rows = enrich(_external_figures(today), _kept(tables, "first_external"), _GOODS)
    rows = enrich(rows, _kept(tables, "stored_goods"), _GOODS)
    found = F.coalesce(on_sale, "firstOnSaleDate", "firstCollectDate")
    return _shaped(rows.withColumns({
        "addToRegionTime": d.earliest(F.col("date"), F.col("storedRegion"), found),
        "firstAddTime": d.earliest(F.col("date"), F.col("storedFirst"), F.col("firstCollectDate")),
        "lastUpdateTime": F.col("date"),
    }), "dws_goods_daily")


# -- stores ------------------------------------------------------------------------------------

@_daily
def build_malls_daily(tables: Tables, biz_date=None) -> DataFrame:
    """G5/G6. A rebuild dates every store row on its own day, as its first-seen date.

    One day holds one row per store and per product, so the day's row is the latest one.
    """
    malls, goods = tables["dwd_malls_base"], tables["dwd_goods_base"]
    if biz_date is None:
        today = malls.where("date is not null")
        sales_rows = goods.where("date is not null")
    else:
        today, sales_rows = for_day(malls, biz_date), for_day(goods, biz_date)
    today = keep_required(today, _MALL)
    sales = (
        sales_rows.where("mallId is not null and siteId is not null and goodsId is not null")
        .groupBy("mallId", "siteId", "date")
        .agg(F.sum(revenue(_wide("salesNum"), _wide("minOnSalePrice"), _wide("maxOnSalePrice")))
             .alias("goodsSalesPrice"))
    )
    rows = enrich(today, sales, [*_MALL, "date"], text_keys=("mallId",))
    if biz_date is None:
        added = F.col("date")
    else:
        rows = enrich(rows, _kept(tables, "first_malls"), _MALL)
        rows = enrich(rows, _kept(tables, "stored_malls"), _MALL)
        added = d.earliest(F.lit(biz_date).cast("date"), F.col("storedRegion"), F.col("firstCollectDate"))
    return _shaped(rows.withColumns({
        "mallLogoUrl": F.col("mallLogo"),
        "mallType": d.flag_code(F.col("semiManaged")),
        "categoryList": F.col("optList"),
        "goodsSalesPrice": F.coalesce("goodsSalesPrice", F.lit(0)),
        "scorePercentInfo": F.col("scoreNumInfoList"),
        "addToRegionTime": added,
    }), "dws_malls_daily")


# -- categories --------------------------------------------------------------------------------

_OPT = ["optId", "siteId"]
_COUNTS = ("goodsNum", "totalSalesVolume", "dailySalesVolume", "totalGoodsNum", "dailyGoodsNum",
           "halfPipelineGoodsNum", "totalStoreNum", "dailyStoreNum")


def _path_rows(goods: DataFrame) -> DataFrame:
    """One row per product row and category of its path; only columns the metrics need."""
    rows = goods.select("goodsId", "siteId", "date", "optId", "crumbOptList", "salesNum", "minOnSalePrice",
                        "semiManaged").where("siteId is not null")
    rows = unpivot_path(rows, "crumbOptList", "optId").drop("crumbOptList")
    earned = revenue(_wide("salesNum"), _wide("minOnSalePrice"))
    return rows.withColumns({"sold": F.coalesce("salesNum", F.lit(0)), "earned": earned})


def _category_figures(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in (*_COUNTS, "earned", "previousSold")})
    rows = rows.withColumn("totalSalesAmount", to_units(F.col("earned"), "decimal(33,2)"))
    return _shaped(rows.withColumns({
        "optNameEnglish": F.col("optName"),
        "optNameChinese": F.col("optName"),
        "isFeatured": F.coalesce("isFeatured", F.lit(False)),
        "rank": F.col("priority"),
        "avgCustomerPrice": d.guarded_average(F.col("totalSalesAmount"), F.col("totalSalesVolume")),
        "dailySalesVolumeChange": d.change_rate(F.col("dailySalesVolume"), F.col("previousSold")),
    }), "dws_category_daily")


@_daily
def build_category_daily(tables: Tables, biz_date=None) -> DataFrame:
    """G7/G8. The increment looks at its day only, the rebuild accumulates up to each day."""
    return _category_increment(tables, biz_date) if biz_date is not None else _category_rebuild(tables)


def _category_increment(tables: Tables, biz_date) -> DataFrame:
    base = keep_required(for_day(tables["dwd_category_base"], biz_date), _OPT)
    goods, malls = tables["dwd_goods_base"], for_day(tables["dwd_malls_base"], biz_date)
    biz = F.lit(biz_date).cast("date")

    # The day and the day before are read and aggregated together.
    both = _path_rows(goods.where(F.col("date").between(F.date_sub(biz, 1), biz)))
    is_today = F.col("date") == biz
    metrics = daily_metrics(
        both, _OPT, "goodsId", count="_ids",
        flags={"goodsNum": is_today, "halfPipelineGoodsNum": is_today & F.col("semiManaged")},
        sums={
            "totalSalesVolume": F.when(is_today, F.col("sold")).otherwise(0),
            "earned": F.when(is_today, F.col("earned")).otherwise(0),
            "previousSold": F.when(~is_today, F.col("sold")).otherwise(0),
            "_today": F.when(is_today, 1).otherwise(0),
        },
    ).where("_today > 0")
    metrics = metrics.withColumns({
        "dailyGoodsNum": F.col("goodsNum"), "dailySalesVolume": F.col("totalSalesVolume")}).drop("_ids", "_today")
    per_site = (
        for_day(goods, biz_date).select("siteId", "goodsId").dropna().distinct()
        .groupBy("siteId").agg(F.count("*").alias("totalGoodsNum"))
    )
    rows = count_listing(base, malls, "optList", "optId", "optId", ["siteId"], "mallId", "totalStoreNum")
    rows = rows.withColumn("dailyStoreNum", F.col("totalStoreNum"))
    rows = enrich(enrich(rows, metrics, _OPT), per_site, ["siteId"])
    return _category_figures(rows)


def _category_rebuild(tables: Tables) -> DataFrame:
    return category_days(tables)[0]


def category_days(tables: Tables, days=None, carry: Tables | None = None,
                  hold=lambda df: df) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(daily category rows, what the next range of days needs), of the history or of a range that goes on from ``carry``.

    ``hold`` is given what several results are computed from. Carried are the latest row per category, the latest row per category and product, the totals, and the latest store day;
    of the ids seen so far only those that are new in the range are handed on.
    """
    category = _in_range(tables["dwd_category_base"], days)
    goods = _in_range(tables["dwd_goods_base"], days)
    malls = _in_range(tables["dwd_malls_base"], days).where("siteId is not null")
    spine, left = hold(date_spine(category, goods, malls)), (carry or {}).get
    edge = {}

    def by_day(valid: DataFrame, name: str) -> DataFrame:
        edge[name] = right_edge(valid)
        return expand_days(valid, spine, "valid_from").drop("valid_from", "next_date")

    kept = keep_required(category, _OPT).drop("lang", "catId", "title", "tagDesc", "href")
    base = by_day(continued(kept, _OPT, spine, left("base")), "base").drop("date").withColumnRenamed("stat_date", "date")
    paths = hold(_path_rows(goods))
    rows = enrich(base, _category_history(paths, spine, left, edge, hold), [*_OPT, "date"])

    per_site, edge["site_goods"] = distinct_so_far(
        paths, ["siteId"], "goodsId", spine, "totalGoodsNum", left("site_goods"), left("site_totals"))
    per_site = by_day(per_site, "site_totals").drop("date")
    rows = enrich(rows, per_site.withColumnRenamed("stat_date", "date"), ["siteId", "date"])

    listed = explode_listed(malls, "optList", "optId", "optId").select("mallId", "siteId", "optId", "date")
    listed = hold(listed.where("mallId is not null").distinct())
    total, edge["stores"] = distinct_so_far(listed, _OPT, "mallId", spine, "totalStoreNum", left("stores"), left("store_totals"))
    total = by_day(total, "store_totals").drop("date")
    rows = enrich(rows, total.withColumnRenamed("stat_date", "date"), [*_OPT, "date"])
    latest = by_day(continued(malls.select("siteId", "date").distinct(), ["siteId"], spine, left("latest")), "latest")
    latest = latest.withColumnsRenamed({"date": "latest_date", "stat_date": "date"})
    rows = enrich(rows, latest, ["siteId", "date"])
    per_day = listed.groupBy(*_OPT, "date").agg(F.count("*").alias("dailyStoreNum"))
    if carry:
        per_day = per_day.unionByName(carry["per_day"])
    edge["per_day"] = per_day.join(edge["latest"], ["siteId", "date"], "left_semi")
    rows = enrich(rows, per_day.withColumnRenamed("date", "latest_date"), [*_OPT, "latest_date"])
    return _category_figures(rows), edge


def _category_history(paths: DataFrame, spine: DataFrame, left, edge: dict[str, DataFrame], hold) -> DataFrame:
    """Category figures per spine day from daily differences; puts what the next range needs into ``edge``.

    Each product row says what changes on its day in its category: a product seen for the first
    time, its first semi-managed day, and its new sales minus those of its previous row. The
    changes are added up per category and day, then summed along the days.
    """
    keys = [*_OPT, "goodsId"]
    by_product = Window.partitionBy(*keys).orderBy("valid_from", "own")
    before = by_product.rowsBetween(Window.unboundedPreceding, -1)
    counted, semi = F.col("goodsId").isNotNull(), F.col("semi")

    def step(value: str) -> Column:
        return F.col(value) - F.coalesce(F.lag(value).over(by_product), F.lit(0))

    products = paths.select(*keys, "date", "sold", "earned", F.coalesce("semiManaged", F.lit(False)).alias("semi"))
    changes = hold(with_carry(products, spine, left("products")).withColumns({
        "_new": F.when(counted & (F.row_number().over(by_product) == 1), 1).otherwise(0),
        "_semi": F.when(
            counted & semi & ~F.coalesce(F.max(semi).over(before), F.lit(False)), 1).otherwise(0),
        "_sold": step("sold"),
        "_earned": step("earned"),
        "semi": F.max(semi).over(by_product.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_last": F.lead("valid_from").over(by_product).isNull(),
    }))
    edge["products"] = changes.where("_last").select(*products.columns)
    daily = changes.where("own").groupBy(*_OPT, "date").agg(
        F.sum("_new").alias("goodsNum"),
        F.sum("_semi").alias("halfPipelineGoodsNum"),
        F.sum("_sold").alias("totalSalesVolume"),
        F.sum("_earned").alias("earned"),
        F.sum(F.when(counted, 1).otherwise(0)).alias("dailyGoodsNum"),
        F.sum("sold").alias("dailySalesVolume"),
    )
    totals = ("goodsNum", "halfPipelineGoodsNum", "totalSalesVolume", "earned")
    valid = continued(daily, _OPT, spine, left("totals"), dict.fromkeys(totals, "sum"),
                      {"_day_before": F.lag("date"), "_sold_before": F.lag("dailySalesVolume")})
    edge["totals"] = right_edge(valid).select(*daily.columns)
    rows = expand_days(valid, spine, "valid_from")
    same, next_day = F.col("date") == F.col("stat_date"), F.col("date") == F.date_sub("stat_date", 1)
    adjacent = F.col("_day_before") == F.date_sub("date", 1)
    return rows.withColumns({
        "previousSold": F.when(same, F.when(adjacent, F.col("_sold_before")).otherwise(0))
        .when(next_day, F.col("dailySalesVolume")).otherwise(0),
        "dailyGoodsNum": F.when(same, F.col("dailyGoodsNum")).otherwise(0),
        "dailySalesVolume": F.when(same, F.col("dailySalesVolume")).otherwise(0),
    }).drop("date", "valid_from", "next_date", "_day_before", "_sold_before").withColumnRenamed("stat_date", "date")


# -- reviews -----------------------------------------------------------------------------------

@_daily
def build_review_daily(tables: Tables, biz_date=None) -> DataFrame:
    """G9/G10."""
    reviews = tables["dwd_review_base"]
    rows = reviews.where("date is not null") if biz_date is None else for_day(reviews, biz_date)
    return _shaped(rows.withColumns({
        "commentEnglish": F.col("comment"),
        "commentChinese": d.chinese_comment(F.col("lang"), F.col("comment"), F.col("reviewLang")),
        "imageOrVideoList": d.media_list(F.col("list"), F.col("pictures")),
    }), "dws_review_daily")


# Daily table -> builder, in run order: the external feed is written after the crawled products.
BUILDERS = (
    ("dws_goods_daily", build_goods_daily),
    ("dws_goods_daily", build_external_goods_daily),
    ("dws_malls_daily", build_malls_daily),
    ("dws_category_daily", build_category_daily),
    ("dws_review_daily", build_review_daily),
)


def build_day(lake: Warehouse, biz_date: str) -> None:
    """All daily tables of one day, in run order: each is built from what the lake holds, and written back.

    First days come from states that the lake keeps, so the history isn't read.

    A rerun replaces the day's rows, also after a merge. Later days and later builds win. A row with a figure
    that its column can't hold goes to the rejects.
    """
    for step, (table, build) in enumerate(BUILDERS):
        rows = build(lake.tables(), biz_date, lost=True)
        seq = dt.date.fromisoformat(biz_date).toordinal() * 100 + step
        _load(lake, rows, table, biz_date, seq, writer=build.__name__)


#: Parts of a category edge that grow by what each range adds; the others are as of the edge. The last one is written last.
_SEEN = ("site_goods", "stores")
_EDGE = (*_SEEN, "products", "totals", "site_totals", "store_totals", "latest", "per_day", "base")
# Builder of a history -> the table its days come from, its rows with the days they hold for, and the daily rows of those.
HISTORIES = {
    "goods": ("dwd_goods_base", goods_history, _goods_rows),
    "external": ("dwd_external_goods_daily", external_history, _external_rows),
}


def _edge_before(lake: Warehouse, name: str, sources: tuple[str, ...], first: str) -> str | None:
    """Last day of the range that ends before ``first``; days that no range covers must not lie between."""
    edges = [day for day in lake.edges(name) if day < first]
    for source in sources if edges else ():
        between = lake.scan(source).where(F.col("date") > F.lit(edges[-1]).cast("date"))
        if not between.where(F.col("date") < F.lit(first).cast("date")).isEmpty():
            raise ValueError(f"{source} has days between {edges[-1]} and {first} that are not built")
    return edges[-1] if edges else None


def _any_before(tables: Tables, sources: tuple[str, ...], first: str) -> bool:
    return any(not _in_range(tables[source], _before(first)).isEmpty() for source in sources)


def _before(first: str) -> tuple[str, str]:
    return "0001-01-01", (dt.date.fromisoformat(first) - dt.timedelta(1)).isoformat()


def rebuild_days(lake: Warehouse, history: str, first: str, last: str, seq: int) -> None:
    """G2/G4/G8 for a range of days: the daily rows from ``first`` to ``last`` are built and written.

    Only clean rows of these days are read, and what the range before has left at its right edge. Without
    a range that ends before, the edge is found in the whole earlier history. A range is replaced when it is built again;
    ranges after it then have to be built again, too.
    """
    if history == "category":
        return _rebuild_categories(lake, first, last, seq)
    source, valid, rows = HISTORIES[history]
    tables, days = lake.tables(), (first, last)
    edge = _edge_before(lake, history, (source,), first)
    if edge is not None:
        carry = lake.read_edge(history, edge)
    else:
        carry = right_edge(valid(tables, _before(first))) if _any_before(tables, (source,), first) else None
    found = valid(tables, days, carry)
    _load(lake, rows(tables, found, days), "dws_goods_daily", f"{first}_{last}", seq, writer=f"rebuild-{history}")
    lake.write_edge(right_edge(found), history, last)  # last: with it the range is complete


def _rebuild_categories(lake: Warehouse, first: str, last: str, seq: int) -> None:
    tables, sources = lake.tables(), ("dwd_category_base", "dwd_goods_base", "dwd_malls_base")
    edge = _edge_before(lake, "category-base", sources, first)
    carry = {}
    if edge is None:
        if _any_before(tables, sources, first):
            carry = category_days(tables, _before(first))[1]
    else:
        for part in _EDGE:
            name = f"category-{part}"
            days = [day for day in lake.edges(name) if day <= edge] if part in _SEEN else [edge]
            carry[part] = reduce(DataFrame.unionByName, [lake.read_edge(name, day) for day in days])
    held = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        rows, found = category_days(tables, (first, last), carry, hold)
        _load(lake, rows, "dws_category_daily", f"{first}_{last}", seq, writer="rebuild-category")
        for part in _EDGE:
            if edge is None and carry and part in _SEEN:  # the ids before the first range, too
                found[part] = found[part].unionByName(carry[part])
            lake.write_edge(found[part], f"category-{part}", last)
    finally:
        for df in reversed(held):
            df.unpersist()
