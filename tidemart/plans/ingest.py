"""The twelve feeds: page documents -> raw rows -> clean rows.

Every feed takes a frame with ``doc``, ``singles``, ``run_date`` and ``run_ts``; nothing in here
shuffles, a feed is one narrow stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import mappings as m
from tidemart.functions import clean
from tidemart.functions.jsonpath import DocumentPaths, json_get, once
from tidemart.operators.documents import unwrap_envelope
from tidemart.operators.explode import (
    explode_aligned_sources,
    explode_crumbs,
    explode_history,
    explode_list_outer,
    list_items,
    map_items,
)
from tidemart.operators.filters import keep_required
from tidemart.operators.project import (
    as_type,
    cast_layer,
    embedded_json,
    keep_entries_with,
    leaf_category,
    nested_leaves,
    normalise_mapping,
    project_by_mapping,
    with_aliases,
)
from tidemart.operators.quality import coerce_mall_row
from tidemart.schemas import PERIOD_METRICS, PERIODS, TABLES

_RUN = ("run_date", "run_ts")


@dataclass(frozen=True)
class Feed:
    """``extract`` yields records, ``to_raw`` and ``to_clean`` the rows of the two tables. Flattened keys are looked up along
    ``paths``, or everywhere if there are none."""

    name: str
    topic: str
    group: str
    raw_table: str
    clean_table: str
    extract: Callable[[DataFrame], DataFrame]
    to_clean: Callable[[DataFrame], DataFrame]
    to_raw: Callable[[DataFrame], DataFrame] = lambda records: records
    paths: frozenset[str] | None = None


def _texts(table: str, *extra: str) -> dict[str, str]:
    names = [n for n in TABLES[table].types if n != "date"]
    return dict.fromkeys([*names, *extra], "STRING")


def _typed(table: str) -> dict[str, str]:
    return {n: k for n, k in TABLES[table].types.items() if n != "date"}


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"run_date": "date", "run_ts": "lastUpdateTime"})


# -- product page: goods ---------------------------------------------------------------------

def product_goods(docs: DataFrame) -> DataFrame:
    """One row per page; a page without a product id gives none."""
    rows = project_by_mapping(docs, m.PRODUCT_GOODS, _typed("ods_goods_raw"), mode="eligible", keep=_RUN)
    return _dated(rows.where("goodsId is not null"))


def clean_goods(records: DataFrame) -> DataFrame:
    return cast_layer(records, TABLES["dwd_goods_base"].types)


# -- stores ----------------------------------------------------------------------------------

_MALL_FLAG_TYPES = {"isDefaultAvatar": "BOOLEAN", "semiManaged": "BOOLEAN", "isAiReview": "BOOLEAN"}


def _clean_mall_numbers(df: DataFrame) -> DataFrame:
    with_unit = {
        c: clean.number_with_unit_fallback(F.col(c), F.col(f"{c}Unit")).cast("string")
        for c in ("goodsNum", "goodsSalesNum", "followerNum")
    }
    return df.withColumns({
        **with_unit,
        "reviewNum": clean.parse_human_number(F.col("reviewNum")).cast("string"),
        "mallStar": clean.parse_decimal_text(F.col("mallStar")),
        "serverTime": clean.parse_human_number(F.col("serverTime")).cast("string"),
    })


def store_malls(docs: DataFrame) -> DataFrame:
    """The store document is the first child of the message."""
    types = {**_texts("ods_malls_raw"), **_MALL_FLAG_TYPES}
    inner = docs.withColumn("doc", unwrap_envelope(F.col("doc")))
    return _dated(_clean_mall_numbers(project_by_mapping(inner, m.STORE_MALLS, types, keep=_RUN)))


def product_malls(docs: DataFrame) -> DataFrame:
    """I4."""
    types = {**_texts("ods_malls_raw"), **_MALL_FLAG_TYPES}
    rows = project_by_mapping(
        docs, m.PRODUCT_MALLS, types, keep=_RUN, json_text=m.PRODUCT_MALLS_JSON_TEXT)
    return _dated(_clean_mall_numbers(rows))


def clean_malls(records: DataFrame) -> DataFrame:
    leaves = {
        name: nested_leaves(F.col(name.split("_")[0]), name.split("_")[1:])
        for name in TABLES["dwd_malls_base"].types
        if "_" in name
    }
    return records.withColumns({
        "goodsNum": clean.number_with_unit_fallback(F.col("goodsNum"), F.col("goodsNumUnit")).cast("string"),
        "goodsSalesNum": clean.number_with_unit_fallback(F.col("goodsSalesNum"), F.col("goodsSalesNumUnit")),
        "followerNum": clean.parse_human_number(F.col("followerNum")).cast("string"),
        "optList": keep_entries_with(F.col("optList"), "optId"),
        **leaves,
    }).select(*TABLES["dwd_malls_base"].types)


# -- categories ------------------------------------------------------------------------------

def product_categories(docs: DataFrame) -> DataFrame:
    """One row per breadcrumb that has an id."""
    page = project_by_mapping(
        docs, {**m.CRUMB_PAGE_FIELDS, "crumbs": "crumbOptList"},
        dict.fromkeys([*m.CRUMB_PAGE_FIELDS, "crumbs"], "STRING"), keep=_RUN,
    )
    rows = explode_crumbs(page, "crumbs").withColumnRenamed("item", "catInfo")
    rows = project_by_mapping(
        rows, m.CRUMB_FIELDS, _texts("ods_category_raw"), doc="catInfo", singles=None,
        keep=(*_RUN, "catInfo", *m.CRUMB_PAGE_FIELDS),
    )
    return _dated(keep_required(rows, ["optId"]))


def _list_rows(docs: DataFrame, list_path: str, page: dict, item: dict, types: dict[str, str],
               mode: str = "strict") -> DataFrame:
    """Search pages: page fields on every list entry, one row when the list is empty."""
    around = project_by_mapping(
        docs, {**page, "_list": list_path},
        {**{n: types[n] for n in page}, "_list": "STRING"}, mode=mode, keep=_RUN,
    )
    rows = explode_list_outer(around, "_list")
    return _dated(project_by_mapping(
        rows, item, types, doc="item", mode=mode, singles=None, keep=(*_RUN, *page)))


def search_categories(docs: DataFrame) -> DataFrame:
    """I7."""
    rows = _list_rows(docs, m.SEARCH_LIST, m.SEARCH_CATEGORY_PAGE, m.SEARCH_CATEGORY_ITEM,
                      _texts("ods_category_raw"))
    return rows.where("optId <> ''")


def more_categories(docs: DataFrame) -> DataFrame:
    """I10."""
    rows = _list_rows(docs, m.MORE_LIST, m.MORE_CATEGORY_PAGE, m.MORE_CATEGORY_ITEM,
                      _texts("ods_category_raw"), mode="filled")
    return rows.where("optId <> ''")


def clean_categories(records: DataFrame) -> DataFrame:
    return records.select(*TABLES["dwd_category_base"].types)


# -- search pages: goods ---------------------------------------------------------------------

def search_goods(docs: DataFrame) -> DataFrame:
    """I8."""
    return _list_rows(docs, m.SEARCH_LIST, m.SEARCH_GOODS_PAGE, m.SEARCH_GOODS_ITEM, _typed("ods_goods_raw"))


def more_goods(docs: DataFrame) -> DataFrame:
    """These rows carry no site."""
    return _list_rows(docs, m.MORE_LIST, m.MORE_GOODS_PAGE, m.MORE_GOODS_ITEM, _typed("ods_goods_raw"),
                      mode="filled")


# -- sites -----------------------------------------------------------------------------------

def product_site(docs: DataFrame) -> DataFrame:
    """I6."""
    return _dated(project_by_mapping(docs, m.PRODUCT_SITE, _texts("ods_site_raw"), keep=_RUN))


def search_site(docs: DataFrame) -> DataFrame:
    """I9."""
    return _dated(project_by_mapping(docs, m.SEARCH_SITE, _texts("ods_site_raw"), keep=_RUN))


def clean_sites(records: DataFrame) -> DataFrame:
    return records.select(*TABLES["dwd_site_base"].types)


# -- reviews ---------------------------------------------------------------------------------

def product_reviews(docs: DataFrame) -> DataFrame:
    """Rows of six lists of one page, in list order, each entry parsed once."""
    heads = [source.removesuffix("[i]").removesuffix(".value") for source in m.REVIEW_SOURCES]
    paths = DocumentPaths([*heads, *m.REVIEW_PAGE_FIELDS.values()])
    page = paths.parse(docs, "doc")
    page = page.select(
        *_RUN,
        *[paths.text(p).alias(f"_page_{n}") for n, p in m.REVIEW_PAGE_FIELDS.items()],
        *[paths.text(p).alias(f"_list_{n}") for n, p in enumerate(heads)],
    )
    lists = [
        map_items(F.col(f"_list_{n}")) if ".value" in source else list_items(F.col(f"_list_{n}"))
        for n, source in enumerate(m.REVIEW_SOURCES)
    ]
    rows = explode_aligned_sources(page, lists)

    # A map keeps names apart that differ only in case (nickname, nickName).
    rows = rows.withColumn("_item", once(F.from_json(F.col("item"), "map<string,string>")))
    item = F.col("_item")
    similar = F.col("source").isin(
        *[n for n, s in enumerate(m.REVIEW_SOURCES) if s in (m.PAGE_SIMILAR, m.STORE_SIMILAR)])

    values: dict[str, Column] = {}
    for name in m.REVIEW_ITEM_FIELDS:
        value = with_aliases(item, name, m.REVIEW_ALIASES.get(name, ()))
        values[name] = F.when(~similar, value) if name in m.REVIEW_FIELDS_NOT_IN_SIMILAR else value
    for name in m.REVIEW_PAGE_FIELDS:
        values[name] = F.coalesce(F.col(f"_page_{name}"), item.getField(name))
    values["reviewId"] = F.trim(values["reviewId"])

    types = {**_typed("ods_review_raw"), "siteId": "BIGINT", "score": "BIGINT"}
    out = rows.select(
        *_RUN, "source", "pos", *[as_type(values[n], k).alias(n) for n, k in types.items()])
    return _dated(keep_required(out, ["reviewId", "siteId", "run_date"]))


def clean_reviews(records: DataFrame) -> DataFrame:
    return records.select(*TABLES["dwd_review_base"].types)


# -- external product history ----------------------------------------------------------------

_EXTERNAL_PARTS = ("rankings", "site", "stats", "goods", "history")


def external_goods(docs: DataFrame) -> DataFrame:
    """I12, raw side: F2 payload check and the five sections as JSON."""
    paths = DocumentPaths([f"data.{part}" for part in _EXTERNAL_PARTS])
    parsed = paths.parse(docs, "doc")
    rows = parsed.select(*_RUN, *[paths.text(f"data.{part}").alias(part) for part in _EXTERNAL_PARTS])
    rows = rows.withColumns({
        "goodsId": once(clean.json_long(F.from_json("goods", "goodsId variant").goodsId)),
        "siteId": once(clean.json_int(F.from_json("site", "id variant").id)),
    })
    return _dated(rows.where("goodsId is not null and siteId is not null"))


def _text(c: Column) -> Column:
    return F.when(~clean.is_container(c), clean.blank_to_null(c))


def clean_external_goods(records: DataFrame) -> DataFrame:
    """I12, clean side: one row per history entry with a valid day of its own."""
    types = TABLES["dwd_external_goods_daily"].types
    metrics = [f"{p}{name}" for name, _ in PERIOD_METRICS for p in PERIODS]
    history_fields = ["sold", "sales", "minPrice", "maxPrice", "quantity", "goodsScore", "reviewNum", *metrics]

    # Whole numbers stay typed, so that a number and the same digits as text are told apart.
    whole = {n for n, kind in types.items() if kind in ("BIGINT", "INT")}

    def strings(names):
        return ", ".join(f"`{n}` {'variant' if n in whole else 'string'}" for n in names)

    goods_schema = strings([
        "id", "regionId", "mallId", "goodsName", "goodsNameCn", "goodsNameEn", "thumbnail", "thumbnailCn",
        "catIds", "optId", "catItems", "currency", "sku", "status", "hostingMode", "onSaleTime", "createTime",
        "updateTime",
    ])
    parsed = records.withColumns({
        "_goods": once(F.from_json("goods", goods_schema)),
        "_site": once(F.from_json("site", strings(["regionId", "currency", "cents", "exchangeRate"]))),
    })
    entry_schema = strings(["id", "regionId", "goodsId", *history_fields, "createTime", "updateTime"])
    rows = explode_history(parsed, "history", entry_schema)
    goods, site, entry = (F.col(c).getField for c in ("_goods", "_site", "entry"))

    def number(source: Column, kind: str) -> Column:
        if kind == "BIGINT":
            return clean.json_long(source)
        if kind == "INT":
            return clean.json_int(source)
        precision, scale = map(int, kind[8:-1].split(","))
        return clean.to_scaled_decimal(source, scale, precision)

    def moment(source: Column) -> Column:
        return clean.normalise_datetime(source).try_cast("timestamp_ntz")

    values = {
        "goodsId": F.coalesce(clean.json_long(entry("goodsId")), F.col("goodsId")),
        "siteId": F.col("siteId"),
        "date": F.substring(clean.normalise_datetime(entry("createTime")), 1, 10).try_cast("date"),
        "regionId": F.coalesce(*[clean.json_long(s("regionId")) for s in (entry, goods, site)]),
        "sourceRecordId": _text(goods("id")),
        "historyId": _text(entry("id")),
        "catIds": goods("catIds"),
        "catItems": goods("catItems"),
        "catId": leaf_category(goods("catItems")),
        "currency": F.coalesce(_text(site("currency")), _text(goods("currency"))),
        "skuInfo": embedded_json(goods("sku")),
        "onSaleTime": moment(goods("onSaleTime")),
        "goodsCreateTime": moment(goods("createTime")),
        "goodsUpdateTime": moment(goods("updateTime")),
        "historyCreateTime": moment(entry("createTime")),
        "historyUpdateTime": moment(entry("updateTime")),
        **{n: number(goods(n), types[n]) for n in ("optId", "status", "hostingMode")},
        **{n: number(site(n), types[n]) for n in ("cents", "exchangeRate")},
        **{n: number(entry(n), types[n]) for n in history_fields},
        **{n: _text(goods(n)) for n in (
            "mallId", "goodsName", "goodsNameCn", "goodsNameEn", "thumbnail", "thumbnailCn")},
    }
    out = rows.select(*[values[n].alias(n) for n in types])
    return keep_required(out, ["goodsId", "siteId", "date"])


def _paths(page: dict, items: str | None = None, item: dict | None = None) -> frozenset[str]:
    """All document paths of a mapping, and of one for the entries of a list."""
    below = [f"{items}.i.{path}" for sources in normalise_mapping(item or {}).values() for path in sources]
    return frozenset([p for sources in normalise_mapping(page).values() for p in sources] + below)


#: Mapped paths by feed; the other feeds read whole sections of their documents or have them in an envelope.
_PATHS = {
    "product_goods": _paths(m.PRODUCT_GOODS),
    "product_malls": _paths(m.PRODUCT_MALLS),
    "product_categories": _paths(m.CRUMB_PAGE_FIELDS, "crumbOptList", m.CRUMB_FIELDS),
    "product_site": _paths(m.PRODUCT_SITE),
    "search_categories": _paths(m.SEARCH_CATEGORY_PAGE, m.SEARCH_LIST, m.SEARCH_CATEGORY_ITEM),
    "search_goods": _paths(m.SEARCH_GOODS_PAGE, m.SEARCH_LIST, m.SEARCH_GOODS_ITEM),
    "search_site": _paths(m.SEARCH_SITE),
    "more_categories": _paths(m.MORE_CATEGORY_PAGE, m.MORE_LIST, m.MORE_CATEGORY_ITEM),
    "more_goods": _paths(m.MORE_GOODS_PAGE, m.MORE_LIST, m.MORE_GOODS_ITEM),
}


def _feed(name, topic, group, entity, extract, to_clean, to_raw=lambda records: records) -> Feed:
    raw, base = {
        "goods": ("ods_goods_raw", "dwd_goods_base"),
        "malls": ("ods_malls_raw", "dwd_malls_base"),
        "category": ("ods_category_raw", "dwd_category_base"),
        "review": ("ods_review_raw", "dwd_review_base"),
        "site": ("ods_site_raw", "dwd_site_base"),
        "external": ("ods_external_goods_raw", "dwd_external_goods_daily"),
    }[entity]
    return Feed(name, topic, group, raw, base, extract, to_clean, to_raw, _PATHS.get(name))


FEEDS: dict[str, Feed] = {
    f.name: f
    for f in (
        _feed("store_malls", "storeDetail", "store-detail-mall", "malls", store_malls, clean_malls, coerce_mall_row),
        _feed("product_categories", "productDetail", "goods-detail-category", "category",
              product_categories, clean_categories),
        _feed("product_goods", "productDetail", "goods-detail-goods", "goods", product_goods, clean_goods),
        _feed("product_malls", "productDetail", "goods-detail-mall", "malls", product_malls, clean_malls,
              coerce_mall_row),
        _feed("product_reviews", "productDetail", "goods-detail-review", "review", product_reviews, clean_reviews),
        _feed("product_site", "productDetail", "goods-detail-site", "site", product_site, clean_sites),
        _feed("search_categories", "keywordSearch", "keyword-html-category", "category",
              search_categories, clean_categories),
        _feed("search_goods", "keywordSearch", "keyword-html-goods", "goods", search_goods, clean_goods),
        _feed("search_site", "keywordSearch", "keyword-html-site", "site", search_site, clean_sites),
        _feed("more_categories", "keywordSearchMore", "keyword-more-category", "category",
              more_categories, clean_categories),
        _feed("more_goods", "keywordSearchMore", "keyword-more-goods", "goods", more_goods, clean_goods),
        _feed("external_goods", "externalGoods", "external-goods", "external", external_goods,
              clean_external_goods),
    )
}
