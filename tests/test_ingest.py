"""Documents in, raw and clean rows out: the behaviour each feed has to keep."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemart.operators.documents import parse_tolerant_json, split_quarantine
from tidemart.functions import clean
from tidemart.functions.jsonpath import json_get
from tidemart.operators.project import project_by_mapping, stamp
from tidemart.operators.quality import check_schema, enforce_schema, row_to_json
from tidemart.plans.ingest import FEEDS
from tidemart.schemas import TABLES

RUN_DATE = "2026-05-30"
REGION = {"headerData": {"region": {"regionInfo": {"siteId": 100, "selectedLang": "en", "selectedCurrency": "USD"}}}}


def documents(spark, *docs):
    texts = [d if isinstance(d, str) else json.dumps(d, ensure_ascii=False) for d in docs]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return stamp(parse_tolerant_json(df), RUN_DATE, f"{RUN_DATE} 08:00:00").where("doc is not null")


def raw(spark, feed, *docs):
    return FEEDS[feed].extract(documents(spark, *docs))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def only(df):
    found = rows(df)
    assert len(found) == 1, found
    return found[0]


# -- P1 ---------------------------------------------------------------------------------------

def test_tolerant_json(spark):
    texts = [
        '{"a": 1}',
        "{'a': None, 'b': True, 'c': 'None True False should stay text', d: [1, 2,], 'e': 'it\\'s'}",
        "{invalid",
        "",
        '{"a": tru}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r.i: r.doc for r in parse_tolerant_json(df).collect()}
    assert got[0] == '{"a": 1}'
    assert json.loads(got[1]) == {
        "a": None, "b": True, "c": "None True False should stay text", "d": [1, 2], "e": "it's"}
    assert got[2] is None and got[3] is None and got[4] is None
    good, bad = split_quarantine(df)
    assert good.count() == 2
    assert sorted(r.value for r in bad.collect()) == ['{"a": tru}', "{invalid"]


def test_flattened_keys_are_nested(spark):
    doc = {"goods.goodsId": 7, "goods.gallery[0].url": "u0", "goods.skc.0.a": 1, "goods.skc.1.a": 2, "x": {"y": 3}}
    row = parse_tolerant_json(spark.createDataFrame([(json.dumps(doc),)], "value string")).collect()[0]
    assert json.loads(row.doc) == {
        "x": {"y": 3}, "goods": {"goodsId": 7, "gallery": [{"url": "u0"}], "skc": [{"a": 1}, {"a": 2}]}}
    assert row.singles == ["goods.gallery"]


def test_only_mapped_flattened_keys_are_nested(spark):
    paths = ["goods.goodsId", "goods.skc", "ext", "list.i.name", "map.value.v", "plain"]
    docs = {
        "mapped": {"goods.goodsId": 7, "goods.skc.0.a": 1, "goods.skc.1.a": 2, "other.key": 1},
        "content": {"ext": {"p.search": "x", "q": {"r.s": 1.50}}, "goods.other": 2},
        "entries": {"ext": {"0.a": 1, "1.a": 2}, "list": [{"name.x": 1, "no.no": 2}], "map": {"k": {"v.w": 3, "z.z": 4}}},
    }
    rows = [(n, json.dumps(d)) for n, d in docs.items()] + [("as it came", '{ "ext":{"p.search":1.50e2} }')]
    got = {r.n: r.doc for r in parse_tolerant_json(spark.createDataFrame(rows, "n string, value string"), paths=paths).collect()}
    assert json.loads(got["mapped"]) == {"goods": {"goodsId": 7, "skc": [{"a": 1}, {"a": 2}]}, "other.key": 1}
    assert json.loads(got["content"]) == docs["content"] and got["as it came"] == rows[-1][1]
    assert json.loads(got["entries"]) == {"ext": [{"a": 1}, {"a": 2}], "list": [{"name": {"x": 1}, "no.no": 2}],
                                          "map": {"k": {"v": {"w": 3}, "z.z": 4}}}


def test_feeds_keep_unmapped_keys(spark):
    row = only(raw(spark, "product_goods", {"goods.goodsId": 5, "localInfo": {"a.b": 1}, "x.y": 2}))
    assert row["goodsId"] == 5


def test_numbers_and_texts_of_the_external_feed(spark):
    def doc(sold, number="77"):
        return {"code": 0, "data": {"site": {"id": 100.9}, "goods": {"goodsId": number, "optId": "3.5"}, "rankings": [], "stats": {},
                                    "history": [{"createTime": "2026-05-30T01:02:03Z", "sold": sold, "quantity": "4.0"}]}}
    for sold, want in ((12.5, 12), ("12.5", None), (5, 5), ("5", 5), (-2.5, -2), (True, None)):
        row = only(FEEDS["external_goods"].to_clean(raw(spark, "external_goods", doc(sold))))
        assert (row["sold"], row["quantity"], row["siteId"], row["goodsId"], row["optId"]) == (want, 4, 100, 77, None)
    assert only(raw(spark, "external_goods", doc(1, 77.5)))["goodsId"] == 77


# -- product page: goods ----------------------------------------------------------------------

def test_ordered_sources_one_row(spark):
    doc = {
        "goodsId": 9001,
        "goods": {"goodsId": 9002, "thumbUrl": "primary-thumb"},
        "sku": [{"thumbUrl": "sku-thumb"}],
        "formatSkuData": {"skuInfos": {"sku-a": {"thumbUrl": "format-thumb"}}},
        "reviewStore": {
            "pageReviewListMap": {"0": [
                {"goodsId": 1001, "opList": [{"linkUrl": "page-link-1", "status": 11}]},
                {"goodsId": 1002, "opList": [{"linkUrl": "page-link-2", "status": 12}]},
            ]},
            "commentList": [{"goodsId": 2001, "opList": [{"linkUrl": "comment-link-1", "status": 21}]}],
        },
        "moduleMap": {"shareModule": {"data": {"share": {"linkUrl": "share-link"}}}},
        "webLayoutData": REGION,
        "localInfo": {"timezone": "Asia/Shanghai"},
        "lang": "en", "userAgent": "test-agent", "serverTime": "999999",
    }
    row = only(raw(spark, "product_goods", doc))
    assert row["goodsId"] == 9001 and row["linkUrl"] == "page-link-1" and row["thumbUrl"] == "primary-thumb"
    assert row["siteId"] == 100 and row["userAgent"] == "test-agent" and row["timezone"] == "Asia/Shanghai"
    assert row["status"] == 21  # no similar reviews, no page status: comments come before review pages
    assert row["date"] == dt.date(2026, 5, 30)
    clean = only(FEEDS["product_goods"].to_clean(raw(spark, "product_goods", doc)))
    assert clean["goodsId"] == 9001 and clean["trackingKey"] is None and clean["date"] == dt.date(2026, 5, 30)


def test_requested_goods_fields(spark):
    row = only(raw(spark, "product_goods", {
        "goodsId": 6201,
        "sku": [{"skuExt": {"business_reduction": "660"}}],
        "goods": {"sellerType": 2, "gallery": [{"url": "g0", "priority": 1}], "saleInfo": {"sideSalesTip": "By "}},
        "query": {"search_key": "Men's Earmuffs"},
        "review": {"reviewData": {"expParams": {"sortTypeStyle": "1"}}, "reviewScore": 4.8},
        "moduleMap": {"mallModule": {"data": {"mallData": {"mallTags": [{"tagCode": 70}]}}}},
        "mall": {"mallData": {"goodsSalesNumUnit": ["4.8K", "Sold"]}},
    }))
    assert row["businessReduction"] == "660" and row["sellerType"] == 2 and row["searchKey"] == "Men's Earmuffs"
    assert row["sortTypeStyle"] == 1 and row["reviewScore"] == "4.8" and row["tagCode"] == 70
    assert row["salesNum"] == 4800 and row["salesTipText"] == '["By "]' and row["sideSalesTip"] == "By "
    assert json.loads(row["image"]) == {"url": "g0", "priority": 1}


FALLBACKS = [
    ({"goods": {"goodsId": 1, "thumbUrl": ""}, "sku": [{"thumbUrl": "sku-thumb"}]}, "thumbUrl", "sku-thumb"),
    ({"goods": {"goodsId": 1, "thumbUrl": None}, "sku": [{"thumbUrl": ""}], "formatSkuData": {"skuInfos": {
        "sku-b": {"thumbUrl": ""}, "sku-a": {"thumbUrl": "format-thumb"}}}}, "thumbUrl", "format-thumb"),
    ({"goods": {"goodsId": 1, "mallId": []}, "mall": {"mallData": {"mallId": "second"}}}, "mallId", "second"),
    ({"goods": {"goodsId": 1, "mallId": {}}, "mall": {"mallData": {"mallId": "second"}}}, "mallId", "second"),
    ({"goodsId": 1, "reviewStore": {"similarReview": {"reviewNum": "not-a-number"}, "reviewNum": 25}},
     "reviewNum", 25),
    ({"goodsId": 1, "goods": {"goodsName": "Temu"}, "reviewStore": {"similarReview": {"reviewInfoList": [
        {"goodsInfo": {"goodsName": "Actual"}}]}}}, "title", "Actual"),
    ({"goodsId": 1, "goods": {"goodsName": "First"}, "reviewStore": {"similarReview": {"reviewInfoList": [
        {"goodsInfo": {"goodsName": "Second"}}]}}}, "title", "First"),
    ({"goods.goodsId": 5, "goods.gallery[0].url": "u0"}, "gallery", '{"url":"u0"}'),
    ({"goods.goodsId": 5, "goods.gallery[0].url": "u0", "goods.gallery[1].url": "u1"}, "gallery",
     '[{"url":"u0"},{"url":"u1"}]'),
    ({"goodsId": 1, "formatSkuData": {"skuInfos": {"z": {"isOnsale": 0}, "a": {"isOnsale": 1}}}}, "isOnsale", 0),
]


def test_goods_fallbacks(spark):
    numbered = [{**doc, "sizeGuide": {"case": n}} for n, (doc, _, _) in enumerate(FALLBACKS)]
    got = {json.loads(r["sizeGuide"])["case"]: r for r in rows(raw(spark, "product_goods", *numbered))}
    assert {n: got[n][column] for n, (_, column, _) in enumerate(FALLBACKS)} == {
        n: expected for n, (_, _, expected) in enumerate(FALLBACKS)}


def test_page_without_product_id_is_dropped(spark):
    assert rows(raw(spark, "product_goods", {"goods": {"goodsName": "x"}})) == []


# -- stores -----------------------------------------------------------------------------------

def test_product_page_store(spark):
    doc = {
        "goods": {"mallId": 1001, "isLocalGoods": 1},
        "mall": {"mallData": {
            "goodsNumUnit": ["1,324", "Items"], "goodsSalesNumUnit": ["4.8K", "Sold"],
            "followerNumUnit": ["70K+", "Fans"], "mallReviewLabelShow": True, "isExpire": False,
            "shareInfo": {"shareTitle": "t", "shareUrl": "u"},
            "topShopInfo": {"topShopText": [{"textData": "a"}, {"textData": "b"}], "topShopGoToUrl": "go"},
        }},
        "crumbOptList": [{"optId": 5, "optName": "n"}, {"optName": "no id"}],
        "review": {"reviewData": {"mallReview": {"mallScore": "4.8 points"}}},
        "reviewStore": {"mallReview": {"reviewNum": "2,082"}},
        "webLayoutData": REGION, "serverTime": "1776391696477", "lang": "zh-Hans",
    }
    feed = FEEDS["product_malls"]
    records = raw(spark, "product_malls", doc)
    good, rejects = enforce_schema(feed.to_raw(records), TABLES[feed.raw_table])
    row = only(good)
    assert rows(rejects) == []
    assert (row["goodsNum"], row["goodsSalesNum"], row["followerNum"], row["reviewNum"]) == (1324, 4800, 70000, 2082)
    assert str(row["mallStar"]) == "4.8" and row["serverTime"] == 1776391696477
    assert row["mallReviewLabelShow"] is True and row["isExpire"] is False and row["semiManaged"] is True
    good, rejects = enforce_schema(feed.to_clean(records), TABLES[feed.clean_table])
    row = only(good)
    assert row["shareInfo_shareTitle"] == "t" and row["topShopInfo_topShopText_textData"] == '["a","b"]'
    assert row["topShopInfo_topShopGoToUrl"] == "go" and row["semiManagedMallTags_contents_text"] is None
    assert row["optList"] == '[{"optId":5,"optName":"n"}]' and row["semiManaged"] is True
    assert row["goodsNum"] == 1324 and row["lastUpdateTime"] == dt.datetime(2026, 5, 30, 8)


def test_store_page(spark):
    doc = {"page": {
        "mallId": 1002,
        "mallInfo": {
            "goodsNumUnit": ["1,324", "Items"], "goodsSalesNum": "4.8K", "followerNum": "70K+",
            "mallStar": "4.8 points", "reviewNum": "2,082", "serverTime": "1776391696477",
            "mallInfo": {"components": [{"picUrl": "pic-url"}]},
        },
        "userInfo": {"avatar": "a", "appCode": 7, "nickname": "mall-nick", "isDefaultAvatar": True},
        "commentStore": {"commentInfo": {"reviewNumStr": "1.2K", "scoreNumInfoList": [{"score": 5, "num": 12}],
                                         "mallInfo": {"mallReviewLabelShow": 1}}},
        "categoryStore": {"goodsList": [{"data": {"priceInfo": {"marketPriceType": 2}}}],
                          "tabList": [{"optId": 3}]},
        "decorationStore": {"decorationData": {"Home": {"data": [
            {"goodsSimpleInfoList": [{"goodsId": 11, "title": "item"}]}]}}},
        "commentBigPictureStore": {"isAiReview": False},
        "isExpire": False, "webLayoutData": REGION, "lang": "zh-Hans",
    }}
    feed = FEEDS["store_malls"]
    records = raw(spark, "store_malls", doc)
    good, rejects = enforce_schema(feed.to_raw(records), TABLES[feed.raw_table])
    assert rows(rejects) == []
    row = only(good)
    assert (row["mallId"], row["goodsNum"], row["goodsSalesNum"], row["followerNum"], row["reviewNum"]) == (
        1002, 1324, 4800, 70000, 2082)
    assert row["picUrl"] == "pic-url" and row["appCode"] == 7 and row["isDefaultAvatar"] is True
    assert row["scoreNumInfoList"] == '[{"score":5,"num":12}]' and row["marketPriceType"] == 2
    assert row["goodsSimpleInfoList"] == '[{"goodsId":11,"title":"item"}]' and row["isAiReview"] is False
    assert row["mallReviewLabelShow"] is True and row["optList"] == '[{"optId":3}]'


# -- categories -------------------------------------------------------------------------------

CRUMBS = [{"optId": 10, "optName": "a", "seoLinkUrl": "s", "priority": 1}, {"optName": "no id"},
          {"optId": 12, "optName": "c", "isFeatured": True}]


CRUMB_SHAPES = [
    {"crumbOptList": CRUMBS},
    {"crumbOptList": {str(n): c for n, c in enumerate(CRUMBS)}},
    {f"crumbOptList[{n}].{k}": v for n, c in enumerate(CRUMBS) for k, v in c.items()},
    {f"crumbOptList.{n}.{k}": v for n, c in enumerate(CRUMBS) for k, v in c.items()},
]


def test_product_categories(spark):
    pages = [{**c, "webLayoutData": REGION, "serverTime": 5, "userAgent": str(n)} for n, c in enumerate(CRUMB_SHAPES)]
    good, rejects = enforce_schema(raw(spark, "product_categories", *pages), TABLES["ods_category_raw"])
    everything = rows(good)
    assert rows(rejects) == []
    for n in range(len(CRUMB_SHAPES)):
        check_crumbs(sorted((r for r in everything if r["userAgent"] == str(n)), key=lambda r: r["optId"]))


def check_crumbs(found):
    assert [r["optId"] for r in found] == [10, 12]
    assert found[0]["catId"] == "10" and found[0]["shareUrl"] == "s" and found[0]["siteId"] == 100
    assert json.loads(found[1]["catInfo"]) == CRUMBS[2] and found[1]["isFeatured"] is True
    assert found[0]["serverTime"] == "5"


def test_search_page(spark):
    doc = {
        "goodsList": [
            {"data": {"goodsId": 1, "optId": 5, "optType": 2, "title": "a", "salesNum": "1.5K", "comment": {"goodsScore": 4},
                      "priceInfo": {"p": 1}, "skcList": [{"x": 1}]}},
            {"data": {"goodsId": 2, "title": "b"}},
        ],
        "layoutData": {**REGION, "activityInfoData": {"serverTime": 7}},
        "localInfo": {"language": "en", "timezone": "UTC", "region": 211}, "pattern": 3,
    }
    found = sorted(rows(raw(spark, "search_goods", doc)), key=lambda r: r["goodsId"])
    assert [r["goodsId"] for r in found] == [1, 2] and found[0]["siteId"] == 100
    assert found[0]["salesNum"] == 1500 and found[0]["goodsScore"] is None
    assert found[0]["seoLinkUrl"] == '{"x":1}' and found[0]["commentNumTips"] == '{"goodsScore":4}'
    cats = rows(raw(spark, "search_categories", doc))
    assert [c["optId"] for c in cats] == ["5"] and cats[0]["pattern"] == "3" and cats[0]["lang"] == "en"
    site = only(raw(spark, "search_site", doc))
    assert site["regionId"] == "211" and site["siteId"] == "100"
    empty = only(raw(spark, "search_goods", {**doc, "goodsList": []}))
    assert empty["goodsId"] is None and empty["siteId"] == 100
    assert rows(raw(spark, "search_categories", {"layoutData": REGION})) == []


def test_load_more(spark):
    doc = {"data": {"goods_list": [
        {"goods_id": 9, "opt_id": 4, "title": "", "comment": {"goods_score": "4.5"}, "image": {"url": "i"},
         "sales_num": "2,000"}], "pattern": 1, "p_search": {"k": 1}}, "siteId": 7, "server_time": 11}
    row = only(raw(spark, "more_goods", doc))
    assert row["goodsId"] == 9 and row["siteId"] is None and row["title"] is None and row["goodsScore"] == 4.5
    assert row["imageUrl"] == "i" and row["salesNum"] == 2000 and json.loads(row["image"]) == {"url": "i"}
    cat = only(raw(spark, "more_categories", doc))
    assert cat["optId"] == "4" and cat["siteId"] == "7" and cat["serverTime"] == "11" and cat["imageUrl"] == "i"
    assert only(raw(spark, "more_goods", {"data": {}}))["goodsId"] is None


# -- reviews ----------------------------------------------------------------------------------

def test_aligned_review_sources(spark):
    doc = {
        "review": {"reviewData": {"reviewInfoList": [
            {"reviewId": "main-1", "comment": "c1", "list": [{"url": "m"}]}, {"review_id": "main-2", "content": "c2"}],
            "similarReview": {"reviewInfoList": [{"reviewId": "sim-1", "list": [1], "rating": 4}]}}},
        "reviewStore": {"commentList": [{"reviewId": "store-1", "user": {"name": "u"}}],
                        "pageReviewListMap": {"1": [{"reviewId": "p1"}], "0": [{"reviewId": "p0"}]}},
        "webLayoutData": REGION, "lang": "en",
    }
    found = sorted(rows(raw(spark, "product_reviews", doc)), key=lambda r: r["reviewId"])
    by_id = {r["reviewId"]: r for r in found}
    assert set(by_id) == {"main-1", "main-2", "sim-1", "store-1", "p1", "p0"}
    assert by_id["main-2"]["comment"] == "c2" and by_id["main-1"]["list"] == '[{"url":"m"}]'
    assert by_id["sim-1"]["list"] is None and by_id["sim-1"]["score"] == 4
    assert by_id["store-1"]["name"] == "u" and by_id["store-1"]["siteId"] == 100 and by_id["store-1"]["lang"] == "en"


def test_blank_review_ids_are_dropped(spark):
    doc = {"review": {"reviewData": {"reviewInfoList": [{"reviewId": " "}, {"comment": "x"}, {"reviewId": " ok "}]}},
           "webLayoutData": REGION}
    assert only(raw(spark, "product_reviews", doc))["reviewId"] == "ok"


def test_python_style_reviews(spark):
    text = (
        "{'$ctx': None,'needHeadData': True,'review': {'reviewData': {'reviewInfoList': ["
        "{'reviewId': 'main-1', 'goodsId': 'goods-main'}]}},"
        "'reviewStore': {'commentList': [{'reviewId': 'store-1'}],"
        "'pageReviewListMap': {'0': [{'reviewId': 'page-1'}],'1': []},"
        "'initPageReviewListMap': {'0': [{'reviewId': 'init-1'}],'1': []}},"
        "'webLayoutData': {'headerData': {'region': {'regionInfo': {'siteId': 100}}}},'lang': 'en'}"
    )
    found = rows(raw(spark, "product_reviews", text))
    assert {r["reviewId"] for r in found} == {"main-1", "store-1", "page-1", "init-1"}
    assert {r["siteId"] for r in found} == {100}


# -- external history -------------------------------------------------------------------------

def external(**changes):
    doc = {"code": 0, "data": {
        "rankings": {}, "stats": [],
        "site": {"id": 100, "regionId": 211, "currency": "USD", "exchangeRate": "7.1234567", "cents": 100},
        "goods": {"id": 3, "goodsId": "601", "mallId": "55", "goodsName": "n", "catItems": [
            {"catId": 1, "isLeaf": False}, {"catId": 17056, "isLeaf": True}], "catIds": [1, 17056],
            "sku": "[{\"id\":1}]", "status": 1, "onSaleTime": "2026-05-01T10:00:00+08:00"},
        "history": [
            {"id": 1, "sold": "12.0", "sales": 899000, "minPrice": 1.23456, "quantity": "12.5",
             "createTime": "2026-05-05T00:13:41+08:00"},
            {"id": 2, "goodsId": 602, "regionId": 5, "sold": 3, "createTime": "2026-05-06T01:00:00+08:00"},
            {"id": 3, "createTime": "bad"},
            "no object",
        ]}}
    doc["data"].update(changes)
    return doc


def test_history_rows(spark):
    records = raw(spark, "external_goods", external())
    found = sorted(rows(FEEDS["external_goods"].to_clean(records)), key=lambda r: r["date"])
    assert [r["date"] for r in found] == [dt.date(2026, 5, 5), dt.date(2026, 5, 6)]
    first, second = found
    assert str(first["sales"]) == "899000.0000" and first["catId"] == 17056 and first["sold"] == 12
    assert first["historyCreateTime"] == dt.datetime(2026, 5, 5, 0, 13, 41) and first["quantity"] is None
    assert first["goodsId"] == 601 and second["goodsId"] == 602 and (first["regionId"], second["regionId"]) == (211, 5)
    assert str(first["minPrice"]) == "1.2346" and str(first["exchangeRate"]) == "7.123457"
    assert first["skuInfo"] == '[{"id":1}]' and first["currency"] == "USD"
    raw_row = only(records)
    assert raw_row["date"] == dt.date(2026, 5, 30) and raw_row["goodsId"] == 601


def test_bad_external_payloads(spark):
    assert rows(raw(spark, "external_goods", '{"code":0,"data":{}}', "{invalid", "", external(site={"id": "x"}))) == []
    records = raw(spark, "external_goods", external(history={"a": 1}))
    assert records.count() == 1 and FEEDS["external_goods"].to_clean(records).count() == 0


# -- load rules -------------------------------------------------------------------------------

def test_strict_load_rejects(spark):
    df = spark.createDataFrame(
        [("1", "100", "211", '["en"]'), ("2", None, "3", None), ("3", "x", "4", None), ("4", "5", "6", "[bad")],
        "phoneCode string, siteId string, regionId string, supportedLangList string",
    ).withColumn("date", F.lit(RUN_DATE).cast("date"))
    good, rejects = enforce_schema(df, TABLES["dwd_site_base"])
    assert [(r["phoneCode"], r["supportedLangList"]) for r in rows(good)] == [("1", '["en"]'), ("4", '"[bad"')]
    reasons = {json.loads(r["row"])["phoneCode"]: r["reasons"] for r in rows(rejects)}
    assert reasons == {"2": ["siteId"], "3": ["siteId"]}


def test_row_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, '{"k":1}', "x\"y")], "a int, b string, j string, t string")
    got = row_to_json(df, json_columns=("j",)).collect()[0].json
    assert got == '{"a":1,"b":null,"j":{"k":1},"t":"x\\"y"}'


# -- work per row -------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_rejected_rows_carry_what_they_came_as(spark):
    given = spark.createDataFrame([("1", 5), ("x", 5)], "siteId string, regionId long").withColumn("date", F.lit(RUN_DATE).cast("date"))
    found = {r["siteId"]: r for r in check_schema(given, TABLES["dwd_site_base"]).collect()}
    assert found[1]["_row"] is None and found[1]["reasons"] == []
    assert found[None]["_row"]["siteId"] == "x" and found[None]["reasons"] == ["siteId"]


def test_ordered_sources_convert_as_one_flat_list(spark):
    docs = spark.createDataFrame([('{"a":" ","b":"7","c":"x","d":["y"],"e":"12K"}',), ("{}",)], "doc string")
    mapping = {"n": ["a", "c", "b"], "m": "e", "s": ["a", "c"], "j": ["a", "d"], "k": ["d"]}
    types = {"n": "BIGINT", "m": "BIGINT", "s": "STRING", "j": "JSON", "k": "JSON"}
    found = project_by_mapping(docs, mapping, types, mode="eligible")
    assert rows(found)[0] == {"n": 7, "m": 12000, "s": "x", "j": '["y"]', "k": '["y"]'}
    assert set(rows(found)[1].values()) == {None}
    assert "transform(array(array(" not in plan(found) and "filter(" not in plan(found)


def test_lists_have_no_keys_to_look_up(spark):
    texts = spark.createDataFrame([('[{"a":1}]',), ('[{"b":1}]',), ('{"0":{"a":2}}',), ('\n[{"a":3}]',), (" [1]",), (None,)], "t string")
    found = texts.select(json_get(F.col("t"), ["0", "a"]).alias("v"))
    assert [r["v"] for r in found.collect()] == ["1", None, "2", "3", None, None]
    assert "StartsWith(" in plan(found)


def test_whole_numbers_are_read_as_such(spark):
    texts = [str(2**63 - 1), str(2**63), str(-2**63), "12.9", "-12.9", '"12"', '"12.5"', '" 12.0 "', "true", "null", "[1]", "1e3"]
    docs = spark.createDataFrame([(f'{{"v":{t}}}',) for t in texts], "doc string")
    found = docs.select(clean.json_long(F.from_json("doc", "v variant").v).alias("v"))
    assert [r["v"] for r in found.collect()] == [2**63 - 1, None, -2**63, 12, -12, 12, None, 12, None, None, None, 1000]
    assert "= BIGINT)" in plan(found)
