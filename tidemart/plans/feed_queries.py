"""The twelve feeds and the table operators, on messages written from the test tables.

Each message is JSON text built by Spark from a row; the DuckDB text states the rows the tables
should hold, straight from the same source rows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import clean
from tidemart.operators import quality
from tidemart.plans.registry import on
from tidemart.plans.standins import BIZ_DATE, with_tables
from tidemart.schemas import TABLES
from tidemart.sources.readers import backfill_lines, read_source
from tidemart.sources.tables import Warehouse
from tidemart.streaming.runner import launch_feed, run_feed, run_once

RUN_TS = f"{BIZ_DATE} 08:00:00"
_BIZ = f"DATE '{BIZ_DATE}'"
_GOODS, _MALLS, _EXTERNAL = ["dwd_goods_base"], ["dwd_malls_base"], ["dwd_external_goods_daily"]

_REGION = """'"webLayoutData":{"headerData":{"region":{"regionInfo":{"siteId":', siteId,
  ',"regionId":', siteId + 200, ',"regionName":"r', siteId, '","selectedLang":"en","selectedCurrency":"USD"}}}}'"""


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one the session names; a local one only where none is named on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemart-")
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def _messages(t, table: str | None, expr: str) -> DataFrame:
    """Messages spread over all cores, the way a topic's partitions would spread them."""
    rows = t.clean[table] if table else t["events"]
    return rows.repartition(t.spark.sparkContext.defaultParallelism).select(F.expr(expr).alias("value"))


#: Registered feed queries: table and expression of their messages.
MESSAGES: dict[str, tuple[str | None, str]] = {}


def _feed(name, feed, table, expr, columns, oracle, side="clean"):
    MESSAGES[name] = table, expr

    def run(t):
        rows = run_once(_messages(t, table, expr), feed, BIZ_DATE, RUN_TS)[side]
        return rows.selectExpr(*columns)

    on(name, run, oracle)


# -- feeds ------------------------------------------------------------------------------------

_feed("i1_store_malls", "store_malls", "dwd_malls_base", f"""concat(
  '{{"page":{{"mallId":', mallId, ',"isExpire":false,"lang":"en","mallInfo":{{"mallName":"', mallName,
  '","goodsNumUnit":["1,', 100 + goodsNum, ' pcs"],"goodsSalesNum":"', goodsNum, '.5K","followerNum":"', mallId,
  'K+","mallStar":"', mallId, '.50 points","reviewNum":"', reviewNum, '","shareInfo":{{"shareTitle":"s', mallId,
  '"}}}},"categoryStore":{{"tabList":', coalesce(optList, 'null'), '}},', {_REGION}, '}}}}')""",
      ["mallId", "siteId", "date", "mallName", "goodsNum", "goodsSalesNum", "followerNum", "mallStar", "reviewNum",
       "shareInfo_shareTitle", "optList"], with_tables(_MALLS, f"""
SELECT mallId, siteId, {_BIZ} AS date, mallName, 1100 + goodsNum AS goodsNum,
  CAST(goodsNum AS BIGINT) * 1000 + 500 AS goodsSalesNum, mallId * 1000 AS followerNum,
  CAST(CAST(mallId AS DECIMAL(9,0)) + 0.5 AS DECIMAL(10,1)) AS mallStar, reviewNum,
  's' || mallId AS shareInfo_shareTitle, coalesce(replace(optList, '{{"name":"b"}},', ''), '[]') AS optList
FROM dwd_malls_base""".replace("{{", "{").replace("}}", "}")))

_feed("i2_product_categories", "product_categories", "dwd_goods_base", f"""concat(
  '{{"serverTime":', coalesce(cast(salesNum AS STRING), 'null'), ',"crumbOptList":', crumbOptList, ',', {_REGION}, '}}')""",
      ["date", "optId", "siteId", "catId"], with_tables(_GOODS, f"""
SELECT {_BIZ} AS date, TRY_CAST(id AS INT) AS optId, CAST(siteId AS INT) AS siteId, id AS catId FROM (
  SELECT siteId, json_extract_string(list[i], '$.optId') AS id FROM (
    SELECT siteId, from_json(crumbOptList, '["json"]') AS list, unnest(generate_series(1, 5)) AS i FROM dwd_goods_base)
  WHERE i <= len(list)) WHERE TRY_CAST(id AS INT) IS NOT NULL"""))

_PRODUCT = f"""concat('{{"goods":{{"goodsId":', goodsId, ',"goodsName":"',
  CASE WHEN goodsId % 5 = 0 THEN 'Temu' ELSE title END, '","thumbUrl":"', coalesce(thumbUrl, ''), '","catId":', catId,
  ',"isLocalGoods":', goodsId % 2, ',"mallId":"', mallId, '","gallery":', coalesce(gallery, 'null'),
  ',"minOnSalePrice":"', coalesce(CAST(minOnSalePrice AS STRING), 'none'), '"}},"goodsExt":{{"minOnSalePrice":7}},
  "sku":[{{"thumbUrl":"sku', goodsId, '"}}],"formatSkuData":{{"skuInfos":', coalesce(skuList, 'null'),
  '}},"crumbOptList":', crumbOptList, ',"mall":{{"mallData":{{"mallName":"m', mallId, '","goodsSalesNumUnit":["', reviewNum,
  'K","Sold"],"goodsNumUnit":["', reviewNum, ' pcs"]}}}},
  "review":{{"reviewData":{{"similarReview":{{"reviewInfoList":[{{"goodsInfo":{{"goodsName":"', title, '"}}}}]}},
  "mallReview":{{"mallScore":"4.', reviewNum % 10, ' points"}}}}}},', {_REGION}, ',"lang":"en"}}')"""
_feed("i3_product_goods", "product_goods", "dwd_goods_base", _PRODUCT,
      ["goodsId", "siteId", "date", "title", "thumbUrl", "catId", "mallId", "minOnSalePrice", "salesNum", "isOnsale",
       "semiManaged", "gallery", "skuList"], with_tables(_GOODS, f"""
SELECT goodsId, siteId, {_BIZ} AS date, title, coalesce(nullif(thumbUrl, ''), 'sku' || goodsId) AS thumbUrl, catId,
  mallId, coalesce(minOnSalePrice, 7) AS minOnSalePrice, reviewNum * 1000 AS salesNum,
  CAST(json_extract_string(skuList, '$."' || json_keys(skuList)[1] || '".isOnsale') AS BIGINT) AS isOnsale,
  goodsId % 2 = 1 AS semiManaged, gallery, nullif(skuList, '{{}}') AS skuList
FROM dwd_goods_base""".replace("{{", "{").replace("}}", "}")))
_feed("i4_product_malls", "product_malls", "dwd_goods_base", _PRODUCT,
      ["mallId", "siteId", "date", "mallName", "goodsNum", "goodsSalesNum", "mallStar", "semiManaged"],
      with_tables(_GOODS, f"""
SELECT CAST(mallId AS BIGINT) AS mallId, CAST(siteId AS INT) AS siteId, {_BIZ} AS date, 'm' || mallId AS mallName,
  CAST(reviewNum AS INT) AS goodsNum, reviewNum * 1000 AS goodsSalesNum,
  CAST(4 + CAST(reviewNum % 10 AS DECIMAL(9,0)) * 0.1 AS DECIMAL(10,1)) AS mallStar, goodsId % 2 = 1 AS semiManaged
FROM dwd_goods_base"""))

_feed("i5_product_reviews", "product_reviews", "dwd_review_base", f"""concat(
  '{{"lang":"en","review":{{"reviewData":{{"reviewInfoList":[{{"reviewId":"a', reviewId, '","comment":"', comment,
  '","score":', score, ',"list":', coalesce(list, 'null'), '}},{{"comment":"no id"}}],
  "similarReview":{{"reviewInfoList":[{{"review_id":"b', reviewId, '","rating":"', score, '","list":[1]}}]}}}}}},
  "reviewStore":{{"commentList":[],"pageReviewListMap":{{"1":[{{"id":"c', reviewId, '","nickName":"', name,
  '"}}],"2":[]}}}},', {_REGION}, '}}')""",
      ["reviewId", "siteId", "date", "lang", "comment", "score", "list", "name"], with_tables(["dwd_review_base"], f"""
SELECT 'a' || reviewId AS reviewId, siteId, {_BIZ} AS date, 'en' AS lang, comment, score, list, NULL AS name
FROM dwd_review_base
UNION ALL SELECT 'b' || reviewId, siteId, {_BIZ}, 'en', NULL, score, NULL, NULL FROM dwd_review_base
UNION ALL SELECT 'c' || reviewId, siteId, {_BIZ}, 'en', NULL, NULL, NULL, name FROM dwd_review_base"""))

_feed("i6_product_site", "product_site", "dwd_malls_base", f"""concat('{{"lang":"en","serverTime":"', followerNum, '",',
  {_REGION}, '}}')""", ["siteId", "date", "regionId", "regionName", "lang", "selectedLang", "serverTime"],
      with_tables(_MALLS, f"""
SELECT siteId, {_BIZ} AS date, siteId + 200 AS regionId, 'r' || siteId AS regionName, 'en' AS lang,
  'en' AS selectedLang, followerNum AS serverTime FROM dwd_malls_base"""))

_SEARCH = """to_json(named_struct('goodsList', array(
    named_struct('data', named_struct('goodsId', event_id, 'optId', user_id, 'title', event_type,
      'salesNum', concat(user_id, 'K'), 'priceInfo', named_struct('p', 1))),
    named_struct('data', named_struct('goodsId', event_id + 1000000, 'optId', CAST(NULL AS BIGINT), 'title', '',
      'salesNum', '', 'priceInfo', CAST(NULL AS STRUCT<p: INT>)))),
  'pattern', 3, 'localInfo', named_struct('language', 'de', 'region', event_id % 4 + 200),
  'layoutData', named_struct('headerData', named_struct('region', named_struct('regionInfo',
    named_struct('siteId', event_id % 4, 'regionName', concat('r', event_id % 4)))))))"""
_feed("i7_search_categories", "search_categories", None, _SEARCH, ["date", "optId", "siteId", "lang"],
      f"SELECT {_BIZ} AS date, CAST(user_id AS INT) AS optId, CAST(event_id % 4 AS INT) AS siteId, 'de' AS lang FROM events")
_feed("i8_search_goods", "search_goods", None, _SEARCH,
      ["goodsId", "siteId", "date", "title", "salesNum", "priceInfo"], f"""
SELECT event_id AS goodsId, event_id % 4 AS siteId, {_BIZ} AS date, event_type AS title, user_id * 1000 AS salesNum,
  '{{"p":1}}' AS priceInfo FROM events
UNION ALL SELECT event_id + 1000000, event_id % 4, {_BIZ}, '', NULL, NULL FROM events
""".replace("{{", "{").replace("}}", "}"))
_feed("i9_search_site", "search_site", None, _SEARCH, ["siteId", "date", "regionId", "regionName", "lang"], f"""
SELECT CAST(event_id % 4 AS INT) AS siteId, {_BIZ} AS date, CAST(event_id % 4 + 200 AS INT) AS regionId,
  'r' || (event_id % 4) AS regionName, 'de' AS lang FROM events""")

_MORE = """CASE WHEN event_id % 5 = 0 THEN concat('{"siteId":', event_id % 4, ',"data":{"goods_list":[]}}')
  ELSE to_json(named_struct('siteId', event_id % 4, 'lang', 'fr', 'server_time', event_id, 'data', named_struct('goods_list',
  array(named_struct('goods_id', event_id, 'opt_id', user_id, 'title', event_type, 'sales_num', '1,234',
    'comment', named_struct('goods_score', '4.5'), 'image', named_struct('url', concat('i', event_id))))))) END"""
_feed("i10_more_categories", "more_categories", None, _MORE, ["date", "optId", "siteId", "title", "imageUrl", "lang"], f"""
SELECT {_BIZ} AS date, CAST(user_id AS INT) AS optId, CAST(event_id % 4 AS INT) AS siteId, event_type AS title,
  'i' || event_id AS imageUrl, 'fr' AS lang FROM events WHERE event_id % 5 <> 0""")
_feed("i11_more_goods", "more_goods", None, _MORE,
      ["goodsId", "siteId", "date", "title", "salesNum", "goodsScore", "imageUrl"], f"""
SELECT CASE WHEN event_id % 5 <> 0 THEN event_id END AS goodsId, CAST(NULL AS BIGINT) AS siteId, {_BIZ} AS date,
  CASE WHEN event_id % 5 <> 0 THEN event_type END AS title, CASE WHEN event_id % 5 <> 0 THEN 1234 END AS salesNum,
  CASE WHEN event_id % 5 <> 0 THEN CAST(4.5 AS DOUBLE) END AS goodsScore,
  CASE WHEN event_id % 5 <> 0 THEN 'i' || event_id END AS imageUrl FROM events""")

_HISTORY = """concat('{"code":0,"data":{"site":{"id":', siteId, ',"currency":"EUR","cents":', coalesce(CAST(cents AS STRING), 'null'),
  ',"regionId":9},"goods":{"goodsId":"', goodsId, '","mallId":"', mallId, '","goodsName":"', goodsName,
  '","catItems":[{"catId":1,"isLeaf":false},{"catId":', catId, ',"isLeaf":true}],"sku":"[1]","status":', status,
  '},"history":[{"sold":', sold, ',"minPrice":', coalesce(CAST(minPrice AS STRING), 'null'), ',"daySales":"', maxPrice,
  '","createTime":"', date, 'T23:13:41-08:00"},{"goodsId":', goodsId + 1000000, ',"sold":"', sold,
  '.5","createTime":"', date, 'T01:00:00"},{"sold":1}]}}')"""
_HISTORY_COLUMNS = ["goodsId", "siteId", "date", "regionId", "mallId", "goodsName", "catId", "currency", "cents", "status",
                    "sold", "minPrice", "daySales", "skuInfo", "historyCreateTime"]
_HISTORY_ORACLE = """
, r AS (SELECT goodsId, siteId, date, CAST(9 AS BIGINT) AS regionId, mallId, nullif(goodsName, '') AS goodsName, catId,
  'EUR' AS currency, cents, status, '[1]' AS skuInfo, sold, minPrice, maxPrice FROM dwd_external_goods_daily)
SELECT goodsId, siteId, date, regionId, mallId, goodsName, catId, currency, cents, status, sold, minPrice,
  maxPrice AS daySales, skuInfo, CAST(date AS TIMESTAMP) + INTERVAL '23:13:41' HOUR TO SECOND AS historyCreateTime FROM r
UNION ALL
SELECT goodsId + 1000000, siteId, date, regionId, mallId, goodsName, catId, currency, cents, status, NULL, NULL, NULL,
  skuInfo, CAST(date AS TIMESTAMP) + INTERVAL '1' HOUR FROM r
""".replace("INTERVAL '23:13:41' HOUR TO SECOND", "INTERVAL '83621' SECOND")
_feed("i12_external_goods", "external_goods", "dwd_external_goods_daily", _HISTORY, _HISTORY_COLUMNS,
      with_tables(_EXTERNAL, _HISTORY_ORACLE))

# -- tables -----------------------------------------------------------------------------------


def _typed(t, standin: str, table: str) -> DataFrame:
    return quality.enforce_schema(t.clean[standin], TABLES[table])[0]


def _warehouse(t) -> Warehouse:
    return Warehouse(t.spark, scratch(t.spark))


on("k3_jsonl_backfill", lambda t: backfill_lines(_messages(t, None, """CASE event_id % 3 WHEN 0 THEN '   '
  WHEN 1 THEN concat('  {"goodsId": "', user_id, '", "k": ', props, '}  ') ELSE props END""")), """
SELECT CASE WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) END AS key,
  CASE WHEN event_id % 3 = 1 THEN '{"goodsId": "' || user_id || '", "k": ' || props || '}' ELSE props END AS value
FROM events WHERE event_id % 3 <> 0""")


def _k4(t):
    wh, rows = _warehouse(t), _typed(t, "dwd_review_base", "ods_review_raw")
    wh.append_raw(rows, "ods_review_raw", "feed-0")
    wh.append_raw(rows, "ods_review_raw", "feed-1")
    return wh.scan("ods_review_raw").groupBy("date").agg(F.count("*").alias("n"))


on("k4_append_raw", _k4, "SELECT CAST(ts AS DATE) AS date, 2 * count(*) AS n FROM events GROUP BY ALL")


def _k5(t, merge=False):
    wh, rows = _warehouse(t), _typed(t, "dwd_goods_base", "dwd_goods_base")
    wh.upsert_latest(rows, "dwd_goods_base", "feed-0", 1)
    renamed = rows.where("siteId = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    wh.upsert_latest(renamed, "dwd_goods_base", "feed-1", 2)
    if merge:
        wh.compact("dwd_goods_base")
        wh.upsert_latest(renamed, "dwd_goods_base", "feed-1", 2)
    return wh.scan("dwd_goods_base").select("goodsId", "siteId", "date", "title", "salesNum")


_K5 = with_tables(_GOODS, """
SELECT goodsId, siteId, date, CASE WHEN siteId = 0 THEN 'new ' ELSE '' END || title AS title, salesNum
FROM dwd_goods_base""")
on("k5_upsert_latest", _k5, _K5)
on("k5_upsert_merged", lambda t: _k5(t, merge=True), _K5)


def _k5_replayed(t):
    """Old and new rows are merged, then the older batch is replayed: the new rows stay."""
    wh, rows = _warehouse(t), _typed(t, "dwd_goods_base", "dwd_goods_base")
    renamed = rows.where("siteId = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    wh.upsert_latest(rows, "dwd_goods_base", 7, 1, writer="feedA")
    wh.upsert_latest(renamed, "dwd_goods_base", 3, 2, writer="feedB")
    wh.compact("dwd_goods_base")
    wh.upsert_latest(rows, "dwd_goods_base", 7, 1, writer="feedA")
    return wh.scan("dwd_goods_base").select("goodsId", "siteId", "date", "title", "salesNum")


def _k5_writers(t):
    """Two writers use the same batch id; neither replaces the other's rows."""
    wh, rows = _warehouse(t), _typed(t, "dwd_goods_base", "dwd_goods_base")
    renamed = rows.where("siteId = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    wh.upsert_latest(renamed, "dwd_goods_base", 5, 2, writer="feedB")
    wh.upsert_latest(rows, "dwd_goods_base", 5, 1, writer="feedA")
    return wh.scan("dwd_goods_base").select("goodsId", "siteId", "date", "title", "salesNum")


on("k5_replayed_after_merge", _k5_replayed, _K5)
on("k5_two_writers", _k5_writers, _K5)


def _k6(t):
    wh = _warehouse(t)
    wh.append_raw(_typed(t, "dwd_review_base", "ods_review_raw"), "ods_review_raw", "feed-0")
    files = wh.scan("ods_review_raw").select("date", F.input_file_name().alias("file"))
    return files.groupBy("date").agg(
        F.count("*").alias("n"), (F.count_distinct("file") <= 4).alias("few_files"))


on("k6_day_layout", _k6, "SELECT CAST(ts AS DATE) AS date, count(*) AS n, true AS few_files FROM events GROUP BY ALL")


def _k7(t):
    wh, rows = _warehouse(t), _typed(t, "dwd_review_base", "ods_review_raw")
    for _ in range(2):  # the batch, and its replay after a failure
        wh.append_raw(rows, "ods_review_raw", "feed-0")
    return wh.scan("ods_review_raw").select("reviewId", "siteId", "date")


on("k7_replayed_batch", _k7, """
SELECT CAST(event_id AS VARCHAR) AS reviewId, CAST(event_id % 4 AS INT) AS siteId, CAST(ts AS DATE) AS date FROM events""")

_LOADED = """CASE WHEN event_id % 6 = 0 THEN event_type WHEN event_id % 6 = 1 THEN NULL
  ELSE CAST(user_id AS STRING) END"""


def _k8(t):
    rows = t["events"].select(F.expr(_LOADED).alias("siteId"), F.col("user_id").cast("string").alias("regionId"),
                              F.to_date("ts").alias("date"), F.col("props").alias("supportedLangList"))
    good, rejects = quality.enforce_schema(rows, TABLES["dwd_site_base"])
    return good.select(F.lit("loaded").alias("state"), "siteId", "supportedLangList").unionByName(
        rejects.select(F.concat_ws(",", "reasons").alias("state"), F.lit(None).cast("int").alias("siteId"),
                       F.lit(None).cast("string").alias("supportedLangList")))


on("k8_enforce_schema", _k8, """
SELECT CASE WHEN event_id % 6 < 2 THEN 'siteId' ELSE 'loaded' END AS state,
  CASE WHEN event_id % 6 >= 2 THEN CAST(user_id AS INT) END AS siteId,
  CASE WHEN event_id % 6 >= 2 THEN props END AS supportedLangList FROM events""")
# An object with a repeated key is JSON, and stored as it came; text that is none becomes a JSON string.
on("k8_repeated_keys", lambda t: t["events"].select("event_id", clean.to_json_text(F.expr("""CASE event_id % 4
  WHEN 0 THEN concat('{"a":', user_id, ',"a":[2]}') WHEN 1 THEN concat('[{"b":{"c":1,"c":', user_id, '}}]')
  WHEN 2 THEN '{"a":1,"a":2' ELSE '{"a":1,"a":1},"b":{}' END""")).alias("stored")), """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"a":' || user_id || ',"a":[2]}' WHEN 1 THEN '[{"b":{"c":1,"c":' || user_id || '}}]'
  WHEN 2 THEN '"{\\"a\\":1,\\"a\\":2"' ELSE '"{\\"a\\":1,\\"a\\":1},\\"b\\":{}"' END AS stored FROM events""")
on("k9_write_audit", lambda t: quality.write_audit(
    t["events"].select(F.col("user_id").alias("goodsId"), F.expr("nullif(event_id % 4, 0)").alias("siteId"),
                       F.to_date("ts").alias("date")), "clean", "dwd_goods_base", TABLES["dwd_goods_base"].keys, 7),
   """
SELECT 'clean' AS layer, 'dwd_goods_base' AS "table", '7' AS batch_id, key, count(*) AS rows FROM (
  SELECT 'goodsId=' || user_id || ',siteId=' || coalesce(CAST(nullif(event_id % 4, 0) AS VARCHAR), 'null')
    || ',date=' || CAST(ts AS DATE) AS key FROM events) GROUP BY key""")
on("k10_row_to_json", lambda t: quality.row_to_json(
    t["events"].select("event_id", "props", F.expr("nullif(event_type, 'click')").alias("kind"), "user_id"),
    exclude=("user_id",), json_columns=("props",)), """
SELECT '{"event_id":' || event_id || ',"props":' || props || ',"kind":'
  || coalesce('"' || nullif(event_type, 'click') || '"', 'null') || '}' AS json FROM events""")


def _k11(t):
    wh = _warehouse(t)
    wh.upsert_latest(_typed(t, "dwd_goods_base", "dwd_goods_base"), "dwd_goods_base", "feed-0", 1)
    return wh.scan("dwd_goods_base", [F.lit(BIZ_DATE).cast("date")]).select("goodsId", "siteId", "date", "title")


on("k11_table_scan", _k11, with_tables(_GOODS, f"SELECT goodsId, siteId, date, title FROM dwd_goods_base WHERE date = {_BIZ}"))


def _k12(t):
    texts = t["events"].select(
        "event_id", F.concat("user_id", F.lit("K")).alias("goodsNum"), F.lit("2,082").alias("reviewNum"),
        F.lit("4.80 points").alias("mallStar"), F.expr("CASE event_id % 3 WHEN 0 THEN 'yes' WHEN 1 THEN '0' ELSE '5' END")
        .alias("isExpire"), F.lit("x").alias("lastUpdateTime"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("siteId", "appCode", "goodsSalesNum", "followerNum", "marketPriceType", "serverTime", "mallReviewLabelShow")])
    rows = quality.coerce_mall_row(texts)
    return rows.select("event_id", "goodsNum", "reviewNum", F.col("mallStar").cast("decimal(10,1)").alias("mallStar"),
                       "isExpire", "siteId", F.lit("lastUpdateTime" in rows.columns).alias("kept"))


on("k12_coerce_mall_row", _k12, """
SELECT event_id, user_id * 1000 AS goodsNum, CAST(2082 AS BIGINT) AS reviewNum, CAST(4.8 AS DECIMAL(10,1)) AS mallStar,
  CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS isExpire, CAST(NULL AS BIGINT) AS siteId, false AS kept
FROM events""")

# -- streams ----------------------------------------------------------------------------------


def _streamed(t) -> Warehouse:
    """Messages written as lines, read as a bounded stream into both tables of the external feed."""
    base = scratch(t.spark)
    _messages(t, "dwd_external_goods_daily", _HISTORY).write.text(f"{base}/in")
    wh = Warehouse(t.spark, f"{base}/tables", files_per_day=2)
    lines = read_source(t.spark, "lines", f"{base}/in")
    run_feed(lines, "external_goods", wh, f"{base}/checkpoint", bounded=True, run_date=BIZ_DATE,
             audit="counts").awaitTermination()
    return wh


on("x1_streamed_feed", lambda t: _streamed(t).scan("dwd_external_goods_daily").selectExpr(*_HISTORY_COLUMNS),
   with_tables(_EXTERNAL, _HISTORY_ORACLE))
on("x2_raw_and_clean", lambda t: (lambda wh: wh.scan("ods_external_goods_raw").groupBy("siteId").agg(
    F.count("*").alias("n"), F.sum(F.get(F.split("history", "createTime"), F.lit(2)).isNotNull().cast("int")).alias("two")))(
    _streamed(t)), with_tables(_EXTERNAL, """
SELECT siteId, count(*) AS n, CAST(count(*) AS BIGINT) AS two FROM dwd_external_goods_daily GROUP BY siteId"""))


def _launched(t) -> DataFrame:
    """Store pages as files of their own, read by a feed that is started from arguments; the raw rows and the audit."""
    base = scratch(t.spark)
    table, expr = MESSAGES["i1_store_malls"]
    _messages(t, table, expr).write.option("maxRecordsPerFile", 1).text(f"{base}/in")
    wh = Warehouse(t.spark, f"{base}/tables", files_per_day=2)
    launch_feed(t.spark, "store_malls", ["--local", "yes", f"--file={base}/in"], wh, f"{base}/checkpoint",
                run_date=BIZ_DATE, audit="counts", interval="1 second").awaitTermination()
    audit = t.spark.read.parquet(f"{wh.root}/_audit/counts").where("layer = 'raw'")
    rows = wh.scan("ods_malls_raw").groupBy(F.col("siteId").cast("int").alias("siteId")).agg(F.count("*").alias("n"))
    return rows.unionByName(audit.select(F.lit(-1).alias("siteId"), F.col("rows").alias("n"))
                            .groupBy("siteId").agg(F.sum("n").alias("n")))


on("x5_launched_from_arguments", _launched, with_tables(_MALLS, """
SELECT siteId, count(*) AS n FROM dwd_malls_base GROUP BY siteId
UNION ALL SELECT -1, count(*) FROM dwd_malls_base"""))
