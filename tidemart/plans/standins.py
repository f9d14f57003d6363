"""Clean tables derived from the test tables, in SQL that Spark and DuckDB both run.

The test tables hold no crawled pages, so entities are taken from ``events``: a user is a product
or a store, an event's day is its day, and the JSON columns are written from its numbers. Every
table is derived from all events; the shapes cover lists, bare objects, empty and missing values,
and breadcrumbs of 0 to 5 levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BIZ_DATE = "2024-01-15"

_KEYED = """
  SELECT user_id AS goodsId, event_id % 4 AS siteId, CAST(ts AS DATE) AS date,
         count(*) AS n, min(event_id) AS lo, max(event_id) AS hi
  FROM {events} GROUP BY user_id, event_id % 4, CAST(ts AS DATE)
"""

DWD_GOODS = """
SELECT goodsId, siteId, date,
  CAST(goodsId % 9 AS STRING) AS mallId,
  CASE WHEN lo % 13 = 0 THEN NULL ELSE hi % 12 END AS optId,
  hi % 30 AS catId,
  'item ' || CAST(goodsId AS STRING) || '/' || CAST(hi AS STRING) AS title,
  CASE WHEN lo % 3 = 0 THEN '' WHEN lo % 3 = 1 THEN NULL ELSE 't' || CAST(lo AS STRING) END AS thumbUrl,
  CASE WHEN hi % 3 = 0 THEN '' WHEN hi % 3 = 1 THEN NULL ELSE 'i' || CAST(hi AS STRING) END AS imageUrl,
  CASE WHEN hi % 2 = 0 THEN '{{"url":"m' || CAST(hi AS STRING) || '"}}' END AS image,
  CASE WHEN lo % 4 = 0 THEN NULL
       WHEN lo % 4 = 1 THEN '{{"url":"g' || CAST(lo AS STRING) || '","priority":1}}'
       ELSE '[{{"url":"g' || CAST(lo % 7 AS STRING) || '","priority":' || CAST(hi % 5 AS STRING)
         || '}},{{"url":"g' || CAST(hi % 7 AS STRING) || '","priority":' || CAST(lo % 5 AS STRING)
         || '}},{{"url":"","priority":0}},{{"url":"g1","priority":3}}]' END AS gallery,
  CASE WHEN hi % 5 = 0 THEN NULL WHEN hi % 5 = 1 THEN '{{}}'
       ELSE '{{"s' || CAST(lo AS STRING) || '":{{"stockQuantity":' || CAST(lo % 20 AS STRING) || ',"isOnsale":'
         || CAST(lo % 2 AS STRING) || '}},"t":{{"stockQuantity":' || CAST(hi % 9 AS STRING) || ',"isOnsale":'
         || CAST(hi % 2 AS STRING) || '}},"u":{{"price":1}}}}' END AS skuList,
  CASE WHEN lo % 5 = 0 THEN '[]'
       WHEN lo % 5 = 1 THEN '[{{"optId":' || CAST(hi % 12 AS STRING) || '}}]'
       WHEN lo % 5 = 2 THEN '[{{"optId":' || CAST(hi % 12 AS STRING) || '}},{{"optId":' || CAST(lo % 12 AS STRING)
         || '}},{{"optId":"' || CAST(goodsId % 12 AS STRING) || '"}}]'
       WHEN lo % 5 = 3 THEN '[{{"optId":"x"}},{{"name":1}}]'
       ELSE '[{{"optId":1}},{{"optId":' || CAST(hi % 6 AS STRING) || '}},{{"optId":2}},{{"optId":3}},{{"optId":4}}]'
       END AS crumbOptList,
  CASE WHEN hi % 17 = 0 THEN NULL ELSE n * 10 + lo % 10 END AS salesNum,
  CASE WHEN lo % 6 = 0 THEN NULL ELSE 100 + hi % 900 END AS minOnSalePrice,
  CASE WHEN lo % 12 = 0 THEN NULL ELSE 200 + hi % 900 END AS maxOnSalePrice,
  n AS reviewNum,
  CASE WHEN lo % 4 = 0 THEN NULL ELSE hi % 2 END AS isOnsale,
  CAST(CAST(hi % 50 AS DOUBLE) / CAST(8 AS DOUBLE) AS DOUBLE) AS goodsScore,
  'USD' AS selectedCurrency,
  lo % 11 = 0 AS adultGoods,
  CASE WHEN hi % 7 = 0 THEN NULL ELSE hi % 3 = 0 END AS semiManaged,
  CASE WHEN lo % 2 = 0 THEN '{{"v":' || CAST(lo AS STRING) || '}}' END AS video,
  '[{{"p":' || CAST(n AS STRING) || '}}]' AS goodsProperty
FROM (KEYED) k
""".replace("KEYED", _KEYED)

DWD_MALLS = """
SELECT mallId, siteId, date,
  'mall ' || CAST(mallId AS STRING) || '/' || CAST(hi AS STRING) AS mallName,
  'logo' || CAST(lo AS STRING) AS mallLogo,
  CASE WHEN hi % 3 = 0 THEN true WHEN hi % 3 = 1 THEN false END AS semiManaged,
  CASE WHEN lo % 8 = 0 THEN NULL
       ELSE '[{{"optId":' || CAST(hi % 12 AS STRING) || CASE WHEN lo % 7 = 6 THEN '.5' ELSE '' END
         || ',"optName":"a"}},{{"optId":"' || CAST(lo % 12 AS STRING)
         || '","x":{{"optId":5}}}},{{"name":"b"}},{{"optId":' || CAST(n % 12 AS STRING) || '}}]' END AS optList,
  CAST(n AS INT) AS goodsNum, n * 100 AS goodsSalesNum,
  CAST(CAST(hi % 50 AS DECIMAL(10,1)) AS DECIMAL(10,1)) AS mallStar,
  '[{{"score":5,"num":' || CAST(n AS STRING) || '}}]' AS scoreNumInfoList,
  CAST(lo % 1000 AS INT) AS reviewNum, hi AS followerNum,
  CAST(CAST(date AS STRING) || ' 08:30:00' AS TIMESTAMP) AS lastUpdateTime
FROM (
  SELECT user_id % 9 AS mallId, CAST(event_id % 4 AS INT) AS siteId, CAST(ts AS DATE) AS date,
         count(*) AS n, min(event_id) AS lo, max(event_id) AS hi
  FROM {events} GROUP BY user_id % 9, CAST(event_id % 4 AS INT), CAST(ts AS DATE)
) k
"""

DWD_CATEGORY = """
SELECT date, CAST(optId AS INT) AS optId, siteId,
  CAST(hi % 6 AS INT) AS parentId, event_type || CAST(hi AS STRING) AS optName,
  'img' || CAST(lo AS STRING) AS imageUrl, 'seo' || CAST(hi AS STRING) AS seoLinkUrl,
  'link' || CAST(n AS STRING) AS linkUrl, 'share' || CAST(lo AS STRING) AS shareUrl,
  CAST(n % 3 AS INT) AS optType, CAST(lo % 100 AS INT) AS priority,
  CASE WHEN hi % 4 = 0 THEN NULL ELSE hi % 2 = 0 END AS isFeatured
FROM (
  SELECT user_id % 14 AS optId, CAST(event_id % 4 AS INT) AS siteId, CAST(ts AS DATE) AS date,
         max(event_type) AS event_type, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi
  FROM {events} GROUP BY user_id % 14, CAST(event_id % 4 AS INT), CAST(ts AS DATE)
) k
"""

DWD_REVIEW = """
SELECT CAST(event_id AS STRING) AS reviewId, CAST(event_id % 4 AS INT) AS siteId, CAST(ts AS DATE) AS date,
  CAST(user_id AS STRING) AS goodsId, 'k' || CAST(event_id % 50 AS STRING) AS skuId,
  CASE WHEN event_id % 5 = 0 THEN 'zh' WHEN event_id % 5 = 1 THEN 'zh-CN' WHEN event_id % 5 = 2 THEN 'zh-Hans'
       WHEN event_id % 5 = 3 THEN 'en' END AS lang,
  event_type || ' ' || CAST(event_id AS STRING) AS comment,
  'n' || CAST(user_id AS STRING) AS name, 'a' || CAST(user_id AS STRING) AS avatar,
  'p' || CAST(user_id AS STRING) AS profileLinkUrl,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE 1703980800 + (event_id * 7919) % 2764800 END AS time,
  CAST(event_id % 6 AS INT) AS score,
  '[{{"spec_key":"c"}}]' AS specs,
  CASE WHEN event_id % 3 = 0 THEN '[{{"url":"' || CAST(event_id AS STRING) || '"}}]' END AS list,
  CASE WHEN event_id % 2 = 0 THEN '["' || CAST(event_id AS STRING) || '"]' END AS pictures,
  CASE WHEN event_id % 3 = 1 THEN '{{"translateComment":"tr ' || CAST(event_id AS STRING) || '"}}' END AS reviewLang
FROM {events}
"""

DWD_EXTERNAL = """
SELECT goodsId, CAST(siteId AS INT) AS siteId, date, CAST(goodsId % 9 AS STRING) AS mallId,
  CASE WHEN lo % 3 = 0 THEN '' ELSE 'name ' || CAST(lo AS STRING) END AS goodsName,
  CASE WHEN lo % 4 = 0 THEN NULL ELSE 'cn ' || CAST(lo AS STRING) END AS goodsNameCn,
  CASE WHEN hi % 3 = 0 THEN NULL ELSE 'en ' || CAST(hi AS STRING) END AS goodsNameEn,
  CASE WHEN hi % 2 = 0 THEN '' ELSE 't' || CAST(hi AS STRING) END AS thumbnail,
  CASE WHEN lo % 5 = 0 THEN NULL ELSE 'c' || CAST(lo AS STRING) END AS thumbnailCn,
  hi % 12 AS optId, lo % 30 AS catId, n AS sold,
  CASE WHEN lo % 7 = 0 THEN NULL ELSE hi % 3 END AS quantity, n + 1 AS reviewNum, 'USD' AS currency,
  CAST(CASE WHEN lo % 5 = 0 THEN NULL WHEN lo % 5 = 1 THEN 1000 ELSE 100 END AS INT) AS cents,
  CAST(hi % 2 AS INT) AS status,
  CASE WHEN lo % 9 = 0 THEN NULL ELSE CAST(CAST(hi * 37 AS DECIMAL(16,0)) * 0.0005 AS DECIMAL(20,4)) END AS minPrice,
  CAST(CAST(hi * 41 AS DECIMAL(16,0)) * 0.0005 AS DECIMAL(20,4)) AS maxPrice,
  CAST(CAST(hi % 50 AS DECIMAL(9,0)) * 0.25 AS DECIMAL(10,2)) AS goodsScore,
  CASE WHEN lo % 6 = 0 THEN NULL ELSE CAST(CAST(CAST(date AS DATE) - INTERVAL '2' DAY AS DATE) AS TIMESTAMP) END
    AS onSaleTime,
  '[{{"id":' || CAST(lo AS STRING) || '}}]' AS skuInfo
FROM (KEYED) k
""".replace("KEYED", _KEYED)

# Rows written to the daily tables earlier: keys with a purchase, dated around their first event.
DWS_GOODS = """
SELECT user_id AS goodsId, event_id % 4 AS siteId, min(CAST(ts AS DATE)) AS firstAddTime,
       CASE WHEN user_id % 3 = 0 THEN NULL ELSE max(CAST(ts AS DATE)) END AS addToRegionTime
FROM {events} WHERE event_type = 'purchase' GROUP BY user_id, event_id % 4
"""
DWS_MALLS = """
SELECT user_id % 9 AS mallId, CAST(event_id % 4 AS INT) AS siteId,
       CAST(min(CAST(ts AS DATE)) - INTERVAL '3' DAY AS DATE) AS addToRegionTime
FROM {events} WHERE event_type = 'purchase' GROUP BY user_id % 9, CAST(event_id % 4 AS INT)
"""

STANDINS = {
    "dwd_goods_base": DWD_GOODS,
    "dwd_malls_base": DWD_MALLS,
    "dwd_category_base": DWD_CATEGORY,
    "dwd_review_base": DWD_REVIEW,
    "dwd_external_goods_daily": DWD_EXTERNAL,
    "dws_goods_daily": DWS_GOODS,
    "dws_malls_daily": DWS_MALLS,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL; ``{table}`` names a test table."""
    names = [n for n in ("events", "orders", "lineitem", "part", "supplier", "customer", "nation", "region",
                         "documents", "conversations", "pages", "labels") if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: load(spark, sf_dir, n) for n in names})


class CleanTables(dict):
    """Stand-in tables by name, derived on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._source = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = derived(*self._source, STANDINS[name])
        return self[name]


def with_tables(names, body: str) -> str:
    """DuckDB text: the stand-in tables as CTEs, then ``body``."""
    plain = dict.fromkeys(("events", "orders", "lineitem", "part", "supplier", "customer", "nation", "region",
                           "documents", "conversations", "pages", "labels"))
    ctes = ", ".join(f"{n} AS ({STANDINS[n].format(**{k: k for k in plain})})" for n in names)
    head = f"WITH {ctes}" if ctes else "WITH _none AS (SELECT 1)"
    return head + body
