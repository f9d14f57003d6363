"""The ten daily builds on the stand-in tables, each with a row-by-day reference in DuckDB SQL."""

from __future__ import annotations

from tidemart.plans import gold
from tidemart.plans.registry import query
from tidemart.plans.standins import BIZ_DATE, CleanTables, with_tables

_BIZ = f"DATE '{BIZ_DATE}'"


def _build(builder, biz_date=None):
    return lambda spark, sf_dir: builder(CleanTables(spark, sf_dir), biz_date)


# One row per product row: ordered image list, stock sum and highest on-sale flag.
_GOODS_SIDE = """
, pics AS (
  SELECT goodsId, siteId, date, url, min(priority) AS priority FROM (
    SELECT goodsId, siteId, date, json_extract_string(e, '$.url') AS url,
           CAST(json_extract_string(e, '$.priority') AS INT) AS priority
    FROM (SELECT goodsId, siteId, date, unnest(CASE WHEN gallery LIKE '[%' THEN from_json(gallery, '["json"]')
            ELSE [CAST(gallery AS JSON)] END) AS e FROM dwd_goods_base WHERE gallery IS NOT NULL)
  ) WHERE url <> '' GROUP BY goodsId, siteId, date, url
), pic_lists AS (
  SELECT goodsId, siteId, date, '[' || string_agg('"' || url || '"', ',' ORDER BY priority, url) || ']' AS pics
  FROM pics GROUP BY goodsId, siteId, date
), stock AS (
  SELECT goodsId, siteId, date, CAST(sum(q) AS BIGINT) AS quantity, max(o) AS on_sale FROM (
    SELECT goodsId, siteId, date,
      coalesce(CAST(json_extract_string(skuList, '$."' || k || '".stockQuantity') AS BIGINT), 0) AS q,
      coalesce(CAST(json_extract_string(skuList, '$."' || k || '".isOnsale') AS BIGINT), 0) AS o
    FROM (SELECT goodsId, siteId, date, skuList, unnest(json_keys(skuList)) AS k FROM dwd_goods_base
          WHERE skuList IS NOT NULL)
  ) GROUP BY goodsId, siteId, date
), first_review AS (
  SELECT goodsId, siteId, CAST(to_timestamp(time) AT TIME ZONE 'UTC' AS DATE) AS day FROM dwd_review_base
  WHERE time IS NOT NULL
)
"""


def _goods_columns(image_order: str) -> str:
    url = "nullif(json_extract_string(g.image, '$.url'), '')"
    thumb, image = "nullif(g.thumbUrl, '')", "nullif(g.imageUrl, '')"
    main = ", ".join({"thumb": [thumb, image], "image": [image, thumb]}[image_order])
    single = f"coalesce({image}, {thumb}, {url})"
    return f"""
  g.title AS goodsTitleEnglish, g.title AS goodsTitleChinese, g.mallId,
  coalesce({main}, {url}) AS mainImageUrl, g.thumbUrl,
  coalesce(p.pics, CASE WHEN {single} IS NOT NULL THEN '["' || {single} || '"]' ELSE '[]' END) AS carouselImageUrls,
  g.optId, g.catId, g.adultGoods AS isAdultGoods, g.video AS videoInfo, g.goodsProperty AS propertyList,
  g.salesNum, g.selectedCurrency AS currency, g.minOnSalePrice, g.maxOnSalePrice, g.goodsScore AS score,
  g.reviewNum,
  CAST(CASE WHEN coalesce(g.isOnsale, s.on_sale, 0) = 1 AND coalesce(s.quantity, 0) > 0 THEN 0 ELSE 2 END AS BIGINT)
    AS stockStatus,
  coalesce(s.quantity, 0) AS stockQuantity, g.skuList AS skuInfoList"""


query("g1_goods_daily_increment", _build(gold.build_goods_daily, BIZ_DATE), with_tables(
    ["dwd_goods_base", "dwd_review_base", "dws_goods_daily"], _GOODS_SIDE + f"""
, firsts AS (SELECT goodsId, siteId, min(date) AS collected FROM dwd_goods_base GROUP BY ALL)
, reviewed AS (SELECT goodsId, siteId, min(day) AS reviewed FROM first_review GROUP BY ALL)
, kept AS (SELECT goodsId, siteId, min(firstAddTime) AS f, min(addToRegionTime) AS r FROM dws_goods_daily GROUP BY ALL)
SELECT g.goodsId, g.siteId, g.date, {_goods_columns('thumb')},
  coalesce(least(k.r, f.collected, v.reviewed), {_BIZ}) AS addToRegionTime,
  coalesce(k.f, f.collected, g.date) AS firstAddTime, g.date AS lastUpdateTime
FROM dwd_goods_base g
LEFT JOIN pic_lists p USING (goodsId, siteId, date) LEFT JOIN stock s USING (goodsId, siteId, date)
LEFT JOIN firsts f ON f.goodsId = g.goodsId AND f.siteId = g.siteId
LEFT JOIN reviewed v ON v.goodsId = CAST(g.goodsId AS VARCHAR) AND v.siteId = g.siteId
LEFT JOIN kept k ON k.goodsId = g.goodsId AND k.siteId = g.siteId
WHERE g.date = {_BIZ}"""))

query("g2_goods_daily_rebuild", _build(gold.build_goods_daily), with_tables(
    ["dwd_goods_base", "dwd_review_base"], _GOODS_SIDE + f"""
, days AS (SELECT DISTINCT date AS stat_date FROM dwd_goods_base)
, snaps AS (
  SELECT b.*, d.stat_date, min(b.date) OVER (PARTITION BY b.goodsId, b.siteId, d.stat_date) AS collected
  FROM dwd_goods_base b JOIN days d ON b.date <= d.stat_date
  QUALIFY row_number() OVER (PARTITION BY b.goodsId, b.siteId, d.stat_date ORDER BY b.date DESC) = 1
), reviewed AS (
  SELECT r.goodsId, r.siteId, d.stat_date, min(r.day) AS reviewed
  FROM first_review r JOIN days d ON r.day <= d.stat_date GROUP BY ALL
)
SELECT g.goodsId, g.siteId, g.stat_date AS date, {_goods_columns('image')},
  least(g.collected, v.reviewed) AS addToRegionTime, g.collected AS firstAddTime, g.date AS lastUpdateTime
FROM snaps g
LEFT JOIN pic_lists p ON p.goodsId = g.goodsId AND p.siteId = g.siteId AND p.date = g.date
LEFT JOIN stock s ON s.goodsId = g.goodsId AND s.siteId = g.siteId AND s.date = g.date
LEFT JOIN reviewed v ON v.goodsId = CAST(g.goodsId AS VARCHAR) AND v.siteId = g.siteId AND v.stat_date = g.stat_date
"""))

_EXTERNAL_COLUMNS = """
  coalesce(nullif(g.goodsNameEn, ''), nullif(g.goodsName, ''), nullif(g.goodsNameCn, '')) AS goodsTitleEnglish,
  coalesce(nullif(g.goodsNameCn, ''), nullif(g.goodsName, ''), nullif(g.goodsNameEn, '')) AS goodsTitleChinese,
  g.mallId, coalesce(nullif(g.thumbnail, ''), nullif(g.thumbnailCn, '')) AS mainImageUrl, g.thumbnail AS thumbUrl,
  coalesce('["' || coalesce(nullif(g.thumbnail, ''), nullif(g.thumbnailCn, '')) || '"]', '[]') AS carouselImageUrls,
  g.optId, g.catId, CAST(NULL AS BOOLEAN) AS isAdultGoods, CAST(NULL AS VARCHAR) AS videoInfo,
  CAST(NULL AS VARCHAR) AS propertyList, g.sold AS salesNum, g.currency,
  CAST(round(g.minPrice * coalesce(g.cents, 100), 0) AS BIGINT) AS minOnSalePrice,
  CAST(round(g.maxPrice * coalesce(g.cents, 100), 0) AS BIGINT) AS maxOnSalePrice,
  CAST(g.goodsScore AS DOUBLE) AS score, g.reviewNum,
  CAST(CASE WHEN coalesce(g.status, 0) = 1 AND coalesce(g.quantity, 0) > 0 THEN 0 ELSE 2 END AS BIGINT) AS stockStatus,
  g.quantity AS stockQuantity, g.skuInfo AS skuInfoList"""

query("g3_external_goods_daily_increment", _build(gold.build_external_goods_daily, BIZ_DATE), with_tables(
    ["dwd_external_goods_daily", "dws_goods_daily"], f"""
, firsts AS (SELECT goodsId, siteId, min(date) AS collected, min(CAST(onSaleTime AS DATE)) AS on_sale
             FROM dwd_external_goods_daily GROUP BY ALL)
, kept AS (SELECT goodsId, siteId, min(firstAddTime) AS f, min(addToRegionTime) AS r FROM dws_goods_daily GROUP BY ALL)
SELECT g.goodsId, CAST(g.siteId AS BIGINT) AS siteId, g.date, {_EXTERNAL_COLUMNS},
  coalesce(least(k.r, coalesce(CAST(g.onSaleTime AS DATE), f.on_sale, f.collected)), g.date) AS addToRegionTime,
  coalesce(least(k.f, f.collected), g.date) AS firstAddTime, g.date AS lastUpdateTime
FROM dwd_external_goods_daily g
LEFT JOIN firsts f ON f.goodsId = g.goodsId AND f.siteId = g.siteId
LEFT JOIN kept k ON k.goodsId = g.goodsId AND k.siteId = g.siteId
WHERE g.date = {_BIZ}"""))

query("g4_external_goods_daily_rebuild", _build(gold.build_external_goods_daily), with_tables(
    ["dwd_external_goods_daily"], f"""
, days AS (SELECT DISTINCT date AS stat_date FROM dwd_external_goods_daily)
, snaps AS (
  SELECT b.*, d.stat_date,
    min(b.date) OVER (PARTITION BY b.goodsId, b.siteId, d.stat_date) AS collected,
    min(CAST(b.onSaleTime AS DATE)) OVER (PARTITION BY b.goodsId, b.siteId, d.stat_date) AS first_on_sale
  FROM dwd_external_goods_daily b JOIN days d ON b.date <= d.stat_date
  QUALIFY row_number() OVER (PARTITION BY b.goodsId, b.siteId, d.stat_date ORDER BY b.date DESC) = 1
)
SELECT g.goodsId, CAST(g.siteId AS BIGINT) AS siteId, g.stat_date AS date, {_EXTERNAL_COLUMNS},
  coalesce(CAST(g.onSaleTime AS DATE), g.first_on_sale, g.collected) AS addToRegionTime,
  g.collected AS firstAddTime, g.date AS lastUpdateTime
FROM snaps g"""))

_MALL_COLUMNS = """
  m.mallName, m.mallLogo AS mallLogoUrl, CAST(CASE WHEN m.semiManaged THEN 1 ELSE 0 END AS INT) AS mallType,
  m.optList AS categoryList, m.goodsNum, CAST(m.goodsSalesNum AS INT) AS goodsSalesNum,
  coalesce(s.earned, 0) AS goodsSalesPrice, m.mallStar, m.scoreNumInfoList AS scorePercentInfo, m.reviewNum,
  m.followerNum, m.lastUpdateTime"""
_MALL_SALES = """
, sales AS (
  SELECT mallId, siteId, date,
    CAST(sum(coalesce(salesNum, 0) * coalesce(minOnSalePrice, maxOnSalePrice, 0)) AS BIGINT) AS earned
  FROM dwd_goods_base GROUP BY ALL
)
"""

query("g5_malls_daily_increment", _build(gold.build_malls_daily, BIZ_DATE), with_tables(
    ["dwd_goods_base", "dwd_malls_base", "dws_malls_daily"], _MALL_SALES + f"""
, firsts AS (SELECT mallId, siteId, min(date) AS collected FROM dwd_malls_base GROUP BY ALL)
, kept AS (SELECT mallId, siteId, min(addToRegionTime) AS r FROM dws_malls_daily GROUP BY ALL)
SELECT m.mallId, m.siteId, m.date, {_MALL_COLUMNS}, coalesce(least(k.r, f.collected), {_BIZ}) AS addToRegionTime
FROM dwd_malls_base m
LEFT JOIN sales s ON s.mallId = CAST(m.mallId AS VARCHAR) AND s.siteId = m.siteId AND s.date = m.date
LEFT JOIN firsts f ON f.mallId = m.mallId AND f.siteId = m.siteId
LEFT JOIN kept k ON k.mallId = m.mallId AND k.siteId = m.siteId
WHERE m.date = {_BIZ}"""))

query("g6_malls_daily_rebuild", _build(gold.build_malls_daily), with_tables(
    ["dwd_goods_base", "dwd_malls_base"], _MALL_SALES + f"""
SELECT m.mallId, m.siteId, m.date, {_MALL_COLUMNS}, m.date AS addToRegionTime
FROM dwd_malls_base m
LEFT JOIN sales s ON s.mallId = CAST(m.mallId AS VARCHAR) AND s.siteId = m.siteId AND s.date = m.date"""))

# Path rows: the first three breadcrumbs that have an id, else the product's own category.
_PATHS = """
, crumbs AS (
  SELECT goodsId, siteId, date, salesNum, minOnSalePrice, semiManaged, optId AS own,
    [json_extract_string(crumbOptList, '$[0].optId'), json_extract_string(crumbOptList, '$[1].optId'),
     json_extract_string(crumbOptList, '$[2].optId')] AS ids
  FROM dwd_goods_base
), paths AS (
  SELECT DISTINCT goodsId, siteId, date, TRY_CAST(id AS INT) AS optId, salesNum, minOnSalePrice, semiManaged
  FROM (SELECT *, unnest(ids) AS id FROM crumbs) WHERE TRY_CAST(id AS INT) IS NOT NULL
  UNION
  SELECT goodsId, siteId, date, CAST(own AS INT), salesNum, minOnSalePrice, semiManaged FROM crumbs
  WHERE coalesce(ids[1], ids[2], ids[3]) IS NULL AND own IS NOT NULL
), listed AS (
  SELECT DISTINCT mallId, siteId, date, CAST(json_extract_string(e, '$.optId') AS INT) AS optId
  FROM (SELECT mallId, siteId, date, unnest(from_json(optList, '["json"]')) AS e FROM dwd_malls_base
        WHERE optList IS NOT NULL)
  WHERE json_type(e, '$.optId') IN ('UBIGINT', 'BIGINT')
)
"""
_CATEGORY_COLUMNS = """
  b.parentId, b.optName AS optNameEnglish, b.optName AS optNameChinese, b.imageUrl, b.seoLinkUrl, b.linkUrl,
  b.shareUrl, b.optType, coalesce(b.isFeatured, false) AS isFeatured, b.priority AS rank,
  coalesce(m.goodsNum, 0) AS goodsNum, CAST(coalesce(m.total_sold, 0) AS BIGINT) AS totalSalesVolume,
  CAST(coalesce(m.day_sold, 0) AS BIGINT) AS dailySalesVolume,
  CAST(CAST(coalesce(m.earned, 0) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(20,2)) AS totalSalesAmount,
  coalesce(g.totalGoodsNum, 0) AS totalGoodsNum, coalesce(m.dailyGoodsNum, 0) AS dailyGoodsNum,
  coalesce(m.semi, 0) AS halfPipelineGoodsNum, coalesce(s.total, 0) AS totalStoreNum,
  coalesce(s.daily, 0) AS dailyStoreNum,
  CAST(CASE WHEN coalesce(m.total_sold, 0) = 0 THEN 0
    ELSE CAST((2 * m.earned + m.total_sold) // (2 * m.total_sold) AS DECIMAL(18,0)) * 0.01 END AS DECIMAL(20,2))
    AS avgCustomerPrice,
  CAST(CASE WHEN coalesce(v.sold, 0) = 0 THEN NULL
    ELSE sign(m.day_sold - v.sold)
      * CAST((20000 * abs(m.day_sold - v.sold) + v.sold) // (2 * v.sold) AS DECIMAL(14,0)) * 0.0001 END
    AS DECIMAL(18,4)) AS dailySalesVolumeChange"""

query("g7_category_daily_increment", _build(gold.build_category_daily, BIZ_DATE), with_tables(
    ["dwd_goods_base", "dwd_malls_base", "dwd_category_base"], _PATHS + f"""
, m AS (
  SELECT optId, siteId, count(DISTINCT goodsId) AS goodsNum, count(DISTINCT goodsId) AS dailyGoodsNum,
    count(DISTINCT CASE WHEN semiManaged THEN goodsId END) AS semi, sum(coalesce(salesNum, 0)) AS day_sold,
    sum(coalesce(salesNum, 0)) AS total_sold, sum(coalesce(salesNum, 0) * coalesce(minOnSalePrice, 0)) AS earned
  FROM paths WHERE date = {_BIZ} GROUP BY ALL
), v AS (
  SELECT optId, siteId, sum(coalesce(salesNum, 0)) AS sold FROM paths
  WHERE date = CAST({_BIZ} - INTERVAL '1' DAY AS DATE) AND (optId, siteId) IN (SELECT (optId, siteId) FROM m)
  GROUP BY ALL
), g AS (SELECT siteId, count(DISTINCT goodsId) AS totalGoodsNum FROM dwd_goods_base WHERE date = {_BIZ} GROUP BY ALL)
, s AS (SELECT optId, siteId, count(DISTINCT mallId) AS total, count(DISTINCT mallId) AS daily
        FROM listed WHERE date = {_BIZ} GROUP BY ALL)
SELECT b.optId, b.siteId, b.date, {_CATEGORY_COLUMNS}
FROM dwd_category_base b
LEFT JOIN m ON m.optId = b.optId AND m.siteId = b.siteId
LEFT JOIN v ON v.optId = b.optId AND v.siteId = b.siteId
LEFT JOIN g ON g.siteId = b.siteId
LEFT JOIN s ON s.optId = b.optId AND s.siteId = b.siteId
WHERE b.date = {_BIZ}"""))

query("g8_category_daily_rebuild", _build(gold.build_category_daily), with_tables(
    ["dwd_goods_base", "dwd_malls_base", "dwd_category_base"], _PATHS + f"""
, days AS (SELECT date AS d FROM dwd_category_base UNION SELECT date FROM dwd_goods_base
           UNION SELECT date FROM dwd_malls_base)
, base AS (
  SELECT c.*, d FROM dwd_category_base c JOIN days ON c.date <= d
  QUALIFY row_number() OVER (PARTITION BY optId, siteId, d ORDER BY date DESC) = 1
), seen AS (SELECT p.*, d FROM paths p JOIN days ON p.date <= d)
, counts AS (
  SELECT d, optId, siteId, count(DISTINCT goodsId) AS goodsNum,
    count(DISTINCT CASE WHEN date = d THEN goodsId END) AS dailyGoodsNum,
    count(DISTINCT CASE WHEN semiManaged THEN goodsId END) AS semi,
    sum(CASE WHEN date = d THEN coalesce(salesNum, 0) ELSE 0 END) AS day_sold
  FROM seen GROUP BY ALL
), latest AS (
  SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY d, goodsId, siteId, optId ORDER BY date DESC) = 1
), sold AS (
  SELECT d, optId, siteId, sum(coalesce(salesNum, 0)) AS total_sold,
    sum(coalesce(salesNum, 0) * coalesce(minOnSalePrice, 0)) AS earned FROM latest GROUP BY ALL
), m AS (SELECT counts.*, total_sold, earned FROM counts JOIN sold USING (d, optId, siteId))
, v AS (
  SELECT d, optId, siteId, sum(coalesce(salesNum, 0)) AS sold FROM seen
  WHERE date = CAST(d - INTERVAL '1' DAY AS DATE) GROUP BY ALL
), g AS (SELECT d, siteId, count(DISTINCT goodsId) AS totalGoodsNum FROM seen GROUP BY ALL)
, last_store AS (SELECT d, siteId, max(date) AS last_date FROM dwd_malls_base JOIN days ON date <= d GROUP BY ALL)
, s AS (
  SELECT l.optId, l.siteId, t.d, count(DISTINCT mallId) AS total,
    count(DISTINCT CASE WHEN l.date = t.last_date THEN mallId END) AS daily
  FROM listed l JOIN last_store t ON t.siteId = l.siteId AND l.date <= t.d GROUP BY ALL
)
SELECT b.optId, b.siteId, b.d AS date, {_CATEGORY_COLUMNS}
FROM base b
LEFT JOIN m ON m.optId = b.optId AND m.siteId = b.siteId AND m.d = b.d
LEFT JOIN v ON v.optId = b.optId AND v.siteId = b.siteId AND v.d = b.d
LEFT JOIN g ON g.siteId = b.siteId AND g.d = b.d
LEFT JOIN s ON s.optId = b.optId AND s.siteId = b.siteId AND s.d = b.d"""))

_REVIEW = """
SELECT date, reviewId, comment AS commentEnglish,
  CASE WHEN lang IN ('zh-Hans', 'zh-CN', 'zh') THEN comment
       ELSE coalesce(json_extract_string(reviewLang, '$.translateComment'), comment) END AS commentChinese,
  time, name, avatar, profileLinkUrl, score, goodsId, skuId, coalesce(list, pictures) AS imageOrVideoList, specs
FROM dwd_review_base"""
query("g9_review_daily_increment", _build(gold.build_review_daily, BIZ_DATE),
      with_tables(["dwd_review_base"], _REVIEW + f" WHERE date = {_BIZ}"))
query("g10_review_daily_rebuild", _build(gold.build_review_daily), with_tables(["dwd_review_base"], _REVIEW))
