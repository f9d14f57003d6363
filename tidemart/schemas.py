"""Table schemas: the one place that states column names, types and keys.

``kind`` is ``raw`` (append, duplicates kept), ``clean`` or ``daily`` (one row per key). ``JSON``
columns hold JSON text in a STRING column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    kind: str
    keys: tuple[str, ...]
    columns: str
    required: tuple[str, ...] = ()

    @property
    def types(self) -> dict[str, str]:
        pairs = (c.strip().split(" ", 1) for c in _split(self.columns))
        return {name: kind.strip() for name, kind in pairs}

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, _spark_type(k), True, {"kind": k}) for n, k in self.types.items()]
        )


def _split(columns: str) -> list[str]:
    out, depth, word = [], 0, ""
    for ch in columns:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(word)
            word = ""
        else:
            word += ch
    return [c for c in (*out, word) if c.strip()]


def _spark_type(kind: str) -> T.DataType:
    if kind.startswith("DECIMAL"):
        precision, scale = kind[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return {
        "STRING": T.StringType(), "JSON": T.StringType(), "BIGINT": T.LongType(),
        "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(),
        "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(),
    }[kind]


# Column names and types of the sixteen tables, in table order.
_RAW_GOODS = """
goodsId BIGINT, siteId BIGINT, date DATE, mallId STRING, sellerType BIGINT, currentSkuId STRING,
defaultSkuId STRING, selectedLang STRING, lang STRING, selectedCurrency STRING, optId BIGINT,
optType BIGINT, optLevel BIGINT, catId BIGINT, catInfo JSON, title STRING, goodsName STRING,
linkUrl STRING, activityType BIGINT, sideSalesTip STRING, salesTip STRING, salesTipText JSON,
salesTipTextList JSON, businessReduction STRING, isOnsale BIGINT, isShowMarketPrice BOOLEAN,
isSkc BOOLEAN, qty BIGINT, status BIGINT, soldOutSubscribeStatus BIGINT, salesNum BIGINT,
soldQuantity BIGINT, reviewNum BIGINT, commentNumTips STRING, sortTypeStyle BIGINT,
goodsScore DOUBLE, showScore DOUBLE, reviewScore STRING, hiddenComment BOOLEAN, seoLinkUrl STRING,
defaultSelectSpec JSON, minOnSalePrice BIGINT, maxOnSalePrice BIGINT, priceInfo JSON,
salePriceRich JSON, minToMaxSalePriceRich JSON, image JSON, brandCard JSON, guideFile JSON,
hdThumbUrl STRING, thumbUrl STRING, goodsImage STRING, imageUrl STRING, longThumbUrl STRING,
searchKey STRING, queryReleScore DOUBLE, goodRankList JSON, video JSON, visible BOOLEAN,
pageAlt STRING, itemType BIGINT, HWRatio BIGINT, semiManaged BOOLEAN, benefitText JSON,
soldQuantityPercent BIGINT, wareHouseType BIGINT, isLocalGoods BIGINT, itemId STRING,
adultGoods BOOLEAN, isManualChangeSpec BOOLEAN, topItemsSize BIGINT, topItemsTitle STRING,
topItemsTitleBrief STRING, topItemsTag STRING, subTopItemsTitleUserText STRING,
topItemsType BIGINT, iterationSku JSON, clothFitReviewText STRING, popupClothFitReviewText STRING,
clothFitReviewInfoList JSON, bestSellerModule JSON, pageLabelsInfo JSON, gallery JSON,
goodsProperty JSON, goodsPropertyPrefer JSON, bannerList JSON, detailList JSON,
customImageList JSON, rows BIGINT, statusExplain STRING, checkQuantity BIGINT, sizeGuide JSON,
skcList JSON, specIds STRING, skuList JSON, sizeSpecModule JSON, specCustom JSON,
productDetailFlatList JSON, productDetail JSON, ext JSON, extendFields JSON, activityInfo JSON,
displayEndTime BIGINT, displayEndTimePercent BIGINT, displayEndTimePercentImg STRING,
selectedSpecIds JSON, quickLook JSON, crumbOptList JSON, tagsInfo JSON, tagCode BIGINT, pRec JSON,
userAgent STRING, fromUrl STRING, serverTime STRING, timezone STRING
"""
_CLEAN_GOODS = """
goodsId BIGINT, siteId BIGINT, date DATE, lang STRING, selectedCurrency STRING, mallId STRING,
optId BIGINT, catId BIGINT, title STRING, linkUrl STRING, salesNum BIGINT, isOnsale BIGINT,
isShowMarketPrice BOOLEAN, reviewNum BIGINT, goodsScore DOUBLE, minOnSalePrice BIGINT,
maxOnSalePrice BIGINT, priceInfo JSON, image JSON, brandCard JSON, guideFile JSON,
imageUrl STRING, thumbUrl STRING, video JSON, visible BOOLEAN, pageAlt STRING,
semiManaged BOOLEAN, soldQuantityPercent BIGINT, wareHouseType BIGINT, isLocalGoods BIGINT,
adultGoods BOOLEAN, gallery JSON, goodsProperty JSON, sizeGuide JSON, skcList JSON,
specIds STRING, skuList JSON, trackingKey STRING, type BIGINT, supportPromotion BOOLEAN,
sizeSpecModule JSON, specCustom JSON, productDetailFlatList JSON, productDetail JSON,
displayEndTime BIGINT, crumbOptList JSON
"""
_DAILY_GOODS = """
goodsId BIGINT, siteId BIGINT, date DATE, goodsTitleEnglish STRING, goodsTitleChinese STRING,
mallId STRING, mainImageUrl STRING, thumbUrl STRING, carouselImageUrls JSON, optId BIGINT,
catId BIGINT, isAdultGoods BOOLEAN, videoInfo JSON, propertyList JSON, salesNum BIGINT,
currency STRING, minOnSalePrice BIGINT, maxOnSalePrice BIGINT, score DOUBLE, reviewNum BIGINT,
stockStatus BIGINT, stockQuantity BIGINT, addToRegionTime DATE, skuInfoList JSON,
firstAddTime DATE, lastUpdateTime DATE
"""
_RAW_MALLS = """
mallId BIGINT, siteId INT, date DATE, mallName STRING, mallLogo STRING, picUrl STRING,
avatar STRING, appCode INT, nickname STRING, isDefaultAvatar BOOLEAN, goodsNum INT,
goodsNumV2 STRING, goodsNumUnit JSON, goodsNumLowercaseUnit JSON, mallStar DECIMAL(10,1),
mallStarStr STRING, shortenMallStar STRING, goodsSalesNum BIGINT, goodsSalesNumUnit JSON,
goodsSalesBrief STRING, followerNum BIGINT, followerNumUnit JSON, semiManaged BOOLEAN,
channelType STRING, searchUrl STRING, seoUrl STRING, mallJumpUrl STRING, mallTags JSON,
reviewNum INT, reviewNumStr STRING, scoreNumInfoList JSON, mallReviewLabelShow BOOLEAN,
mallReviewLinkUrl STRING, isExpire BOOLEAN, userAgent STRING, fromUrl STRING, serverTime BIGINT,
timezone STRING, lang STRING, selectedLang STRING, source STRING, shareInfo JSON,
topShopInfo JSON, semiManagedMallTags JSON, marketPriceType INT, goodsSimpleInfoList STRING,
isAiReview BOOLEAN, optList JSON
"""
_CLEAN_MALLS = """
mallId BIGINT, siteId INT, date DATE, lang STRING, mallName STRING, reviewNum INT,
mallLogo STRING, goodsNum INT, mallStar DECIMAL(10,1), goodsSalesNum BIGINT,
goodsSalesBrief STRING, followerNum BIGINT, semiManaged BOOLEAN, searchUrl STRING, seoUrl STRING,
mallJumpUrl STRING, mallReviewLinkUrl STRING, shareInfo_shareTitle STRING,
shareInfo_shareImg STRING, shareInfo_shareUrl STRING, scoreNumInfoList JSON,
topShopInfo_topShopText_textData STRING, topShopInfo_topShopGoToUrl STRING, optList JSON,
semiManagedMallTags_contents_text STRING, semiManagedMallTags_contents_url STRING,
lastUpdateTime DATETIME
"""
_DAILY_MALLS = """
mallId BIGINT, siteId INT, date DATE, mallName STRING, mallLogoUrl STRING, mallType INT,
categoryList JSON, goodsNum INT, goodsSalesNum INT, goodsSalesPrice BIGINT,
mallStar DECIMAL(10,1), scorePercentInfo JSON, reviewNum INT, followerNum BIGINT,
addToRegionTime DATE, lastUpdateTime DATETIME
"""
_RAW_CATEGORY = """
date DATE, optId INT, siteId INT, catId STRING, catInfo JSON, optName STRING, title STRING,
tagDesc STRING, optType INT, optLevel INT, imageUrl STRING, disableDup BOOLEAN, bubbleInfo JSON,
pattern INT, priority INT, seoLinkUrl STRING, tabType INT, parentId INT, shareUrl STRING,
linkUrl STRING, href STRING, isFeatured BOOLEAN, pRec JSON, userAgent STRING, fromUrl STRING,
serverTime STRING, timezone STRING, lang STRING, selectedLang STRING
"""
_CLEAN_CATEGORY = """
date DATE, optId INT, siteId INT, lang STRING, catId STRING, optName STRING, title STRING,
tagDesc STRING, optType INT, optLevel INT, imageUrl STRING, disableDup BOOLEAN, priority INT,
seoLinkUrl STRING, parentId INT, shareUrl STRING, linkUrl STRING, href STRING, isFeatured BOOLEAN
"""
_DAILY_CATEGORY = """
optId INT, siteId INT, date DATE, parentId INT, optNameEnglish STRING, optNameChinese STRING,
imageUrl STRING, seoLinkUrl STRING, linkUrl STRING, shareUrl STRING, optType INT,
goodsNum BIGINT, isFeatured BOOLEAN, rank INT, totalSalesVolume BIGINT, dailySalesVolume BIGINT,
totalSalesAmount DECIMAL(20,2), totalGoodsNum BIGINT, dailyGoodsNum BIGINT,
halfPipelineGoodsNum BIGINT, totalStoreNum BIGINT, dailyStoreNum BIGINT,
avgCustomerPrice DECIMAL(20,2), dailySalesVolumeChange DECIMAL(18,4)
"""
_RAW_REVIEW = """
date DATE, reviewId STRING, siteId INT, goodsId STRING, skuId STRING, comment STRING, score INT,
specs JSON, time BIGINT, timeMs BIGINT, concatTimeLang STRING, concatRichText JSON,
avatar STRING, name STRING, isOwnReview BOOLEAN, isSimilarReview BOOLEAN, profileLinkUrl STRING,
pictures JSON, opList JSON, viewMoreList JSON, reviewLang JSON, list JSON,
goodsSpecificReviewLevelInfo JSON, extendParams JSON, inBlacklist BOOLEAN, userAgent STRING,
fromUrl STRING, serverTime STRING, timezone STRING, lang STRING, selectedLang STRING
"""
_CLEAN_REVIEW = """
reviewId STRING, siteId INT, date DATE, lang STRING, goodsId STRING, skuId STRING,
comment STRING, score INT, specs JSON, time BIGINT, concatTimeLang STRING, concatRichText JSON,
avatar STRING, name STRING, profileLinkUrl STRING, pictures JSON, opList JSON,
viewMoreList JSON, reviewLang JSON, list JSON, inBlacklist BOOLEAN
"""
_DAILY_REVIEW = """
date DATE, reviewId STRING, commentEnglish STRING, commentChinese STRING, time BIGINT,
name STRING, avatar STRING, profileLinkUrl STRING, score INT, goodsId STRING, skuId STRING,
imageOrVideoList JSON, specs JSON
"""
_RAW_SITE = """
date DATE, siteId INT, regionId INT, regionName STRING, regionShortNamelinkUrl STRING,
lang STRING, phoneCode STRING, selectedLang STRING, selectedCurrency STRING,
supportedLangList JSON, supportedCurrencyList JSON, regionImageUrl STRING, userAgent STRING,
fromUrl STRING, serverTime BIGINT, timezone STRING
"""
_CLEAN_SITE = """
siteId INT, date DATE, regionId INT, regionName STRING, lang STRING,
regionShortNamelinkUrl STRING, phoneCode STRING, selectedLang STRING, selectedCurrency STRING,
supportedLangList JSON, supportedCurrencyList JSON, regionImageUrl STRING, userAgent STRING,
fromUrl STRING, serverTime BIGINT, timezone STRING
"""
_RAW_EXTERNAL = """
goodsId BIGINT, siteId INT, date DATE, rankings JSON, site JSON, stats JSON, goods JSON,
history JSON
"""
# Metrics of one history entry; each period prefix (day, week, month) adds the listed suffixes.
PERIODS = ("day", "week", "month")
PERIOD_METRICS = (
    ("Sold", "BIGINT"), ("Sales", "DECIMAL(20,4)"), ("SoldRate", "DECIMAL(18,6)"),
    ("SalesRate", "DECIMAL(18,6)"), ("ClickNum", "BIGINT"), ("ExposureNum", "BIGINT"),
    ("ClickRate", "DECIMAL(18,6)"), ("ClickGrowthRate", "DECIMAL(18,6)"),
    ("ExposureGrowthRate", "DECIMAL(18,6)"),
)
_CLEAN_EXTERNAL = """
goodsId BIGINT, siteId INT, date DATE, regionId BIGINT, sourceRecordId STRING, mallId STRING,
goodsName STRING, goodsNameCn STRING, goodsNameEn STRING, thumbnail STRING, thumbnailCn STRING,
catIds JSON, optId BIGINT, catId BIGINT, catItems JSON, currency STRING, cents INT,
exchangeRate DECIMAL(18,6), skuInfo JSON, status INT, hostingMode INT, onSaleTime DATETIME,
goodsCreateTime DATETIME, goodsUpdateTime DATETIME, historyId STRING, sold BIGINT,
sales DECIMAL(20,4), minPrice DECIMAL(20,4), maxPrice DECIMAL(20,4), quantity BIGINT,
goodsScore DECIMAL(10,2), reviewNum BIGINT,
""" + ", ".join(f"{p}{m} {kind}" for m, kind in PERIOD_METRICS for p in PERIODS) + """,
historyCreateTime DATETIME, historyUpdateTime DATETIME
"""

# Bytes that text columns may hold, in table order; other text has no bound.
TEXT_BYTES: dict[str, dict[str, int]] = {
    "ods_category_raw": {
        "catId": 64, "optName": 512, "title": 512, "tagDesc": 512, "imageUrl": 512, "seoLinkUrl": 1024, "shareUrl": 512,
        "linkUrl": 1024, "href": 1024, "userAgent": 512, "fromUrl": 1024, "serverTime": 64, "timezone": 64, "lang": 32,
        "selectedLang": 32},
    "dwd_category_base": {
        "lang": 32, "catId": 64, "optName": 512, "title": 512, "tagDesc": 512, "imageUrl": 512, "seoLinkUrl": 1024,
        "shareUrl": 512, "linkUrl": 1024, "href": 1024},
    "dws_category_daily": {"optNameEnglish": 512, "optNameChinese": 512},
    "ods_review_raw": {"reviewId": 64, "goodsId": 64, "skuId": 64, "lang": 32, "selectedLang": 32},
    "dwd_review_base": {"reviewId": 64, "lang": 32, "goodsId": 64, "skuId": 64},
    "dws_review_daily": {"reviewId": 64, "goodsId": 64, "skuId": 64},
    "ods_site_raw": {
        "regionName": 255, "regionShortNamelinkUrl": 100, "lang": 50, "phoneCode": 20, "selectedLang": 50,
        "selectedCurrency": 20, "regionImageUrl": 1024, "userAgent": 1024, "timezone": 100},
    "dwd_site_base": {
        "regionName": 255, "lang": 50, "regionShortNamelinkUrl": 50, "phoneCode": 20, "selectedLang": 50,
        "selectedCurrency": 20, "regionImageUrl": 500, "userAgent": 1024, "timezone": 100},
}

_GOODS_KEY = ("goodsId", "siteId", "date")
_MALL_KEY = ("mallId", "siteId", "date")
_OPT_KEY = ("date", "optId", "siteId")

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table("ods_goods_raw", "raw", _GOODS_KEY, _RAW_GOODS),
        Table("dwd_goods_base", "clean", _GOODS_KEY, _CLEAN_GOODS),
        Table("dws_goods_daily", "daily", _GOODS_KEY, _DAILY_GOODS),
        Table("ods_malls_raw", "raw", _MALL_KEY, _RAW_MALLS),
        Table("dwd_malls_base", "clean", _MALL_KEY, _CLEAN_MALLS),
        Table("dws_malls_daily", "daily", _MALL_KEY, _DAILY_MALLS),
        Table("ods_category_raw", "raw", _OPT_KEY, _RAW_CATEGORY),
        Table("dwd_category_base", "clean", _OPT_KEY, _CLEAN_CATEGORY),
        Table("dws_category_daily", "daily", ("optId", "siteId", "date"), _DAILY_CATEGORY,
              required=("optId", "siteId", "date")),
        Table("ods_review_raw", "raw", ("date", "reviewId", "siteId"), _RAW_REVIEW,
              required=("date", "reviewId", "siteId")),
        Table("dwd_review_base", "clean", ("reviewId", "siteId", "date"), _CLEAN_REVIEW,
              required=("reviewId", "siteId", "date")),
        # The daily review key leaves the site out: one review seen on two sites is one row.
        Table("dws_review_daily", "daily", ("date", "reviewId"), _DAILY_REVIEW),
        Table("ods_site_raw", "raw", ("date", "siteId"), _RAW_SITE, required=("date", "siteId")),
        Table("dwd_site_base", "clean", ("siteId", "date", "regionId"), _CLEAN_SITE,
              required=("siteId", "date", "regionId")),
        Table("ods_external_goods_raw", "raw", _GOODS_KEY, _RAW_EXTERNAL, required=_GOODS_KEY),
        Table("dwd_external_goods_daily", "clean", _GOODS_KEY, _CLEAN_EXTERNAL, required=_GOODS_KEY),
    )
}


@dataclass(frozen=True)
class State:
    """Smallest values per key of a table, as SQL over its rows."""

    source: str
    keys: tuple[str, ...]
    columns: dict[str, str]

    def minima(self, rows: DataFrame) -> DataFrame:
        """One row per key, combined before the shuffle; rows without a key or a value are left out."""
        found = rows.selectExpr(*self.keys, *[f"{text} AS {name}" for name, text in self.columns.items()])
        return self.combine(found.dropna(subset=list(self.keys)).dropna("all", subset=list(self.columns)))

    def combine(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.min(name).alias(name) for name in self.columns])


#: First days that the daily builds look up per key, kept from day to day.
STATES: dict[str, State] = {
    "first_goods": State("dwd_goods_base", ("goodsId", "siteId"), {"firstCollectDate": "date"}),
    "first_review": State("dwd_review_base", ("goodsId", "siteId"), {"firstReviewDate": "to_date(timestamp_seconds(time))"}),
    "first_external": State("dwd_external_goods_daily", ("goodsId", "siteId"),
                            {"firstCollectDate": "date", "firstOnSaleDate": "to_date(onSaleTime)"}),
    "first_malls": State("dwd_malls_base", ("mallId", "siteId"), {"firstCollectDate": "date"}),
    "stored_goods": State("dws_goods_daily", ("goodsId", "siteId"),
                          {"storedFirst": "firstAddTime", "storedRegion": "addToRegionTime"}),
    "stored_malls": State("dws_malls_daily", ("mallId", "siteId"), {"storedRegion": "addToRegionTime"}),
}
