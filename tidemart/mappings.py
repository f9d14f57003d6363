"""Field mappings: target column -> document path, or an ordered list of paths.

Columns that are not named here have no source and stay NULL. A path step is a name, ``[n]`` or a
bare number (list index), ``[i]`` (any entry) or ``value`` (any value of a map).
"""

from __future__ import annotations

# Fixed values below: the document paths of each page kind, in column order.

REGION = "webLayoutData.headerData.region.regionInfo"
SEARCH_REGION = "layoutData.headerData.region.regionInfo"

# Places of a product page that hold reviews.
PAGE_REVIEWS = "review.reviewData.reviewInfoList[i]"
PAGE_SIMILAR = "review.reviewData.similarReview.reviewInfoList[i]"
STORE_SIMILAR = "reviewStore.similarReview.reviewInfoList[i]"
STORE_COMMENTS = "reviewStore.commentList[i]"
STORE_PAGES = "reviewStore.pageReviewListMap.value[i]"
STORE_FIRST_PAGES = "reviewStore.initPageReviewListMap.value[i]"

# Review sources in the order their rows are written.
REVIEW_SOURCES = (PAGE_REVIEWS, PAGE_SIMILAR, STORE_SIMILAR, STORE_COMMENTS, STORE_PAGES, STORE_FIRST_PAGES)
REVIEW_ITEM_FIELDS = (
    "reviewId goodsId skuId comment score specs time timeMs concatTimeLang concatRichText avatar name "
    "isOwnReview isSimilarReview profileLinkUrl pictures opList viewMoreList reviewLang list "
    "goodsSpecificReviewLevelInfo extendParams"
).split()
# Fields the two similar-review sources do not provide.
REVIEW_FIELDS_NOT_IN_SIMILAR = ("reviewLang", "list")
REVIEW_ALIASES = {
    "reviewId": ("review_id", "commentId", "comment_id", "id"),
    "comment": ("content", "commentText", "text"),
    "score": ("rating", "star", "starRating"),
    "avatar": ("userAvatar", "user.avatar"),
    "name": ("nickname", "nickName", "userName", "user.name"),
    "pictures": ("pictureList", "picList", "pics"),
    "list": ("imageOrVideoList", "mediaList"),
    "profileLinkUrl": ("profileUrl", "profileLink", "user.profileLinkUrl"),
    "reviewLang": ("langInfo", "languageInfo"),
    "extendParams": ("extParams", "expParams"),
}
REVIEW_PAGE_FIELDS = {
    "siteId": f"{REGION}.siteId",
    "inBlacklist": "inBlacklist",
    "userAgent": "userAgent",
    "fromUrl": "moduleMap.shareModule.data.share.linkUrl",
    "serverTime": "serverTime",
    "timezone": "localInfo.timezone",
    "lang": "lang",
    "selectedLang": f"{REGION}.selectedLang",
}

PRODUCT_GOODS = {
    "goodsId": [
        "goodsId", "goods.goodsId", "favStore.goodsId", "sku[0].goodsId", f"{STORE_PAGES}.goodsId",
        "formatSkuData.skuInfos.value.goodsId", f"{STORE_COMMENTS}.goodsId",
        f"{STORE_SIMILAR}.goodsInfo.goodsId", f"{PAGE_SIMILAR}.goodsInfo.goodsId",
        f"{PAGE_SIMILAR}.goodsId", f"{STORE_SIMILAR}.goodsId", f"{PAGE_REVIEWS}.goodsId",
        f"{STORE_FIRST_PAGES}.goodsId",
    ],
    "siteId": f"{REGION}.siteId",
    "mallId": ["goods.mallId", "mall.mallData.mallId", "moduleMap.mallModule.data.mallData.mallId"],
    "sellerType": "goods.sellerType",
    "defaultSkuId": ["control.defaultSkuId", "skuControl.defaultSkuId"],
    "selectedLang": f"{REGION}.selectedLang",
    "lang": [f"{REGION}.supportedLangList[0].lang", "lang"],
    "selectedCurrency": f"{REGION}.selectedCurrency",
    "optId": ["optId", "crumbOptList[0].optId"],
    "optType": "crumbOptList[0].optType",
    "optLevel": "optLevel",
    "catId": "goods.catId",
    "catInfo": "crumbOptList",
    "title": ["goods.goodsName", f"{STORE_SIMILAR}.goodsInfo.goodsName", f"{PAGE_SIMILAR}.goodsInfo.goodsName"],
    "goodsName": ["goods.goodsName", f"{STORE_SIMILAR}.goodsInfo.goodsName", f"{PAGE_SIMILAR}.goodsInfo.goodsName"],
    "linkUrl": [
        f"{STORE_PAGES}.opList[0].linkUrl", f"{STORE_COMMENTS}.opList[0].linkUrl",
        f"{STORE_FIRST_PAGES}.opList[0].linkUrl", f"{STORE_SIMILAR}.opList[0].linkUrl",
        "crumbOptList[0].linkUrl",
        "moduleMap.servicePromiseModule.data.afterSale.servicePromiseItemList[0].linkUrl",
        f"{PAGE_REVIEWS}.opList[0].linkUrl", f"{STORE_SIMILAR}.goodsInfo.linkUrl",
        f"{PAGE_SIMILAR}.goodsInfo.linkUrl", "webLayoutData.headerData.titleBarList[0].linkUrl",
        f"{PAGE_SIMILAR}.opList[0].linkUrl", "moduleMap.shareModule.data.share.linkUrl",
    ],
    "activityType": "activityInfo.activityType",
    "sideSalesTip": ["goods.sideSalesTip", "goods.saleInfo.sideSalesTip"],
    "salesTip": "goods.saleInfo.goodsSoldTip",
    "salesTipText": "goods.saleInfo.sideSalesTip",
    "salesTipTextList": "goods.saleInfo",
    "businessReduction": "sku[0].skuExt.business_reduction",
    "isOnsale": "formatSkuData.skuInfos.value.isOnsale",
    "isShowMarketPrice": "isShowMarketPrice",
    "isSkc": "isSkc",
    "qty": "qty",
    "status": [
        f"{STORE_SIMILAR}.opList[0].status", "goods.status", f"{PAGE_REVIEWS}.opList[0].status",
        f"{STORE_COMMENTS}.opList[0].status", f"{STORE_PAGES}.opList[0].status",
        f"{STORE_FIRST_PAGES}.opList[0].status", f"{PAGE_SIMILAR}.opList[0].status",
    ],
    "soldOutSubscribeStatus": "goods.soldOutSubscribeStatus",
    # The sales figure of a product page is the one of its store.
    "salesNum": "mall.mallData.goodsSalesNumUnit[0]",
    "soldQuantity": "goods.soldQuantity",
    "reviewNum": [
        "reviewStore.similarReview.reviewNum", "reviewStore.reviewNum", "commentBigPictureStore.reviewNum",
        "review.reviewData.reviewNum", "reviewStore.mallReview.reviewNum",
        "review.reviewData.mallReview.reviewNum", "review.reviewData.similarReview.reviewNum",
    ],
    "sortTypeStyle": "review.reviewData.expParams.sortTypeStyle",
    "goodsScore": "review.reviewData.goodsScore",
    "showScore": "reviewStore.showScore",
    "reviewScore": "review.reviewScore",
    "seoLinkUrl": [
        "crumbOptList[0].seoLinkUrl", f"{STORE_SIMILAR}.goodsInfo.seoLinkUrl",
        f"{PAGE_SIMILAR}.goodsInfo.seoLinkUrl", "webLayoutData.headerData.titleBarList[0].seoLinkUrl",
    ],
    "defaultSelectSpec": "control.defaultSelectSpec.0",
    "minOnSalePrice": ["goods.minOnSalePrice", "goodsExt.minOnSalePrice"],
    "maxOnSalePrice": "goods.maxOnSalePrice",
    "priceInfo": "goods.salePriceRich",
    "salePriceRich": "goods.salePriceRich",
    "minToMaxSalePriceRich": "goods.minToMaxSalePriceRich",
    "image": [
        "goods.gallery.0", f"{PAGE_REVIEWS}.list[0]", f"{PAGE_SIMILAR}.list[0]", f"{STORE_SIMILAR}.list[0]",
        f"{STORE_PAGES}.list[0]", f"{STORE_COMMENTS}.list[0]", f"{STORE_FIRST_PAGES}.list[0]",
    ],
    "brandCard": "mall.mallData",
    "hdThumbUrl": "goods.hdThumbUrl",
    "thumbUrl": [
        "goods.thumbUrl", "sku[0].thumbUrl", "formatSkuData.skuInfos.value.thumbUrl",
        f"{STORE_SIMILAR}.goodsInfo.thumbUrl", f"{PAGE_SIMILAR}.goodsInfo.thumbUrl",
    ],
    "imageUrl": ["goods.imageUrl", "crumbOptList[0].imageUrl", f"{REGION}.imageUrl"],
    "searchKey": "query.search_key",
    "video": "goods.video",
    "pageAlt": "seoPageAltInfo.pageAlt",
    "semiManaged": "goods.isLocalGoods",
    "benefitText": "webLayoutData.activityInfoData.object.benefits.0.content.0.title",
    "isLocalGoods": "goods.isLocalGoods",
    "itemId": "goods.itemId",
    "isManualChangeSpec": "isManualChangeSpec",
    "iterationSku": "goods.iterationSku",
    "clothFitReviewText": "review.reviewData.clothFitReviewText",
    "popupClothFitReviewText": "review.reviewData.popupClothFitReviewText",
    "bestSellerModule": "moduleMap.bestSellerModule",
    "pageLabelsInfo{}": "reviewStore.pageLabelsInfo",
    "gallery": "goods.gallery",
    "goodsProperty": "goods.goodsProperty",
    "bannerList": "goods.bannerList",
    "detailList": "webLayoutData.footerData.supportedPayIconDetailList",
    "customImageList": "goods.customImageList",
    "rows": "goods.rows",
    "statusExplain": "goods.statusExplain",
    "checkQuantity": "goods.checkQuantity",
    "sizeGuide": "sizeGuide",
    "skcList": "goods.skc",
    "skuList": "formatSkuData.skuInfos",
    "specCustom": "specCustom.skuStockQuantityTipsInfo",
    "productDetailFlatList": "productDetailFlatList",
    "productDetail": "productDetail.floorList",
    "extendFields": "webLayoutData.headerData.searchInfo.shadeWords.0.extendFields",
    "activityInfo": "activityInfo",
    "crumbOptList": "crumbOptList",
    "tagCode": "moduleMap.mallModule.data.mallData.mallTags[0].tagCode",
    "pRec": "crumbOptList.0.pRec",
    "userAgent": "userAgent",
    "fromUrl": "webLayoutData.commonData.query.refer_page_name",
    "serverTime": ["serverTime", "webLayoutData.activityInfoData.serverTime"],
    "timezone": ["localInfo.timezone", "webLayoutData.commonData.localInfo.timezone"],
}

_MALL_DATA = "mall.mallData"
PRODUCT_MALLS = {
    "mallId": "goods.mallId",
    "siteId": f"{REGION}.siteId",
    "mallName": f"{_MALL_DATA}.mallName",
    "mallLogo": f"{_MALL_DATA}.mallLogo",
    "goodsNum": f"{_MALL_DATA}.goodsNum",
    "goodsNumV2": f"{_MALL_DATA}.goodsNumV2",
    "goodsNumUnit": f"{_MALL_DATA}.goodsNumUnit",
    "goodsNumLowercaseUnit": f"{_MALL_DATA}.goodsNumUnit[1]",
    "mallStar": "review.reviewData.mallReview.mallScore",
    "mallStarStr": "reviewStore.mallReview.mallScoreText",
    "shortenMallStar": f"{_MALL_DATA}.shortenMallStar",
    "goodsSalesNum": f"{_MALL_DATA}.goodsSalesNumUnit[0]",
    "goodsSalesNumUnit": f"{_MALL_DATA}.goodsSalesNumUnit",
    "goodsSalesBrief": f"{_MALL_DATA}.goodsSalesNumUnit[1]",
    "followerNum": f"{_MALL_DATA}.followerNumUnit[0]",
    "followerNumUnit": f"{_MALL_DATA}.followerNumUnit",
    # A store is semi-managed when its product is a local one.
    "semiManaged": "goods.isLocalGoods",
    "channelType": f"{_MALL_DATA}.channelType",
    "searchUrl": f"{_MALL_DATA}.searchUrl",
    "seoUrl": f"{_MALL_DATA}.seoUrl",
    "mallJumpUrl": f"{_MALL_DATA}.mallJumpUrl",
    "mallTags": f"{_MALL_DATA}.mallTags[0]",
    "reviewNum": "reviewStore.mallReview.reviewNum",
    "reviewNumStr": "reviewStore.mallReview.reviewNumStr",
    "scoreNumInfoList": f"{_MALL_DATA}.scoreNumInfoList[0]",
    "mallReviewLabelShow": f"{_MALL_DATA}.mallReviewLabelShow",
    "mallReviewLinkUrl": "reviewStore.mallReview.mallReviewLinkUrl",
    "isExpire": f"{_MALL_DATA}.isExpire",
    "userAgent": "userAgent",
    "fromUrl": "webLayoutData.commonData.query.refer_page_name",
    "serverTime": "serverTime",
    "timezone": "localInfo.timezone",
    "lang": "lang",
    "selectedLang": f"{REGION}.selectedLang",
    "source": "webLayoutData.headerData.titleBarList",
    "shareInfo": f"{_MALL_DATA}.shareInfo",
    "topShopInfo": f"{_MALL_DATA}.topShopInfo",
    "semiManagedMallTags": f"{_MALL_DATA}.semiManagedMallTags",
    "optList": "crumbOptList",
}
PRODUCT_MALLS_JSON_TEXT = (
    "goodsNumUnit", "goodsSalesNumUnit", "followerNumUnit", "shareInfo", "scoreNumInfoList", "topShopInfo",
    "optList", "mallTags", "semiManagedMallTags",
)

STORE_MALLS = {
    "mallId": "mallId",
    "siteId": f"{REGION}.siteId",
    "mallName": "mallInfo.mallName",
    "mallLogo": "mallInfo.mallLogo",
    "picUrl": "mallInfo.mallInfo.components[0].picUrl",
    "avatar": "userInfo.avatar",
    "appCode": "userInfo.appCode",
    "nickname": "userInfo.nickname",
    "isDefaultAvatar": "userInfo.isDefaultAvatar",
    "goodsNum": "mallInfo.goodsNum",
    "goodsNumV2": "mallInfo.goodsNumV2",
    "goodsNumUnit": "mallInfo.goodsNumUnit",
    "goodsNumLowercaseUnit": "mallInfo.goodsNumLowercaseUnit",
    "mallStar": "mallInfo.mallStar",
    "mallStarStr": "mallInfo.mallStarStr",
    "shortenMallStar": "mallInfo.shortenMallStar",
    "goodsSalesNum": "mallInfo.goodsSalesNum",
    "goodsSalesNumUnit": "mallInfo.goodsSalesNumUnit",
    "goodsSalesBrief": "mallInfo.goodsSalesBrief",
    "followerNum": "mallInfo.followerNum",
    "followerNumUnit": "mallInfo.followerNumUnit",
    "semiManaged": "mallInfo.semiManaged",
    "channelType": "mallInfo.channelType",
    "searchUrl": "mallInfo.searchUrl",
    "seoUrl": "webLayoutData.headerData.searchInfo.shadeWords.0.seoUrl",
    "mallJumpUrl": "mallInfo.mallJumpUrl",
    "mallTags": "mallInfo.mallTags",
    "reviewNum": "mallInfo.reviewNum",
    "reviewNumStr": "commentStore.commentInfo.reviewNumStr",
    "scoreNumInfoList": "commentStore.commentInfo.scoreNumInfoList",
    "mallReviewLabelShow": "commentStore.commentInfo.mallInfo.mallReviewLabelShow",
    "mallReviewLinkUrl": "commentStore.commentInfo.mallInfo.mallReviewLinkUrl",
    "isExpire": "isExpire",
    "userAgent": "userAgent",
    "fromUrl": "fromUrl",
    "serverTime": "mallInfo.serverTime",
    "timezone": "localInfo.timezone",
    "lang": "lang",
    "selectedLang": f"{REGION}.selectedLang",
    "source": "mallInfo.source",
    "shareInfo": "mallInfo.shareInfo",
    "topShopInfo": "mallInfo.topShopInfo",
    "semiManagedMallTags": "mallInfo.semiManagedMallTags",
    "marketPriceType": "categoryStore.goodsList[0].data.priceInfo.marketPriceType",
    "goodsSimpleInfoList": "decorationStore.decorationData.Home.data[0].goodsSimpleInfoList",
    "isAiReview": "commentBigPictureStore.isAiReview",
    "optList": "categoryStore.tabList",
}

# Category columns taken from one breadcrumb entry, and from the page around it.
CRUMB_FIELDS = {
    "optId": "optId",
    "catId": "optId",
    "optName": "optName",
    "title": "title",
    "tagDesc": "tagDesc",
    "optType": "optType",
    "imageUrl": "imageUrl",
    "disableDup": "disableDup",
    "bubbleInfo": "bubbleInfo",
    "pattern": "pattern",
    "priority": "priority",
    "seoLinkUrl": "seoLinkUrl",
    "tabType": "tabType",
    "parentId": "parentId",
    "shareUrl": "seoLinkUrl",
    "linkUrl": "linkUrl",
    "href": "href",
    "isFeatured": "isFeatured",
    "pRec": "pRec",
}
CRUMB_PAGE_FIELDS = {
    "siteId": f"{REGION}.siteId",
    "selectedLang": f"{REGION}.selectedLang",
    "lang": "webLayoutData.commonData.localInfo.language",
    "optLevel": "optLevel",
    "userAgent": "userAgent",
    "fromUrl": "webLayoutData.commonData.query.refer_page_name",
    "serverTime": "serverTime",
    "timezone": "localInfo.timezone",
}

PRODUCT_SITE = {
    "siteId": f"{REGION}.siteId",
    "regionId": f"{REGION}.regionId",
    "regionName": f"{REGION}.regionName",
    "regionShortNamelinkUrl": f"{REGION}.regionShortName",
    "lang": "lang",
    "phoneCode": f"{REGION}.phoneCode",
    "selectedLang": f"{REGION}.selectedLang",
    "selectedCurrency": f"{REGION}.selectedCurrency",
    "supportedLangList": f"{REGION}.supportedLangList",
    "supportedCurrencyList": f"{REGION}.supportedCurrencyList[0]",
    "regionImageUrl": f"{REGION}.imageUrl",
    "userAgent": "userAgent",
    "fromUrl": "webLayoutData.commonData.query.refer_page_name",
    "serverTime": "serverTime",
    "timezone": "localInfo.timezone",
}
SEARCH_SITE = {
    "siteId": f"{SEARCH_REGION}.siteId",
    "regionId": "localInfo.region",
    "regionName": f"{SEARCH_REGION}.regionName",
    "regionShortNamelinkUrl": f"{SEARCH_REGION}.regionShortName",
    "lang": "localInfo.language",
    "phoneCode": f"{SEARCH_REGION}.phoneCode",
    "selectedLang": f"{SEARCH_REGION}.selectedLang",
    "selectedCurrency": f"{SEARCH_REGION}.selectedCurrency",
    "supportedLangList": f"{SEARCH_REGION}.supportedLangList[0]",
    "supportedCurrencyList": f"{SEARCH_REGION}.supportedCurrencyList[0]",
    "regionImageUrl": f"{SEARCH_REGION}.imageUrl",
    "userAgent": "userAgent",
    "fromUrl": "fromUrl",
    "serverTime": "layoutData.activityInfoData.serverTime",
    "timezone": "localInfo.timezone",
}

# Search result pages: one list of products, its entries wrapped in ``data``.
SEARCH_LIST = "goodsList"
SEARCH_CATEGORY_ITEM = {
    "optId": "data.optId",
    "optType": "data.optType",
    "linkUrl": "data.linkUrl",
    "seoLinkUrl": "data.seoLinkUrl",
    "pRec": "data.pSearch",
}
SEARCH_CATEGORY_PAGE = {
    "siteId": f"{SEARCH_REGION}.siteId",
    "pattern": "pattern",
    "userAgent": "userAgent",
    "fromUrl": "fromUrl",
    "serverTime": "layoutData.activityInfoData.serverTime",
    "timezone": "localInfo.timezone",
    "lang": "localInfo.language",
    "selectedLang": f"{SEARCH_REGION}.selectedLang",
}
SEARCH_GOODS_ITEM = {
    "goodsId": "data.goodsId",
    "mallId": "data.mallId",
    "currentSkuId": "data.currentSkuId",
    "optType": "data.optType",
    "title": "data.title",
    "linkUrl": "data.linkUrl",
    "activityType": "data.activityType",
    "sideSalesTip": "data.salesTip",
    "salesNum": "data.salesNum",
    "commentNumTips": "data.comment",
    "goodsScore": "data.comment",
    "hiddenComment": "data.comment",
    "seoLinkUrl": "data.skcList[0]",
    "priceInfo": "data.priceInfo",
    "image": "data.image",
}
SEARCH_GOODS_PAGE = {
    "siteId": f"{SEARCH_REGION}.siteId",
    "selectedLang": f"{SEARCH_REGION}.selectedLang",
    "lang": f"{SEARCH_REGION}.supportedLangList[0]",
    "selectedCurrency": f"{SEARCH_REGION}.selectedCurrency",
}

# Load-more responses: snake-case entries, page fields at the root.
MORE_LIST = "data.goods_list"
MORE_CATEGORY_ITEM = {
    "optId": "opt_id",
    "title": "title",
    "optType": "opt_type",
    "imageUrl": "image.url",
    "seoLinkUrl": "seo_link_url",
    "linkUrl": "link_url",
}
MORE_CATEGORY_PAGE = {
    "siteId": "siteId",
    "pattern": "data.pattern",
    "pRec": "data.p_search",
    "userAgent": "userAgent",
    "fromUrl": "fromUrl",
    "serverTime": "server_time",
    "timezone": "timezone",
    "lang": "lang",
    "selectedLang": "selectedLang",
}
MORE_GOODS_ITEM = {
    "goodsId": "goods_id",
    "mallId": "mall_id",
    "optId": "opt_id",
    "optType": "opt_type",
    "title": "title",
    "linkUrl": "link_url",
    "salesTip": "sales_tip",
    "salesNum": "sales_num",
    "commentNumTips": "comment.comment_num_tips",
    "goodsScore": "comment.goods_score",
    "hiddenComment": "comment.hidden_comment",
    "seoLinkUrl": "seo_link_url",
    "hdThumbUrl": "hd_thumb_url",
    "thumbUrl": "thumb_url",
    "goodsImage": "image.url",
    "imageUrl": "image.url",
    "longThumbUrl": "long_thumb_url",
    "queryReleScore": "queryReleScore",
    "visible": "visible",
    "pageAlt": "page_alt",
    "itemType": "item_type",
    "soldQuantityPercent": "sold_quantity_percent",
    "wareHouseType": "ware_house_type",
    "adultGoods": "adult_goods",
    "displayEndTime": "display_end_time",
    "displayEndTimePercent": "display_end_time_percent",
    "selectedSpecIds": "selected_spec_ids",
    "skcList": "skc_list[0]",
    "priceInfo": "price_info",
    "image": "image",
    "video": "video",
    "benefitText": "benefit_text",
    "extendFields": "extend_fields",
    "pRec": "p_search",
}
# Load-more product rows carry no site.
MORE_GOODS_PAGE = {
    "quickLook": "data.quick_look",
    "userAgent": "userAgent",
    "fromUrl": "fromUrl",
    "serverTime": "server_time",
}
