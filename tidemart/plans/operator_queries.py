"""Explodes, filters, joins, aggregates, windows, sets and derived columns on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import derive as d
from tidemart.operators import aggregates, asof, explode, filters, joins, keyed
from tidemart.plans.registry import on
from tidemart.plans.standins import BIZ_DATE, with_tables

_BIZ = f"DATE '{BIZ_DATE}'"
# One row per user and day, with its number of events and its last one.
DAILY = """
SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n, max(event_id) AS last_id
FROM {events} GROUP BY user_id, CAST(ts AS DATE)
"""
_D = f"WITH daily AS ({DAILY.format(events='events')}), days AS (SELECT DISTINCT date AS stat_date FROM daily) "
_GOODS, _MALLS = ["dwd_goods_base"], ["dwd_malls_base"]


def _spine(t):
    return keyed.date_spine(t.sql(DAILY))


def _dated(t):
    return t["events"].withColumn("date", F.to_date("ts"))


# -- explodes ---------------------------------------------------------------------------------


def _e1(t):
    goods = t.clean["dwd_goods_base"].select("goodsId", "siteId", "date", "crumbOptList", "salesNum")
    by_key = F.concat(F.lit('{"1":{"optId":'), "goodsId", F.lit('},"x":{},"0":{"optId":'), "siteId", F.lit("}}"))
    goods = goods.withColumn("crumbs", F.when(F.col("siteId") == 0, by_key).otherwise(F.col("crumbOptList")))
    rows = explode.explode_crumbs(goods, "crumbs")
    return rows.select("goodsId", "siteId", "date", "pos", F.get_json_object("item", "$.optId").alias("optId"))


on("e1_explode_crumbs", _e1, with_tables(_GOODS, """
SELECT goodsId, siteId, date, CAST(i - 1 AS INT) AS pos, json_extract_string(list[i], '$.optId') AS optId FROM (
  SELECT goodsId, siteId, date, from_json(crumbOptList, '["json"]') AS list, unnest(generate_series(1, 5)) AS i
  FROM dwd_goods_base WHERE siteId <> 0) WHERE i <= len(list)
UNION ALL
SELECT goodsId, siteId, date, CAST(i AS INT), CAST(CASE WHEN i = 0 THEN siteId ELSE goodsId END AS VARCHAR)
FROM dwd_goods_base, (SELECT unnest([0, 1]) AS i) WHERE siteId = 0"""))


def _outer(t, table, col, field):
    rows = explode.explode_list_outer(t.clean[table], col)
    return rows.select("mallId", "siteId", "date", F.get_json_object("item", f"$.{field}").alias(field))


_OUTER = """
SELECT mallId, siteId, date, json_extract_string(e, '$.{f}') AS {f} FROM (
  SELECT mallId, siteId, date, unnest(CASE WHEN optList IS NULL THEN [CAST(NULL AS JSON)]
    ELSE from_json(optList, '["json"]') END) AS e FROM dwd_malls_base)"""
on("e2_explode_list_outer", lambda t: _outer(t, "dwd_malls_base", "optList", "optId"),
   with_tables(_MALLS, _OUTER.replace("{f}", "optId")))
on("e3_explode_list_outer_load_more", lambda t: _outer(t, "dwd_malls_base", "optList", "optName"),
   with_tables(_MALLS, _OUTER.replace("{f}", "optName")))


def _e4(t):
    malls = t.clean["dwd_malls_base"]
    rows = explode.explode_aligned_sources(
        malls, [explode.list_items(F.col("scoreNumInfoList")), explode.list_items(F.col("optList"))])
    return rows.select("mallId", "siteId", "date", "source", "pos", "item")


on("e4_explode_aligned_sources", _e4, with_tables(_MALLS, """
SELECT mallId, siteId, date, 0 AS source, 0 AS pos, '{"score":5,"num":' || goodsNum || '}' AS item FROM dwd_malls_base
UNION ALL
SELECT mallId, siteId, date, 1, CAST(i - 1 AS INT), CAST(list[i] AS VARCHAR) FROM (
  SELECT mallId, siteId, date, from_json(optList, '["json"]') AS list, unnest([1, 2, 3, 4]) AS i
  FROM dwd_malls_base WHERE optList IS NOT NULL)"""))


def _e5(t):
    docs = t["events"].select("event_id", F.expr(
        """CASE event_id % 3 WHEN 0 THEN concat('[{"sold":', user_id, '},"x",{"sold":"7"}]') WHEN 1 THEN '{"sold":1}' END"""
    ).alias("history"))
    return explode.explode_history(docs, "history", "sold string").select("event_id", F.col("entry.sold").alias("sold"))


on("e5_explode_history", _e5, """
SELECT event_id, unnest([CAST(user_id AS VARCHAR), '7']) AS sold FROM events WHERE event_id % 3 = 0""")
on("e6_explode_json_array", lambda t: explode.explode_json_array(
    t.clean["dwd_goods_base"], "gallery", "url string, priority int")
   .select("goodsId", "siteId", "date", "item.url", "item.priority"), with_tables(_GOODS, """
SELECT goodsId, siteId, date, json_extract_string(e, '$.url') AS url,
  CAST(json_extract_string(e, '$.priority') AS INT) AS priority
FROM (SELECT goodsId, siteId, date, unnest(CASE WHEN gallery LIKE '[%' THEN from_json(gallery, '["json"]')
        ELSE [CAST(gallery AS JSON)] END) AS e FROM dwd_goods_base WHERE gallery IS NOT NULL)"""))
on("e7_explode_json_map", lambda t: explode.explode_json_map(
    t.clean["dwd_goods_base"], "skuList", "stockQuantity bigint")
   .select("goodsId", "siteId", "date", "key", "item.stockQuantity"), with_tables(_GOODS, """
SELECT goodsId, siteId, date, key,
  CAST(json_extract_string(skuList, '$."' || key || '".stockQuantity') AS BIGINT) AS stockQuantity
FROM (SELECT goodsId, siteId, date, skuList, unnest(json_keys(skuList)) AS key FROM dwd_goods_base
      WHERE skuList IS NOT NULL)"""))
on("e8_unpivot_path", lambda t: explode.unpivot_path(
    t.clean["dwd_goods_base"].select("goodsId", "siteId", "date", "crumbOptList", "optId"), "crumbOptList", "optId")
   .select("goodsId", "siteId", "date", "optId"), with_tables(_GOODS, """
, c AS (SELECT goodsId, siteId, date, optId AS own, unnest([0, 1, 2]) AS i, crumbOptList FROM dwd_goods_base)
, l AS (SELECT *, json_extract_string(crumbOptList, '$[' || i || '].optId') AS id FROM c)
SELECT DISTINCT goodsId, siteId, date, TRY_CAST(id AS INT) AS optId FROM l WHERE TRY_CAST(id AS INT) IS NOT NULL
UNION
SELECT goodsId, siteId, date, CAST(own AS INT) FROM l WHERE own IS NOT NULL
GROUP BY goodsId, siteId, date, own HAVING count(id) = 0"""))

# -- filters ----------------------------------------------------------------------------------

_KEYED = """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN ' ' ELSE event_type END AS name,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id, CAST(ts AS DATE) AS date
FROM {events}
"""
_K = f"WITH k AS ({_KEYED.format(events='events')}) "
on("f1_keep_required", lambda t: filters.keep_required(t.sql(_KEYED), ["name", "user_id"]),
   _K + "SELECT * FROM k WHERE trim(name) <> '' AND user_id IS NOT NULL")


def _f2(t):
    from tidemart.plans.ingest import external_goods
    from tidemart.operators.project import stamp

    docs = t["events"].select(F.expr("""CASE event_id % 4
      WHEN 0 THEN concat('{"data":{"goods":{"goodsId":', event_id, '},"site":{"id":', user_id, '}}}')
      WHEN 1 THEN concat('{"data":{"goods":{"goodsId":"', event_id, '"},"site":{"id":"', user_id, '"}}}')
      WHEN 2 THEN concat('{"data":{"goods":{"goodsId":"x"},"site":{"id":1}}}') ELSE '{"data":[]}' END""").alias("doc"))
    return external_goods(stamp(docs, BIZ_DATE, BIZ_DATE)).select("goodsId", "siteId")


on("f2_external_payload", _f2,
   "SELECT event_id AS goodsId, CAST(user_id AS INT) AS siteId FROM events WHERE event_id % 4 < 2")
on("f3_business_day", lambda t: filters.for_day(_dated(t), BIZ_DATE).select("event_id", "date"),
   f"SELECT event_id, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = {_BIZ}")
on("f4_day_before", lambda t: filters.for_day(_dated(t), BIZ_DATE, -1).select("event_id", "date"),
   f"SELECT event_id, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = CAST({_BIZ} - INTERVAL '1' DAY AS DATE)")
on("f5_null_key_guard", lambda t: filters.keep_required(t.sql(_KEYED), ["user_id"]).groupBy("user_id").agg(
    F.count("*").alias("n")), _K + "SELECT user_id, count(*) AS n FROM k WHERE user_id IS NOT NULL GROUP BY ALL")

# -- joins ------------------------------------------------------------------------------------

on("j1_enrich", lambda t: joins.enrich(
    t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey")),
    t["part"].select("p_partkey", "p_brand"), ["p_partkey"]),
   "SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
on("j2_enrich_text_key", lambda t: joins.enrich(
    t["events"].select("event_id", F.col("user_id").cast("string").alias("key")),
    t["customer"].select(F.col("c_custkey").alias("key"), "c_name"), ["key"], text_keys=("key",)),
   "SELECT event_id, CAST(user_id AS VARCHAR) AS key, c_name FROM events LEFT JOIN customer ON user_id = c_custkey")

_ASOF = """SELECT d.user_id, d.n, d.last_id, d.date, stat_date FROM daily d JOIN days ON d.date <= stat_date
  QUALIFY row_number() OVER (PARTITION BY d.user_id, stat_date ORDER BY d.date DESC) = 1"""
on("j3_asof_expand", lambda t: asof.asof_expand(t.sql(DAILY), ["user_id"], _spine(t)), _D + _ASOF)
on("j4_validity_join", lambda t: asof.expand_days(
    keyed.validity_intervals(t.sql(DAILY), ["user_id"]), _spine(t)).select("user_id", "date", "next_date", "stat_date"),
   _D + """, iv AS (SELECT *, lead(date) OVER (PARTITION BY user_id ORDER BY date) AS next_date FROM daily)
SELECT user_id, date, next_date, stat_date FROM iv JOIN days
  ON stat_date >= date AND (next_date IS NULL OR stat_date < next_date)""")
on("j5_on_spine_days", lambda t: joins.on_days(
    t.sql(DAILY), keyed.date_spine(_dated(t).where("event_type = 'purchase'"))),
   _D + "SELECT d.*, stat_date FROM daily d JOIN (SELECT DISTINCT CAST(ts AS DATE) AS stat_date FROM events "
   "WHERE event_type = 'purchase') ON d.date = stat_date")
on("j6_parameter", lambda t: joins.with_parameter(t.sql(DAILY), "stat_date", BIZ_DATE),
   _D + f"SELECT *, {_BIZ} AS stat_date FROM daily")
_LISTED = """
, listed AS (
  SELECT mallId, siteId, date, CAST(json_extract_string(e, '$.optId') AS INT) AS optId
  FROM (SELECT mallId, siteId, date, unnest(from_json(optList, '["json"]')) AS e FROM dwd_malls_base
        WHERE optList IS NOT NULL)
  WHERE json_type(e, '$.optId') IN ('UBIGINT', 'BIGINT'))
"""
_CM = ["dwd_category_base", "dwd_malls_base"]
on("j7_contains_join", lambda t: joins.contains_join(
    t.clean["dwd_category_base"].select("optId", "siteId", "date"),
    t.clean["dwd_malls_base"].select("mallId", "siteId", "date", "optList"), "optList", "optId", "optId",
    ["siteId", "date"]).select("optId", "siteId", "date", "mallId"), with_tables(_CM, _LISTED + """
SELECT DISTINCT optId, siteId, date, mallId FROM dwd_category_base JOIN listed USING (optId, siteId, date)"""))
on("j8_self_lookup", lambda t: joins.enrich(
    filters.for_day(t.clean["dwd_goods_base"], BIZ_DATE).select("goodsId", "siteId", "date"),
    joins.stored_minimum(t.clean["dws_goods_daily"], ["goodsId", "siteId"], ["firstAddTime"]), ["goodsId", "siteId"]),
   with_tables(["dwd_goods_base", "dws_goods_daily"], f"""
SELECT goodsId, siteId, date, s.firstAddTime FROM dwd_goods_base
LEFT JOIN (SELECT goodsId, siteId, min(firstAddTime) AS firstAddTime FROM dws_goods_daily GROUP BY ALL) s
  USING (goodsId, siteId) WHERE date = {_BIZ}"""))

# -- aggregates -------------------------------------------------------------------------------

on("a1_first_seen", lambda t: keyed.first_seen(t["orders"], ["o_custkey"], F.to_date("o_orderdate")),
   "SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_date FROM orders GROUP BY ALL")
on("a2_first_seen_asof", lambda t: asof.first_seen_asof(
    keyed.first_seen(t.sql(DAILY), ["user_id"]), _spine(t), "first_date"),
   _D + """SELECT user_id, min(date) AS first_date, stat_date FROM daily JOIN days ON date <= stat_date
GROUP BY user_id, stat_date""")
on("a3_first_review_day", lambda t: keyed.first_seen(
    t.clean["dwd_review_base"], ["goodsId", "siteId"], keyed.epoch_day(F.col("time")), "firstReviewDate"),
   with_tables(["dwd_review_base"], """
SELECT goodsId, siteId, min(CAST(to_timestamp(time) AT TIME ZONE 'UTC' AS DATE)) AS firstReviewDate
FROM dwd_review_base WHERE time IS NOT NULL GROUP BY ALL"""))
on("a4_rollup_map", lambda t: aggregates.rollup_map(
    t.clean["dwd_goods_base"].select("goodsId", "siteId", "date", "skuList"), "skuList").drop("skuList"),
   with_tables(_GOODS, """
, k AS (SELECT goodsId, siteId, date, skuList, unnest(json_keys(skuList)) AS key FROM dwd_goods_base WHERE skuList IS NOT NULL)
, s AS (SELECT goodsId, siteId, date,
  CAST(sum(coalesce(CAST(json_extract_string(skuList, '$."' || key || '".stockQuantity') AS BIGINT), 0)) AS BIGINT) AS q,
  max(coalesce(CAST(json_extract_string(skuList, '$."' || key || '".isOnsale') AS BIGINT), 0)) AS o FROM k GROUP BY ALL)
SELECT goodsId, siteId, date, q AS stockQuantity, o AS maxSkuIsOnsale FROM dwd_goods_base
LEFT JOIN s USING (goodsId, siteId, date)"""))
on("a5_ordered_json_list", lambda t: t.clean["dwd_goods_base"].select(
    "goodsId", "siteId", "date", aggregates.gallery_urls(F.col("gallery")).alias("urls")), with_tables(_GOODS, """
, e AS (SELECT goodsId, siteId, date, unnest(CASE WHEN gallery LIKE '[%' THEN from_json(gallery, '["json"]')
          ELSE [CAST(gallery AS JSON)] END) AS e FROM dwd_goods_base WHERE gallery IS NOT NULL)
, u AS (SELECT goodsId, siteId, date, json_extract_string(e, '$.url') AS url,
          min(CAST(json_extract_string(e, '$.priority') AS INT)) AS p FROM e GROUP BY ALL)
, l AS (SELECT goodsId, siteId, date, '["' || string_agg(url, '","' ORDER BY p, url) || '"]' AS urls FROM u
        WHERE url <> '' GROUP BY ALL)
SELECT goodsId, siteId, date, urls FROM dwd_goods_base LEFT JOIN l USING (goodsId, siteId, date)"""))

_METRICS = """SELECT event_type, count(DISTINCT user_id) AS users,
  count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS big_users,
  CAST(sum(CASE WHEN event_id % 2 = 0 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS even_sum FROM events GROUP BY ALL"""


def _metrics(t):
    even = F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 100).otherwise(0)
    return aggregates.daily_metrics(
        t["events"], ["event_type"], "user_id", {"even_sum": even}, {"big_users": F.col("value") > 50}, "users")


for _name, _keep in (("a6_distinct_count", "users"), ("a7_conditional_distinct_count", "big_users"),
                     ("a8_conditional_sum", "even_sum")):
    on(_name, lambda t, keep=_keep: _metrics(t).select("event_type", keep),
       f"SELECT event_type, {_keep} FROM ({_METRICS})")

_LINES = """
SELECT l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS BIGINT) AS qty,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(round(l_extendedprice, 0) AS BIGINT) END AS low,
  CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE CAST(round(l_extendedprice + 5, 0) AS BIGINT) END AS high
FROM {lineitem}
"""
_L = f"WITH lines AS ({_LINES.format(lineitem='lineitem')}) "
on("a9_revenue", lambda t: t.sql(_LINES).groupBy("l_suppkey").agg(
    F.sum(aggregates.revenue(F.col("qty"), F.col("low"), F.col("high"))).alias("revenue")),
   _L + "SELECT l_suppkey, CAST(sum(qty * coalesce(low, high, 0)) AS BIGINT) AS revenue FROM lines GROUP BY ALL")
on("a10_revenue_in_units", lambda t: t.sql(_LINES).groupBy("l_suppkey").agg(
    aggregates.to_units(F.sum(aggregates.revenue(F.col("qty"), F.col("low")))).alias("revenue")),
   _L + "SELECT l_suppkey, CAST(CAST(sum(qty * coalesce(low, 0)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(20,2)) AS revenue "
   "FROM lines GROUP BY ALL")
on("a11_previous_day", lambda t: joins.enrich(
    t.sql(DAILY), aggregates.previous_day(t.sql(DAILY).select("user_id", "date", F.col("n").alias("previous"))),
    ["user_id", "date"]),
   _D + """SELECT a.*, b.n AS previous FROM daily a LEFT JOIN daily b
  ON a.user_id = b.user_id AND b.date = CAST(a.date - INTERVAL '1' DAY AS DATE)""")
on("a12_latest_day_asof", lambda t: asof.asof_latest_day(t.sql(DAILY), ["user_id"], _spine(t)),
   _D + """SELECT user_id, stat_date, max(date) AS latest_date FROM daily JOIN days ON date <= stat_date
GROUP BY user_id, stat_date""")
on("a13_distinct_rows", lambda t: keyed.distinct_rows(_dated(t), ["user_id", "event_type", "date"]),
   "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS date FROM events")
on("a14_store_counts", lambda t: joins.count_listing(
    t.clean["dwd_category_base"].select("optId", "siteId", "date"), t.clean["dwd_malls_base"], "optList", "optId",
    "optId", ["siteId", "date"], "mallId", "stores"), with_tables(_CM, _LISTED + """
SELECT c.optId, c.siteId, c.date, count(DISTINCT mallId) AS stores FROM dwd_category_base c
LEFT JOIN listed l ON l.optId = c.optId AND l.siteId = c.siteId AND l.date = c.date GROUP BY ALL"""))
on("a15_cumulative_distinct", lambda t: asof.cumulative_distinct(
    _dated(t), ["event_type"], "user_id", _spine(t), out="users"),
   _D + """SELECT event_type, stat_date, count(DISTINCT user_id) AS users FROM events
JOIN days ON CAST(ts AS DATE) <= stat_date GROUP BY ALL""")
on("a15_cumulative_latest_sum", lambda t: asof.cumulative_latest_sum(
    t.sql(DAILY).withColumn("grp", F.col("user_id") % 7), ["grp"], ["user_id"], _spine(t), {"total": F.col("n")}),
   _D + f"""SELECT user_id % 7 AS grp, stat_date, CAST(sum(n) AS BIGINT) AS total FROM ({_ASOF}) GROUP BY ALL""")

# -- windows and sets -------------------------------------------------------------------------

on("w1_latest_per_key", lambda t: keyed.latest_per_key(_dated(t), ["user_id", "date"], ["ts", "event_id"])
   .select("user_id", "date", "event_id", "event_type", "value"),
   """SELECT user_id, CAST(ts AS DATE) AS date, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
on("w2_latest_per_key_and_day", lambda t: asof.asof_expand(
    keyed.latest_per_key(_dated(t), ["event_type", "date"], ["ts", "event_id"]).select("event_type", "date", "event_id"),
    ["event_type"], _spine(t)),
   _D + """SELECT event_type, CAST(ts AS DATE) AS date, event_id, stat_date FROM events
JOIN days ON CAST(ts AS DATE) <= stat_date
QUALIFY row_number() OVER (PARTITION BY event_type, stat_date ORDER BY ts DESC, event_id DESC) = 1""")
on("w3_validity_intervals", lambda t: keyed.validity_intervals(t.sql(DAILY), ["user_id"]),
   _D + "SELECT *, lead(date) OVER (PARTITION BY user_id ORDER BY date) AS next_date FROM daily")
on("w4_running_min", lambda t: keyed.running_min(
    t.sql(DAILY), ["user_id"], "date", {"first_date": F.col("date"), "least_n": F.col("n")}),
   _D + """SELECT *, min(date) OVER w AS first_date, min(n) OVER w AS least_n FROM daily
WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
on("u1_date_spine", lambda t: _spine(t), _D + "SELECT stat_date FROM days")
on("u2_date_spine_of_tables", lambda t: keyed.date_spine(
    t["orders"].select(F.to_date("o_orderdate").alias("date")), t["lineitem"].select(F.to_date("l_shipdate").alias("date"))),
   "SELECT CAST(o_orderdate AS DATE) AS stat_date FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem")
on("u3_union_all", lambda t: t["customer"].select(
    F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).unionByName(
    t["supplier"].select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))),
   "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier")

# -- derived columns --------------------------------------------------------------------------


def _derived(name, table, rule, oracle, keys=("goodsId", "siteId", "date")):
    on(name, lambda t: d.derive(t.clean[table], {"v": rule()}).select(*keys, "v"),
       with_tables([table], f" SELECT {', '.join(keys)}, {oracle} AS v FROM {table}"))


_derived("d1_first_non_empty", "dwd_goods_base", lambda: d.first_non_empty(F.col("thumbUrl"), F.col("imageUrl")),
         "coalesce(nullif(thumbUrl, ''), nullif(imageUrl, ''))")
_derived("d2_image_list", "dwd_goods_base", lambda: d.image_list(F.col("video"), F.col("thumbUrl")),
         """coalesce(video, '["' || thumbUrl || '"]', '[]')""")
_derived("d3_stock_status", "dwd_external_goods_daily", lambda: d.stock_status(F.col("status"), F.col("quantity")),
         "CAST(CASE WHEN status = 1 AND quantity > 0 THEN 0 ELSE 2 END AS BIGINT)")
_derived("d4_earliest", "dwd_external_goods_daily",
         lambda: d.earliest(F.lit(BIZ_DATE).cast("date"), F.to_date("onSaleTime"), F.when(F.col("status") == 1, F.col("date"))),
         f"coalesce(least(CAST(onSaleTime AS DATE), CASE WHEN status = 1 THEN date END), {_BIZ})")
_derived("d5_to_minor_units", "dwd_external_goods_daily", lambda: d.to_minor_units(F.col("minPrice"), F.col("cents")),
         "CAST(round(minPrice * coalesce(cents, 100), 0) AS BIGINT)")
_derived("d6_guarded_average", "dwd_external_goods_daily",
         lambda: d.guarded_average(F.col("reviewNum").cast("decimal(20,2)"), F.col("quantity")),
         "CAST(CASE WHEN coalesce(quantity, 0) = 0 THEN 0 ELSE "
         "CAST((200 * reviewNum + quantity) // (2 * quantity) AS DECIMAL(18,0)) * 0.01 END AS DECIMAL(20,2))")
_derived("d7_change_rate", "dwd_external_goods_daily", lambda: d.change_rate(F.col("sold"), F.col("quantity")),
         "CAST(CASE WHEN quantity <> 0 THEN sign(sold - quantity) * CAST((20000 * abs(sold - quantity) + quantity) "
         "// (2 * quantity) AS DECIMAL(14,0)) * 0.0001 END AS DECIMAL(18,4))")
_derived("d8_flag_code", "dwd_goods_base", lambda: d.flag_code(F.col("semiManaged")),
         "CAST(CASE WHEN semiManaged THEN 1 ELSE 0 END AS INT)")
on("d9_chinese_comment", lambda t: t["documents"].select("doc_id", d.chinese_comment(
    F.when(F.col("lang") == "zh", "zh-CN").otherwise(F.col("lang")), F.col("text"),
    F.concat(F.lit('{"translateComment":"'), "source", F.lit('"}'))).alias("v")),
   "SELECT doc_id, CASE WHEN lang = 'zh' THEN text ELSE source END AS v FROM documents")
_derived("d10_media_list", "dwd_review_base", lambda: d.media_list(F.col("list"), F.col("pictures")),
         "coalesce(list, pictures)", ("reviewId",))
