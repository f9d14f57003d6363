"""Queries on kept tables: daily builds from states, rebuilds by ranges of days, versions and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import quality
from tidemart.operators.asof import cumulative_distinct, next_distinct
from tidemart.operators.keyed import date_spine, first_seen
from tidemart.plans import gold
from tidemart.plans.feed_queries import _typed, _warehouse
from tidemart.plans.registry import ORACLES, on
from tidemart.plans.standins import BIZ_DATE, with_tables
from tidemart.schemas import TABLES

_BIZ = f"DATE '{BIZ_DATE}'"


def _stored(t, table: str):
    """A stand-in for rows written earlier, with the table's columns; they have no day."""
    rows = t.clean[table]
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in TABLES[table].schema])


def _from_states(build, daily: str, *clean: str):
    """The increment of one day, its first days kept by a merge or found in batches written since."""
    def run(t):
        lake = _warehouse(t)
        lake.upsert_latest(_stored(t, daily), daily, "before", 1)
        for table in clean:
            rows = _typed(t, table, table)
            lake.upsert_latest(rows.where(f"date < {_BIZ}"), table, "early", 1)
            lake.compact(table)
            lake.upsert_latest(rows.where(f"date >= {_BIZ} OR date IS NULL"), table, "late", 2)
        return build(lake.tables(), BIZ_DATE)
    return run


on("g1_goods_from_states", _from_states(gold.build_goods_daily, "dws_goods_daily", "dwd_goods_base", "dwd_review_base"),
   ORACLES["g1_goods_daily_increment"])
on("g3_external_from_states", _from_states(gold.build_external_goods_daily, "dws_goods_daily", "dwd_external_goods_daily"),
   ORACLES["g3_external_goods_daily_increment"])
on("g5_malls_from_states", _from_states(gold.build_malls_daily, "dws_malls_daily", "dwd_goods_base", "dwd_malls_base"),
   ORACLES["g5_malls_daily_increment"])


def _in_ranges(history: str, *clean: str):
    """The whole history built in three ranges of days, each going on from the one before."""
    def run(t):
        lake = _warehouse(t)
        for table in clean:
            lake.upsert_latest(_typed(t, table, table), table, "all", 1)
        for first, last in (("2024-01-01", "2024-01-09"), ("2024-01-10", "2024-01-10"), ("2024-01-11", "2024-12-31")):
            gold.rebuild_days(lake, history, first, last, 1)
        return lake.scan("dws_category_daily" if history == "category" else "dws_goods_daily")
    return run


on("g2_goods_in_ranges", _in_ranges("goods", "dwd_goods_base", "dwd_review_base"), ORACLES["g2_goods_daily_rebuild"])
on("g4_external_in_ranges", _in_ranges("external", "dwd_external_goods_daily"), ORACLES["g4_external_goods_daily_rebuild"])
on("g8_category_in_ranges", _in_ranges("category", "dwd_category_base", "dwd_goods_base", "dwd_malls_base"),
   ORACLES["g8_category_daily_rebuild"])


def _next_day(t):
    """Cumulative ids of a day from its own rows, the ids seen before and the totals of the day before."""
    rows = t["events"].withColumn("date", F.to_date("ts"))
    early = rows.where(f"date < {_BIZ}")
    index = first_seen(early, ["event_type", "user_id"])
    totals = cumulative_distinct(early, ["event_type"], "user_id", date_spine(early), out="users")
    totals = totals.where(F.col("stat_date") == F.date_sub(F.expr(_BIZ), 1))
    return next_distinct(rows.where(f"date = {_BIZ}"), ["event_type"], "user_id", index, totals, "users")[0]


on("a15_next_day", _next_day, f"""
SELECT event_type, count(DISTINCT user_id) AS users FROM events WHERE CAST(ts AS DATE) <= {_BIZ} GROUP BY ALL""")


def _read_while_merging(t):
    """A table read before a merge, between its writing and its publishing, and after; the first frame is read last."""
    lake, rows = _warehouse(t), _typed(t, "dwd_goods_base", "dwd_goods_base")
    lake.upsert_latest(rows, "dwd_goods_base", "a", 1)
    lake.compact("dwd_goods_base")
    lake.upsert_latest(rows.where("siteId = 0").withColumn("title", F.lit("new")), "dwd_goods_base", "b", 2)
    early = lake.scan("dwd_goods_base")
    version = lake.prepare_merge("dwd_goods_base")
    between = lake.scan("dwd_goods_base")
    lake.publish("dwd_goods_base", version)
    lake.vacuum("dwd_goods_base")
    states = (("before", early), ("between", between), ("after", lake.scan("dwd_goods_base")))
    parts = [df.select(F.lit(name).alias("state"), "goodsId", "siteId", "date", "title") for name, df in states]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


on("k7_read_while_merging", _read_while_merging, with_tables(["dwd_goods_base"], """
SELECT state, goodsId, siteId, date, CASE WHEN siteId = 0 THEN 'new' ELSE title END AS title
FROM dwd_goods_base, (VALUES ('before'), ('between'), ('after')) v(state)"""))


def _merged_raw(t):
    """Raw batches of whole days, one replayed, merged by key: all rows, in few files a day."""
    lake, rows = _warehouse(t), _typed(t, "dwd_review_base", "ods_review_raw")
    for batch in (0, 1, 2, 2):
        lake.append_raw(rows.where(F.pmod(F.xxhash64("reviewId"), F.lit(3)) == batch), "ods_review_raw", f"feed-{batch}")
    lake.compact("ods_review_raw")
    lake.append_raw(rows, "ods_review_raw", "later")
    lake.compact("ods_review_raw")
    files = lake.scan("ods_review_raw").select("date", F.input_file_name().alias("file"))
    return files.groupBy("date").agg(F.count("*").alias("n"), (F.count_distinct("file") <= 8).alias("few_files"))


on("k4_merged_raw_days", _merged_raw, """
SELECT CAST(ts AS DATE) AS date, 2 * count(*) AS n, true AS few_files FROM events GROUP BY ALL""")


def _too_long(t):
    """Texts around their bounds, some of characters of two bytes."""
    rows = t["events"].select(
        (F.col("event_id") % 4).alias("siteId"), F.col("user_id").alias("regionId"), F.to_date("ts").alias("date"),
        F.expr("repeat('é', int(event_id % 13))").alias("phoneCode"), F.expr("repeat('x', int(event_id % 300))").alias("regionName"))
    good, rejects = quality.enforce_schema(rows, TABLES["dwd_site_base"])
    return good.select("regionId", F.lit("").alias("why"), F.length("regionName").alias("n")).unionByName(
        rejects.select(F.get_json_object("row", "$.regionId").cast("bigint").alias("regionId"),
                       F.concat_ws(",", "reasons").alias("why"), F.lit(None).cast("int").alias("n")))


on("k8_text_lengths", _too_long, """
SELECT user_id AS regionId, CASE WHEN long AND wide THEN 'regionName: over 255 bytes,phoneCode: over 20 bytes'
    WHEN long THEN 'regionName: over 255 bytes' WHEN wide THEN 'phoneCode: over 20 bytes' ELSE '' END AS why,
  CASE WHEN NOT long AND NOT wide THEN event_id % 300 END AS n
FROM (SELECT user_id, event_id, event_id % 300 > 255 AS long, strlen(repeat('é', CAST(event_id % 13 AS INT))) > 20 AS wide
      FROM events)""")
