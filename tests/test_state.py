"""Kept minima, published versions and merges of raw days."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.plans import gold
from tidemart.operators.asof import next_distinct
from tidemart.plans.gold import build_day, build_external_goods_daily, build_goods_daily, rebuild_days
from tidemart.schemas import STATES, TABLES
from tidemart.sources.tables import Warehouse

DAYS = [f"2024-01-{d:02d}" for d in range(1, 11)]


def clean(spark, table, rows):
    """Rows of a table from dictionaries, other columns NULL."""
    names = sorted({name for row in rows for name in row})
    df = spark.createDataFrame([tuple(str(r[n]) if r.get(n) is not None else None for n in names) for r in rows],
                               ", ".join(f"`{n}` string" for n in names))
    return df.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in TABLES[table].schema])


def made(days, seed=1):
    """Rows of each clean table and day."""
    draw, out = random.Random(seed), {}
    epoch = lambda day, back: int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.UTC).timestamp()) - 86400 * back
    for day in days:
        some = lambda n: [i for i in range(n) if draw.random() < 0.5]
        out["dwd_goods_base", day] = [{"goodsId": i, "siteId": 1, "date": day, "mallId": i % 3, "title": f"{i} {day}",
                                       "salesNum": draw.randint(1, 9), "minOnSalePrice": 10} for i in some(8)]
        out["dwd_review_base", day] = [{"reviewId": f"{i}-{day}", "goodsId": i, "siteId": 1, "date": day,
                                        "time": epoch(day, draw.randint(0, 40))} for i in some(8)]
        out["dwd_external_goods_daily", day] = [
            {"goodsId": i, "siteId": 1, "date": day, "sold": draw.randint(1, 9),
             "onSaleTime": f"2023-12-{draw.randint(1, 28):02d} 00:00:00" if draw.random() < 0.6 else None} for i in some(8)]
        out["dwd_malls_base", day] = [{"mallId": i, "siteId": 1, "date": day, "mallName": day} for i in some(3)]
    return out


def history(spark, days):
    return {key: clean(spark, key[0], rows) for key, rows in made(days).items() if rows}


def by_hand(rows, order):
    """First-seen dates of the daily products and stores, from all that has arrived by each build."""
    arrived, goods, malls = [], {}, {}
    least = lambda *days: min((d for d in days if d is not None), default=None)
    for day in order:
        arrived += [(table, row) for (table, at), found in rows.items() if at == day for row in found]
        of = lambda table, key, value: least(
            *[value(r) for t, r in arrived if t == table and (r["goodsId"] if "goodsId" in r else r["mallId"]) == key])
        date, sale = (lambda r: r["date"]), (lambda r: (r["onSaleTime"] or "")[:10] or None)
        reviewed = lambda r: dt.datetime.fromtimestamp(r["time"], dt.UTC).date().isoformat()
        kept = lambda table, key, n: least(*[v[n] for (k, _), v in table.items() if k == key])
        built = {}
        for r in rows.get(("dwd_goods_base", day), ()):
            k, first = r["goodsId"], of("dwd_goods_base", r["goodsId"], date)
            built[k, day] = (kept(goods, k, 0) or first,
                             least(day, kept(goods, k, 1), first, of("dwd_review_base", k, reviewed)))
        goods |= built
        built = {}
        for r in rows.get(("dwd_external_goods_daily", day), ()):
            k, first = r["goodsId"], of("dwd_external_goods_daily", r["goodsId"], date)
            found = sale(r) or of("dwd_external_goods_daily", k, sale) or first
            built[k, day] = (least(day, kept(goods, k, 0), first), least(day, kept(goods, k, 1), found))
        goods |= built
        malls |= {(r["mallId"], day): (None, least(day, kept(malls, r["mallId"], 1), of("dwd_malls_base", r["mallId"], date)))
                  for r in rows.get(("dwd_malls_base", day), ())}
    return goods, malls


def test_ten_days_and_a_late_one(spark, tmp_path, monkeypatch):
    """Dates that come from kept minima equal those of the whole history, however merges fall between the days."""
    monkeypatch.setattr(gold, "BUILDERS", gold.BUILDERS[:3])
    order = [d for d in DAYS if d != DAYS[4]]
    order.insert(7, DAYS[4])  # the fifth day comes late
    rows = made(DAYS)
    lake = Warehouse(spark, str(tmp_path / "kept"), files_per_day=1)
    for n, day in enumerate(order):
        for (table, at), found in rows.items():
            if at == day and found:
                lake.upsert_latest(clean(spark, table, found), table, f"feed-{day}", n)
        build_day(lake, day)
        if n in (2, 6, 7):
            for table in ("dwd_goods_base", "dws_goods_daily", "dwd_review_base"):
                lake.compact(table)
    goods, malls = by_hand(rows, order)
    text = lambda d: None if d is None else str(d)
    assert {(r.goodsId, str(r.date)): (text(r.firstAddTime), text(r.addToRegionTime))
            for r in lake.scan("dws_goods_daily").collect()} == goods
    assert {(r.mallId, str(r.date)): (None, text(r.addToRegionTime)) for r in lake.scan("dws_malls_daily").collect()} == malls
    for name in ("first_goods", "first_review", "stored_goods"):
        want = STATES[name].minima(lake.scan(STATES[name].source))
        assert sorted(map(str, lake.state(name).collect())) == sorted(map(str, want.collect()))


def test_the_plan_reads_one_day_and_states(spark, tmp_path):
    lake = Warehouse(spark, str(tmp_path / "wh"), files_per_day=1)
    for (table, day), df in history(spark, DAYS[:4]).items():
        lake.upsert_latest(df, table, day, 1)
    for table in ("dwd_goods_base", "dwd_review_base"):
        lake.compact(table)
    df = gold.build_goods_daily(lake.tables(), DAYS[1])
    df.collect()
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = [line for line in plan.split("\n") if line.startswith("Location:")]
    assert scans and not any("dwd_review_base/merged" in line for line in scans)
    goods = plan.split("dwd_goods_base/merged")[1]
    assert "PartitionFilters" in goods and DAYS[1] in goods.split("PushedFilters")[0]
    assert sum("dwd_goods_base/merged" in line for line in scans) <= 2  # the initial and the final plan
    assert any("first_review" in line for line in scans) and any("first_goods" in line for line in scans)


def test_states_of_a_table_merged_before_there_were_any(spark, tmp_path, monkeypatch):
    lake, rows = Warehouse(spark, str(tmp_path / "wh"), files_per_day=1), history(spark, DAYS[:3])
    with monkeypatch.context() as old:
        old.setattr("tidemart.sources.tables.STATES", {})
        lake.upsert_latest(rows["dwd_goods_base", DAYS[0]], "dwd_goods_base", "a", 1)
        lake.compact("dwd_goods_base")
    want = lambda: sorted(map(str, STATES["first_goods"].minima(lake.scan("dwd_goods_base")).collect()))
    assert sorted(map(str, lake.state("first_goods").collect())) == want()
    lake.upsert_latest(rows["dwd_goods_base", DAYS[1]], "dwd_goods_base", "b", 1)
    lake.compact("dwd_goods_base")
    assert lake.version("dwd_goods_base").states["first_goods"] == ["_state/first_goods/_v=2"]
    assert sorted(map(str, lake.state("first_goods").collect())) == want()


def test_readers_see_one_version(spark, tmp_path):
    lake = Warehouse(spark, str(tmp_path / "wh"), files_per_day=1)
    rows = lambda *r: clean(spark, "dwd_site_base", [dict(zip(("siteId", "date", "regionId", "regionName"), x)) for x in r])
    read = lambda df: sorted((r.siteId, r.regionName) for r in df.collect())
    lake.upsert_latest(rows((1, DAYS[0], 1, "a"), (2, DAYS[0], 1, "b")), "dwd_site_base", "0", 1)
    lake.compact("dwd_site_base")
    lake.upsert_latest(rows((1, DAYS[0], 1, "new"), (3, DAYS[1], 1, "c")), "dwd_site_base", "1", 2)
    early = lake.scan("dwd_site_base")
    want = [(1, "new"), (2, "b"), (3, "c")]
    version = lake.prepare_merge("dwd_site_base")  # written, not published
    assert read(lake.scan("dwd_site_base")) == want and lake.version("dwd_site_base").number == 1
    lake.publish("dwd_site_base", version)
    with pytest.raises(RuntimeError):
        lake.publish("dwd_site_base", version)
    lake.vacuum("dwd_site_base")
    assert read(early) == want and read(lake.scan("dwd_site_base")) == want
    # An unfinished merge is written over by the next.
    lake.upsert_latest(rows((3, DAYS[1], 1, "d")), "dwd_site_base", "2", 3)
    lake.prepare_merge("dwd_site_base")
    lake.upsert_latest(rows((4, DAYS[2], 1, "e")), "dwd_site_base", "3", 4)
    assert lake.compact("dwd_site_base") == 2
    assert read(lake.scan("dwd_site_base")) == [(1, "new"), (2, "b"), (3, "d"), (4, "e")]
    lake.upsert_latest(rows((5, DAYS[2], 1, "f")), "dwd_site_base", "4", 5)
    lake.compact("dwd_site_base")
    kept = {p.split("_v=")[1].split("/")[0] for p in lake._found("dwd_site_base", "merged/_v=*/date=*")}
    assert "1" not in kept and lake._found("dwd_site_base", "batches/date=*/_batch=0/*.parquet") == []


def test_raw_batches_become_few_files(spark, tmp_path):
    lake = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(4000).selectExpr("int(id % 50) siteId", "date'2024-01-01' date", "1 regionId", "string(id) regionName")
    for batch in range(20):
        lake.append_raw(rows.where(F.col("regionName").cast("int") % 20 == batch).repartition(2), "ods_site_raw", batch)
    before = sorted(map(str, lake.scan("ods_site_raw").collect()))
    files = lambda: lake.scan("ods_site_raw").select(F.input_file_name()).distinct().count()
    assert files() == 40 and lake.compact("ods_site_raw") == 1 and files() <= 2
    assert sorted(map(str, lake.scan("ods_site_raw").collect())) == before and len(before) == 4000
    keys = [r.siteId for r in lake.scan("ods_site_raw").coalesce(1).collect()]
    assert keys == sorted(keys)
    for _ in range(2):  # the batch, and its replay
        lake.append_raw(rows.limit(5), "ods_site_raw", "more")
    lake.compact("ods_site_raw")
    assert lake.scan("ods_site_raw").count() == 4005
    assert len(lake.version("ods_site_raw").days["2024-01-01"]) == 2  # the first merge isn't written again


@pytest.mark.parametrize("history_name, build", [("goods", build_goods_daily), ("external", build_external_goods_daily)])
def test_ranges_of_days_equal_the_whole_rebuild(spark, tmp_path, history_name, build):
    lake = Warehouse(spark, str(tmp_path / "wh"), files_per_day=1)
    rows = {}
    for (table, day), df in history(spark, DAYS).items():
        if day != DAYS[5]:  # a day without rows
            rows[table] = rows[table].unionAll(df) if table in rows else df
    for table, df in rows.items():
        lake.upsert_latest(df, table, "all", 1)
    for first, last in ((DAYS[0], DAYS[1]), (DAYS[2], DAYS[5]), (DAYS[6], DAYS[6]), (DAYS[7], DAYS[9])):
        rebuild_days(lake, history_name, first, last, 5)
    assert lake.edges(history_name) == [DAYS[1], DAYS[5], DAYS[6], DAYS[9]]
    want = sorted(map(str, build(lake.tables()).collect()))
    assert sorted(map(str, lake.scan("dws_goods_daily").collect())) == want and len(want) > 40
    rebuild_days(lake, history_name, DAYS[2], DAYS[6], 6)  # again, as one range
    assert sorted(map(str, lake.scan("dws_goods_daily").collect())) == want
    # Without earlier ranges the edge comes from the rows themselves.
    other = Warehouse(spark, str(tmp_path / "other"), files_per_day=1)
    for table, df in rows.items():
        other.upsert_latest(df, table, "all", 1)
    rebuild_days(other, history_name, DAYS[7], DAYS[9], 5)
    late = build(lake.tables()).where(F.col("date") >= DAYS[7])
    assert sorted(map(str, other.scan("dws_goods_daily").collect())) == sorted(map(str, late.collect()))
    with pytest.raises(ValueError):
        lake._delete(f"{lake.root}/_edges/{history_name}/{DAYS[6]}")
        rebuild_days(lake, history_name, DAYS[8], DAYS[9], 7)


def test_distinct_counts_from_day_to_day(spark):
    draw = random.Random(4)
    rows = [(day, draw.choice("ab"), draw.choice([None, *range(12)])) for day in range(6) for _ in range(9)]
    df = spark.createDataFrame(rows, "day int, k string, id int")
    index, totals = df.where("false").select("k", "id"), spark.createDataFrame([], "k string, distinct_count long")
    for day in range(6):
        totals, new = next_distinct(df.where(F.col("day") == day), ["k"], "id", index, totals)
        index = index.unionByName(new)
        want = {k: len({i for at, key, i in rows if key == k and at <= day and i is not None}) for k in "ab"}
        assert {r.k: r.distinct_count for r in totals.collect()} == {k: n for k, n in want.items() if n}
