"""Writing, replaying, merging and streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemart.sources.readers import backfill_lines, read_source, resolve_options
from tidemart.sources.tables import Warehouse
from tidemart.streaming.runner import launch_feed, run_feed

SITE = ("siteId", "date", "regionId")


def sites(spark, *rows):
    df = spark.createDataFrame(rows, "siteId int, date string, regionId int, regionName string")
    return df.withColumn("date", F.col("date").cast("date"))


def names(df):
    return sorted((r.siteId, str(r.date), r.regionName) for r in df.collect())


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), files_per_day=2)


def test_upsert_replay_and_merge(spark, warehouse):
    first = sites(spark, (1, "2024-01-01", 1, "a"), (2, "2024-01-01", 1, "b"), (1, "2024-01-02", 1, "c"))
    second = sites(spark, (1, "2024-01-01", 1, "a2"))
    warehouse.upsert_latest(first, "dwd_site_base", "f-0", 10)
    warehouse.upsert_latest(second, "dwd_site_base", "f-1", 20)
    want = [(1, "2024-01-01", "a2"), (1, "2024-01-02", "c"), (2, "2024-01-01", "b")]
    assert names(warehouse.scan("dwd_site_base")) == want
    warehouse.upsert_latest(first, "dwd_site_base", "f-0", 10)  # the same batch once more
    assert names(warehouse.scan("dwd_site_base")) == want
    assert warehouse.compact("dwd_site_base") == 2
    assert names(warehouse.scan("dwd_site_base")) == want
    assert warehouse.compact("dwd_site_base") == 0
    warehouse.upsert_latest(sites(spark, (2, "2024-01-01", 1, "b2")), "dwd_site_base", "f-2", 30)
    assert names(warehouse.scan("dwd_site_base", [dt.date(2024, 1, 1)])) == [
        (1, "2024-01-01", "a2"), (2, "2024-01-01", "b2")]
    plan = warehouse.scan("dwd_site_base", [dt.date(2024, 1, 1)])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan or "date#" in plan


def test_replay_after_merge_and_writers_with_one_id(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    old = sites(spark, (1, "2024-01-01", 1, "old"), (3, "2024-01-03", 1, "far"), (4, None, 1, "undated"))
    warehouse.upsert_latest(old, "dwd_site_base", 7, 1, writer="feedA")
    warehouse.upsert_latest(sites(spark, (1, "2024-01-01", 1, "new")), "dwd_site_base", 7, 2, writer="feedB")
    want = [(1, "2024-01-01", "new"), (3, "2024-01-03", "far"), (4, "None", "undated")]
    assert names(warehouse.scan("dwd_site_base")) == want
    assert warehouse.compact("dwd_site_base") == 3
    assert names(warehouse.scan("dwd_site_base")) == want
    warehouse.upsert_latest(old, "dwd_site_base", 7, 1, writer="feedA")
    assert names(warehouse.scan("dwd_site_base")) == want
    assert warehouse.compact("dwd_site_base") == 3
    assert names(warehouse.scan("dwd_site_base")) == want


def test_wide_day_is_written_by_many_tasks(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(0, 60000, 1, 40).selectExpr(
        "int(id) siteId", "date'2024-01-01' date", "1 regionId", "sha2(string(id), 256) regionName")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        warehouse.append_raw(rows, "ods_site_raw", "f-0")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = warehouse.scan("ods_site_raw")
    assert written.count() == 60000
    assert written.select(F.input_file_name()).distinct().count() > 16


def test_last_row_of_a_batch_wins(spark, warehouse):
    rows = sites(spark, (1, "2024-01-01", 1, "x"), (1, "2024-01-01", 1, "y")).coalesce(1)
    rows = rows.withColumn("_arrival", F.monotonically_increasing_id())
    warehouse.upsert_latest(rows, "dwd_site_base", "f-0", 1, ["_arrival"])
    assert names(warehouse.scan("dwd_site_base")) == [(1, "2024-01-01", "y")]


def test_publishing_is_finished_after_a_crash(spark, warehouse, monkeypatch):
    warehouse.upsert_latest(sites(spark, (1, "2024-01-01", 1, "a")), "dwd_site_base", "f-0", 1)
    real = Warehouse._delete
    monkeypatch.setattr(Warehouse, "_delete", lambda self, path: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        warehouse.compact("dwd_site_base")
    monkeypatch.setattr(Warehouse, "_delete", real)
    assert names(warehouse.scan("dwd_site_base")) == [(1, "2024-01-01", "a")]
    assert warehouse.compact("dwd_site_base") == 0
    assert names(warehouse.scan("dwd_site_base")) == [(1, "2024-01-01", "a")]


def test_append_keeps_duplicates(spark, warehouse):
    rows = sites(spark, (1, "2024-01-01", 1, "a"), (1, "2024-01-01", 1, "a"))
    warehouse.append_raw(rows, "ods_site_raw", "f-0")
    warehouse.append_raw(rows, "ods_site_raw", "f-1")
    warehouse.append_raw(rows, "ods_site_raw", "f-1")
    assert warehouse.scan("ods_site_raw").count() == 4


def test_stream_to_both_tables(spark, warehouse, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def page(n, name):
        region = {"siteId": n, "regionId": 1, "regionName": name}
        return json.dumps({"webLayoutData": {"headerData": {"region": {"regionInfo": region}}}, "serverTime": 5})

    def run():
        messages = read_source(spark, "lines", str(source))
        run_feed(messages, "product_site", warehouse, str(tmp_path / "cp"), bounded=True,
                 run_date="2024-01-01").awaitTermination()

    (source / "a.txt").write_text("\n".join([page(1, "x"), "{broken", "", page("bad", "y")]))
    run()
    assert names(warehouse.scan("dwd_site_base")) == [(1, "2024-01-01", "x")]
    (source / "b.txt").write_text("\n".join([page(1, "x2"), page(2, "z")]))
    run()
    run()  # nothing new
    assert names(warehouse.scan("dwd_site_base")) == [(1, "2024-01-01", "x2"), (2, "2024-01-01", "z")]
    assert warehouse.scan("ods_site_raw").count() == 3
    rejects = spark.read.json(f"{warehouse.root}/_rejects/rows")
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["dwd_site_base", "ods_site_raw", "unreadable-productDetail"]
    audit = spark.read.parquet(f"{warehouse.root}/_audit/rows")
    assert sorted(r.key for r in audit.where("layer = 'clean'").collect()) == [
        "siteId=1,date=2024-01-01,regionId=1", "siteId=1,date=2024-01-01,regionId=1",
        "siteId=2,date=2024-01-01,regionId=1"]


def test_whole_file_source(spark, tmp_path):
    (tmp_path / "doc.json").write_text('{"a":\n1}')
    df = read_source(spark, "file", str(tmp_path / "doc.json"))
    assert df.isStreaming and df.columns == ["value"]
    (tmp_path / "empty.json").write_text("  ")
    with pytest.raises(ValueError):
        read_source(spark, "file", str(tmp_path / "empty.json"))


@pytest.mark.parametrize("args, local, given, path", [
    ([], False, False, "d"), (["--local"], True, False, "d"), (["--local", "no"], False, False, "d"),
    (["--local=1", "--file=x"], True, True, "x"), (["--file", "x"], False, True, "x"),
    (["--local true --file x"], True, True, "x"), (["--local", "--file", "x"], True, True, "x"),
])
def test_source_options(args, local, given, path):
    got = resolve_options(args, "d")
    assert (got.local, got.file_given, got.path, got.kind) == (local, given, path, "file" if local else "kafka")


def test_bad_source_options():
    with pytest.raises(ValueError):
        resolve_options(["--local", "maybe"])
    with pytest.raises(ValueError):
        resolve_options(["--file"])


def test_backfill_lines(spark):
    df = spark.createDataFrame([('  {"goodsId": "12", "x": {"goodsId": 3}} ',), ("   ",), ("{}",)], "value string")
    assert [tuple(r) for r in backfill_lines(df).collect()] == [
        ("12", '{"goodsId": "12", "x": {"goodsId": 3}}'), (None, "{}")]


def test_feed_from_arguments(spark, warehouse, tmp_path):
    page = {"webLayoutData": {"headerData": {"region": {"regionInfo": {"siteId": 4, "regionId": 1, "regionName": "n"}}}}}
    (tmp_path / "doc.json").write_text(json.dumps(page, indent=1))
    args = ["--local", "--file", str(tmp_path / "doc.json")]
    launch_feed(spark, "product_site", args, warehouse, str(tmp_path / "cp"), run_date="2024-01-01",
                audit="counts").awaitTermination()
    assert names(warehouse.scan("dwd_site_base")) == [(4, "2024-01-01", "n")]
    counts = spark.read.parquet(f"{warehouse.root}/_audit/counts").collect()
    assert sorted((r.layer, r.table, r.rows, r.rejected) for r in counts) == [
        ("clean", "dwd_site_base", 1, 0), ("raw", "ods_site_raw", 1, 0)]
    for bad in (["--local"], []):
        with pytest.raises(ValueError):
            launch_feed(spark, "product_site", bad, warehouse, str(tmp_path / "cp2"))
