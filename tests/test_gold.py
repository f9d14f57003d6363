"""Daily builds: large values, ids named by lists, and days written in a row."""

from pyspark.sql import functions as F

from tidemart.operators.aggregates import gallery_urls
from tidemart.operators.asof import right_edge
from tidemart.operators.joins import listed_ids
from tidemart.plans.gold import _load, build_day, build_goods_daily, build_malls_daily, goods_history, rebuild_days
from tidemart.schemas import TABLES
from tidemart.sources.tables import Warehouse


def row(spark, table, **given):
    """One row of the table, NULL but for the given columns."""
    return spark.range(1).select(*[
        F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in TABLES[table].schema])


def test_ids_are_whole_numbers_of_the_entry_itself(spark):
    text = ('[{"optId":"7","x":{"optId":5}},{"optId":5.5},{"optId":4},{"x":{"optId":3}},'
            '{"optId":4},{"optId":null},{"optId":true},8]')
    df = spark.createDataFrame([(text,), (None,), ("[]",)], "t string")
    found = [r[0] for r in df.select(listed_ids(F.col("t"), "optId")).collect()]
    assert found[0] == [4] and not found[1] and not found[2]


def test_counts_above_int_do_not_stop_the_build(spark):
    day = "2024-01-02"
    tables = {name: spark.createDataFrame([], TABLES[name].schema) for name in TABLES}
    tables["dwd_malls_base"] = row(spark, "dwd_malls_base", mallId=1, siteId=1, date=day, goodsSalesNum=3_000_000_000) \
        .unionAll(row(spark, "dwd_malls_base", mallId=2, siteId=1, date=day, goodsSalesNum=5))
    tables["dwd_goods_base"] = row(spark, "dwd_goods_base", goodsId=1, siteId=1, date=day, mallId="1",
                                   salesNum=1 << 62, minOnSalePrice=1 << 62) \
        .unionAll(row(spark, "dwd_goods_base", goodsId=2, siteId=1, date=day, mallId="2", salesNum=3, minOnSalePrice=4))
    for when in (day, None):
        got = {r.mallId: (r.goodsSalesNum, r.goodsSalesPrice) for r in build_malls_daily(tables, when).collect()}
        assert got == {1: (None, None), 2: (5, 12)}


def test_figures_that_do_not_fit_are_rejected(spark, tmp_path):
    lake, day = Warehouse(spark, str(tmp_path / "wh")), "2024-01-02"
    malls = [row(spark, "dwd_malls_base", mallId=1, siteId=1, date=day, goodsSalesNum=3_000_000_000),
             row(spark, "dwd_malls_base", mallId=2, siteId=1, date=day, goodsSalesNum=5)]
    goods = [row(spark, "dwd_goods_base", goodsId=1, siteId=1, date=day, mallId="1", salesNum=1 << 62, minOnSalePrice=1 << 62),
             row(spark, "dwd_goods_base", goodsId=2, siteId=1, date=day, mallId="2", salesNum=3, minOnSalePrice=4)]
    lake.upsert_latest(malls[0].unionAll(malls[1]), "dwd_malls_base", day, 1)
    lake.upsert_latest(goods[0].unionAll(goods[1]), "dwd_goods_base", day, 1)
    build_day(lake, day)
    assert [(r.mallId, r.goodsSalesNum, r.goodsSalesPrice) for r in lake.scan("dws_malls_daily").collect()] == [(2, 5, 12)]
    rejects = spark.read.json(f"{lake.root}/_rejects/rows").collect()
    mine = [r for r in rejects if r.reason.startswith("dws_malls_daily")]
    assert len(mine) == 1 and '"mallId":1' in mine[0].row and f"goodsSalesNum: 3000000000 is no int" in mine[0].reasons
    assert any(reason.startswith(f"goodsSalesPrice: {1 << 124}") for reason in mine[0].reasons)
    assert lake.scan("dws_goods_daily").count() == 2


def test_days_in_a_row_keep_stored_dates(spark, tmp_path):
    lake = Warehouse(spark, str(tmp_path / "wh"))
    key = {"goodsId": 1, "siteId": 1}
    stored = row(spark, "dws_goods_daily", **key, date="2024-01-01", firstAddTime="2024-01-01", addToRegionTime="2024-01-01")
    lake.upsert_latest(stored, "dws_goods_daily", "2024-01-01", 1, writer="history")
    for day in ("2024-01-02", "2024-01-03"):
        lake.upsert_latest(row(spark, "dwd_goods_base", **key, date=day, title=day), "dwd_goods_base", day, 1)
        build_day(lake, day)
    lake.compact("dws_goods_daily")
    lake.upsert_latest(row(spark, "dwd_goods_base", **key, date="2024-01-03", title="later"), "dwd_goods_base", "x", 2)
    build_day(lake, "2024-01-03")  # once more, after the merge
    got = [(str(r.date), str(r.firstAddTime), str(r.addToRegionTime), r.goodsTitleEnglish)
           for r in lake.scan("dws_goods_daily").orderBy("date").collect()]
    assert got == [("2024-01-01", "2024-01-01", "2024-01-01", None), ("2024-01-02", "2024-01-01", "2024-01-01", "2024-01-02"),
                   ("2024-01-03", "2024-01-01", "2024-01-01", "later")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _products(spark):
    """Empty tables but for a product on three days, with a gallery and SKUs."""
    tables = {name: spark.createDataFrame([], TABLES[name].schema) for name in TABLES}
    days = [row(spark, "dwd_goods_base", goodsId=1, siteId=1, date=day, title=day, skuList='{"a":{"stockQuantity":2,"isOnsale":1}}',
                gallery='[{"url":"g2","priority":2},{"url":"g1","priority":1},{"url":"g1","priority":5}]')
            for day in ("2024-01-01", "2024-01-02", "2024-01-04")]
    tables["dwd_goods_base"] = days[0].unionAll(days[1]).unionAll(days[2])
    return tables


def test_an_edge_of_products_derives_no_figures(spark):
    tables = _products(spark)
    edge = right_edge(goods_history(tables, ("2024-01-01", "2024-01-02")))
    assert "from_json" not in _plan(edge) and "get_json_object" not in _plan(edge)
    assert [(str(r.date), str(r.firstCollectDate)) for r in edge.collect()] == [("2024-01-02", "2024-01-01")]


def test_a_range_goes_on_from_an_edge_of_daily_columns(spark, tmp_path):
    lake = Warehouse(spark, str(tmp_path / "wh"), files_per_day=1)
    lake.upsert_latest(_products(spark)["dwd_goods_base"], "dwd_goods_base", "all", 1)
    rebuild_days(lake, "goods", "2024-01-01", "2024-01-02", 1)
    lake.write_edge(lake.read_edge("goods", "2024-01-02").drop("gallery").localCheckpoint(), "goods", "2024-01-02")
    rebuild_days(lake, "goods", "2024-01-03", "2024-01-04", 1)
    got = [(str(r.date), str(r.lastUpdateTime), str(r.firstAddTime), r.carouselImageUrls, r.stockQuantity)
           for r in lake.scan("dws_goods_daily").orderBy("date").collect()]
    assert got == [(day, day, "2024-01-01", '["g1","g2"]', 2) for day in ("2024-01-01", "2024-01-02", "2024-01-04")]


def test_a_gallery_is_parsed_once(spark):
    df = spark.createDataFrame([("[]",)], "t string").select(gallery_urls(F.col("t")).alias("v"))
    assert _plan(df).count("from_json") == 2  # the list, and each of its entries


def test_rows_that_lose_no_figure_are_not_kept(spark, tmp_path, monkeypatch):
    tables, kept = _products(spark), []
    monkeypatch.setattr(type(tables["dwd_goods_base"]), "persist", lambda df, level: kept.append(df) or df)
    for n, build in enumerate((build_goods_daily, build_malls_daily)):
        name = ("dws_goods_daily", "dws_malls_daily")[n]
        _load(Warehouse(spark, str(tmp_path / name)), build(tables, None, lost=True), name, "b", 1, "w")
        assert len(kept) == n
