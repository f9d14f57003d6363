"""As-of and cumulative operators against brute force: gaps, far-off days and a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import aggregates, asof, joins, keyed

DAY0 = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def facts():
    """(grp, id, day, n): one key owns a third of the rows, one day lies centuries back."""
    rng = random.Random(7)
    days = [DAY0 + dt.timedelta(days=n) for n in (0, 1, 3, 4, 9, 30)] + [dt.date(1201, 5, 5)]
    rows = {(rng.randint(0, 3), rng.randint(0, 9), rng.choice(days)): rng.randint(0, 50) for _ in range(120)}
    rows.update({(0, 99, d): i for i, d in enumerate(days)})
    rows.update({(0, 200 + n, days[0]): n for n in range(60)})
    return [(g, i, d, n) for (g, i, d), n in rows.items()]


@pytest.fixture(scope="module")
def frame(spark, facts):
    return spark.createDataFrame(facts, "grp int, id int, date date, n int")


def test_asof_expand(frame, facts):
    days = sorted({r[2] for r in facts})
    got = asof.asof_expand(frame, ["grp", "id"], keyed.date_spine(frame)).select("grp", "id", "stat_date", "date", "n")
    want = set()
    for g, i in {(r[0], r[1]) for r in facts}:
        for day in days:
            seen = [r for r in facts if r[:2] == (g, i) and r[2] <= day]
            if seen:
                last = max(seen, key=lambda r: r[2])
                want.add((g, i, day, last[2], last[3]))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_cumulative_distinct_and_latest_sum(frame, facts):
    spine = keyed.date_spine(frame)
    days = sorted({r[2] for r in facts})
    count = {(r.grp, r.stat_date): r.ids for r in asof.cumulative_distinct(frame, ["grp"], "id", spine, out="ids").collect()}
    total = {(r.grp, r.stat_date): r.total for r in asof.cumulative_latest_sum(
        frame, ["grp"], ["id"], spine, {"total": F.col("n")}).collect()}
    want_count, want_total = {}, {}
    for g in {r[0] for r in facts}:
        for day in days:
            seen = [r for r in facts if r[0] == g and r[2] <= day]
            if seen:
                ids = {r[1] for r in seen}
                want_count[g, day] = len(ids)
                want_total[g, day] = sum(max((r for r in seen if r[1] == i), key=lambda r: r[2])[3] for i in ids)
    assert count == want_count and total == want_total


def test_no_nested_loops(frame):
    spine = keyed.date_spine(frame)
    for df in (asof.asof_expand(frame, ["grp", "id"], spine), asof.first_seen_asof(
            keyed.first_seen(frame, ["grp"]), spine, "first_date")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_listed_ids_are_numbers(spark):
    texts = ['[{"optId":5,"x":"optId"},{"optId":"6"},{"optId":5},{"name":1},7]', "[]", None, '{"optId":1}', "bad"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ids for r in df.select(joins.listed_ids(F.col("t"), "optId").alias("ids")).collect()]
    assert got[0] == [5] and not any(got[1:])


def test_gallery_shapes(spark):
    texts = ['[{"url":"b","priority":2},{"url":"a","priority":2},{"url":"b","priority":1},{"url":"z"},{"url":""},"x"]',
             '{"url":"u","priority":1}', "[]", "bad", None, '{"other":1}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(aggregates.gallery_urls(F.col("t")).alias("v")).collect()]
    assert got == ['["z","b","a"]', '["u"]', None, None, None, None]
