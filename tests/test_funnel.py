import re

from pyspark.sql import functions as F

from adsift.operators.funnel import abtest_dims, funnel, funnel_text
from adsift.plans.queries import _feeds
from tests.helpers import empty, feed, ts

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def pv_row(bid, minute, row_id, av="1", **kw):
    r = {"ts": ts(minute), "row_id": row_id, "bid_id": bid, "slot_id": "s",
         "tags": ["vendor:v"], "dims": {"av": av, "mcc": "m"}}
    r.update(kw)
    return r


def run(spark, pvs=(), bids=(), imprs=(), clicks=(), **kw):
    f = lambda n, rs: feed(spark, n, list(rs)) if rs else empty(spark, n)
    return funnel(f("pv", pvs), f("bid", bids), f("impr", imprs), f("click", clicks), **kw)


def test_orphan_click_e1(spark):
    out = run(spark, clicks=[{"ts": ts(1), "row_id": 1, "bid_id": "b", "slot_id": "s", "charge": 5}])
    r = out.collect()
    assert len(r) == 1
    assert r[0]["attributed"] is False and r[0]["mcc"] is None
    assert (r[0]["click"], r[0]["charge"], r[0]["pv"]) == (1, 5, 0)


def test_hour_vs_day_grain_e2(spark):
    pvs = [pv_row("b", 59, 1)]                                   # 10:59
    clicks = [{"ts": ts(61), "row_id": 2, "bid_id": "b", "slot_id": "s", "charge": 1}]  # 11:01
    hour = run(spark, pvs=pvs, clicks=clicks)
    assert rows(hour, "attributed", "pv", "click") == [(False, 0, 1), (True, 1, 0)]
    day = run(spark, pvs=pvs, clicks=clicks, grain="day")
    assert rows(day, "attributed", "pv", "click") == [(True, 1, 1)]


def test_latest_pv_wins_e3(spark):
    out = run(spark, pvs=[pv_row("b", 1, 1, av="1"), pv_row("b", 2, 2, av="2")])
    assert rows(out, "av", "pv") == [("2", 2)]
    # same ts: row_id breaks the tie
    out = run(spark, pvs=[pv_row("b", 1, 9, av="9"), pv_row("b", 1, 3, av="3")])
    assert rows(out, "av", "pv") == [("9", 2)]


def test_null_bid_groups_together_e4(spark):
    out = run(spark, pvs=[pv_row(None, 1, 1)],
              clicks=[{"ts": ts(2), "row_id": 2, "bid_id": None, "slot_id": "s", "charge": 3}])
    assert rows(out, "attributed", "pv", "click", "charge") == [(True, 1, 1, 3)]


def test_missing_dims_are_empty_e5(spark):
    out = run(spark, pvs=[pv_row("b", 1, 1, dims=None, tags=None),
                          pv_row("c", 1, 2, dims={"mcc": None}, tags=[])])
    assert rows(out, "mcc", "vendor", "nsv", "av", "attributed", "pv") == [("", "", "", "", True, 2)]


def test_charge_does_not_wrap_e19(spark):
    clicks = [{"ts": ts(1), "row_id": i, "bid_id": "b", "slot_id": "s", "charge": c}
              for i, c in enumerate([2147483647, 1])]
    out = run(spark, clicks=clicks)
    assert out.collect()[0]["charge"] == 2147483648


def test_slot_filter_and_text_render(spark):
    pvs = [pv_row("b", 1, 1), pv_row("c", 1, 2, slot_id="other")]
    imprs = [{"ts": ts(2), "row_id": 3, "bid_id": "b", "slot_id": "s"}]
    out = run(spark, pvs=pvs, imprs=imprs, slot_id="s")
    assert rows(out, "pv", "impr") == [(1, 1)]
    txt = funnel_text(out, ["mcc", "vendor", "nsv", "av"]).collect()
    assert [r.value for r in txt] == ["(m,v,,1,(1,0,1,0,0))"]
    orphan = run(spark, imprs=imprs)
    assert funnel_text(orphan, ["mcc"]).collect()[0].value == "(,(0,0,1,0,0))"


def test_counters_conserve_input_rows(spark):
    pv, bid, impr, click = _feeds(spark, SF)
    out = funnel(pv, bid, impr, click, dims=abtest_dims(), per_day=True)
    tot = out.agg(*[F.sum(c).alias(c) for c in ("pv", "bid", "impr", "click")]).collect()[0]
    assert (tot.pv, tot.bid, tot.impr, tot.click) == (pv.count(), bid.count(), impr.count(), click.count())


def test_partition_invariance(spark):
    pv, bid, impr, click = _feeds(spark, SF)
    a = funnel(pv, bid, impr, click)
    b = funnel(pv.repartition(1), bid.repartition(7), impr.repartition(3), click.repartition(8))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_plan_two_shuffles_no_python(spark):
    out = funnel(*_feeds(spark, SF))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_filters_reach_partitioned_scan(spark):
    from adsift.session import scratch_path
    from adsift.sinks import write_table
    from adsift.sources import read_feed
    from adsift.sources import testdata as td

    root = scratch_path(spark, "plan-feeds")
    for name, fn in (("pv", td.pv), ("bid", td.bid), ("impr", td.impr), ("click", td.click)):
        write_table(fn(spark, SF), f"{root}/{name}", partition_by=["dt"])
    feeds = [read_feed(spark, root, n) for n in ("pv", "bid", "impr", "click")]
    out = funnel(*feeds, slot_id="1", start="2024-01-02", end="2024-01-04")
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.split("\n") if "FileScan parquet" in ln]
    assert len(scans) == 4
    for ln in scans:
        assert "PartitionFilters: [isnotnull(dt" in ln
        assert "EqualTo(slot_id,1)" in ln
    assert "tags" not in scans[1] and "dims" not in scans[1]     # non-pv scans are pruned
    want = funnel(*[f.filter("dt between '2024-01-02' and '2024-01-04' and slot_id = '1'")
                    for f in _feeds(spark, SF)])
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
