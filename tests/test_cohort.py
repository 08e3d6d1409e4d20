import pytest
from pyspark.sql import functions as F

from adsift.operators import cohort as co
from adsift.plans.queries import _both_cohorts
from adsift.sources import testdata as td
from adsift.sources.feeds import cohort_of
from tests.helpers import feed, ts

SF = "/root/testdata/sf0.001"


def ids(spark, *xs):
    return cohort_of(spark.createDataFrame([(x,) for x in xs], "id string"))


def pv_row(device, udid=None, auid=None, slot="s", app="1", row_id=1, minute=1):
    ext = {k: v for k, v in (("udid", udid), ("auid", auid)) if v is not None}
    return {"ts": ts(minute), "row_id": row_id, "bid_id": "b", "slot_id": slot, "app_id": app,
            "device_id": device, "ext": ext}


def test_priority_device_first_e11(spark):
    pv = feed(spark, "pv", [pv_row("D", udid="U"), pv_row("D", udid="U", row_id=2)])
    got = co.cohort_ids(pv, ids(spark, "D", "U")).collect()
    assert [r.id for r in got] == ["D"]


def test_priority_falls_through(spark):
    pv = feed(spark, "pv", [pv_row("x", udid="U", auid="A"), pv_row("y", udid="u2", auid="A", row_id=2),
                            pv_row(None, udid=None, auid="A", row_id=3), pv_row("", udid="", auid="", row_id=4)])
    got = sorted(r.id for r in co.cohort_ids(pv, ids(spark, "U", "A", "")).collect())
    assert got == ["A", "U"]


def test_repeated_cohort_id_no_multiplication_e12(spark):
    pv = feed(spark, "pv", [pv_row("D"), pv_row("D", row_id=2)])
    cohort = spark.createDataFrame([("D",), ("D",)], "id string")
    m = co.match_cohort(pv.select("device_id"), ["device_id"], cohort)
    assert m.count() == 2
    assert co.cohort_reach(pv, cohort).collect()[0].n_ids == 1


def test_slot_reach_with_total(spark):
    pv = feed(spark, "pv", [pv_row("D1", slot="a"), pv_row("D2", slot="a", row_id=2),
                            pv_row("D1", slot="b", row_id=3), pv_row("zz", udid="ifa:XD3", slot="b", row_id=4)])
    got = {(r.slot_id, r.is_total): r.n_devices
           for r in co.slot_cohort_reach(pv, ids(spark, "D1", "D2", "D3")).collect()}
    # udid 'ifa:XD3' loses a 4-char scheme prefix -> 'XD3' (not a member)
    assert got == {("a", False): 2, ("b", False): 1, (None, True): 2}


def test_new_by_hour_zero_hours_e13(spark):
    rows = [{"ts": ts(60 * h - 600), "row_id": i, "synd_id": 112, "ext": {"IDFA": x}}
            for i, (h, x) in enumerate([(0, "a"), (0, "b"), (2, "c"), (2, "a"), (5, "z")])]
    rows.append({"ts": ts(-600 + 30), "row_id": 9, "synd_id": 7, "ext": {"IDFA": "d"}})
    dsp = feed(spark, "pv_dsp", rows)
    out = co.dsp_new_by_hour(dsp, ids(spark, "a", "b", "c", "d"), max_hour=3).orderBy("hour").collect()
    assert [(r.hour, r.n_new, r.n_total) for r in out] == [(0, 2, 2), (1, 0, 2), (2, 1, 3), (3, 0, 3)]


def test_app_flag_two_cohorts(spark):
    pv = feed(spark, "pv", [pv_row("A", app="252"), pv_row("B", app="252", row_id=2),
                            pv_row("x", udid="A", app="7", row_id=3)])
    out = {r.in_app: (r.n_cohort1, r.n_cohort2)
           for r in co.cohort_by_app_flag(pv, ids(spark, "A"), ids(spark, "A", "B")).collect()}
    assert out == {True: (1, 2), False: (1, 1)}


def test_slot_threshold(spark):
    pv = feed(spark, "pv", [pv_row(f"D{i}", slot="a" if i < 3 else "b", row_id=i) for i in range(5)])
    c = ids(spark, *[f"D{i}" for i in range(5)])
    got = {r.slot_id: r.n_devices for r in co.slot_device_counts(pv, c, min_devices=2).collect()}
    assert got == {"a": 3}


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_same_result_broadcast_or_sort_merge(spark, broadcast):
    """Sort-merge path (salted NULL keys) and broadcast path agree; partitioning
    of the input does not change the result (per-partition state is gone)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        pv, c = td.pv(spark, SF), _both_cohorts(spark, SF)
        a = sorted(map(tuple, co.slot_device_pairs(pv, c).collect()))
        b = sorted(map(tuple, co.slot_device_pairs(pv.repartition(5), c.repartition(3)).collect()))
        plan = co.slot_device_pairs(pv, c)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b and len(a) > 0
    if broadcast == "-1":
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_running_total_equals_distinct(spark):
    dsp, c = td.pv_dsp(spark, SF), _both_cohorts(spark, SF)
    out = co.dsp_new_by_hour(dsp, c, max_hour=23)
    last = out.groupBy("dt").agg(F.max("n_total").alias("t")).filter("t > 0")
    direct = (co.distinct_matches(dsp.filter("synd_id = 112"), ["dt"], co.dsp_candidates(), c)
              .groupBy("dt").agg(F.count("*").alias("t")))
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, direct.collect()))


def test_null_and_empty_candidates_never_reach_the_join(spark):
    pv = feed(spark, "pv", [pv_row(None, row_id=1), pv_row("", udid="", auid="A", row_id=2), pv_row("D", row_id=3)])
    tuples = pv.select(*[c.alias(f"_c{i}") for i, c in enumerate(co.pv_candidates())]).distinct()
    assert sorted(r._id for r in co._stacked(tuples, ["_c0", "_c1", "_c2"]).collect()) == ["A", "D"]
    assert co._stacked(tuples, ["_c0", "_c1", "_c2"], outer=True).count() == 3


def test_null_slot_counts_in_its_group_and_in_the_total(spark):
    pv = feed(spark, "pv", [pv_row("D1", slot="a"), pv_row("D2", slot=None, row_id=2)])
    c = ids(spark, "D1", "D2")
    got = {(r.slot_id, r.is_total): r.n_devices for r in co.slot_cohort_reach(pv, c).collect()}
    assert got == {("a", False): 1, ("null", False): 1, (None, True): 2}
    assert co.cohort_reach(pv, c).first().n_ids == 2


def test_flag_without_members_keeps_its_row(spark):
    pv = feed(spark, "pv", [pv_row("A", app="252"), pv_row(None, app="7", row_id=2)])
    out = {r.in_app: (r.n_cohort1, r.n_cohort2) for r in co.cohort_by_app_flag(pv, ids(spark, "A"), ids(spark)).collect()}
    assert out == {True: (1, 0), False: (0, 0)}


def test_late_hours_count_with_max_hour_23(spark):
    rows = [{"ts": ts(60 * 20 - 600), "row_id": 1, "synd_id": 112, "ext": {"IDFA": "a"}}]
    out = co.dsp_new_by_hour(feed(spark, "pv_dsp", rows), ids(spark, "a"), max_hour=23).collect()
    assert {r.hour: r.n_total for r in out}[20] == 1 and {r.hour: r.n_total for r in out}[19] == 0


def final_plan(spark, df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_pv(spark, n=60_000):
    """Many slots share one advertising id."""
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.current_timestamp().alias("ts"), F.current_date().alias("dt"), F.lit(1).alias("hour"),
        F.concat(F.lit("slot"), F.col("id")).alias("slot_id"), F.lit("b").alias("bid_id"), F.lit("7").alias("app_id"),
        F.when(F.col("id") % 4 != 0, F.lit("00000000-0000")).otherwise(F.col("id").cast("string")).alias("device_id"),
        F.create_map().cast("map<string,string>").alias("ext")).repartition(8)


def test_one_splittable_join_on_the_cohort(spark, skew_conf):
    cohort = spark.range(40_000).select(F.col("id").cast("string").alias("id")).unionByName(
        spark.createDataFrame([("00000000-0000",)], "id string"))
    df = co.slot_device_pairs(hot_pv(spark), cohort)
    plan = final_plan(spark, df)
    assert plan.count("SortMergeJoin") == 1 and "skew=true" in plan and "LeftSemi" in plan
    assert df.count() == 45_000 + 10_000


def test_feed_is_scanned_once(spark, skew_conf):
    pv, dsp, c = td.pv(spark, SF), td.pv_dsp(spark, SF), _both_cohorts(spark, SF)
    c1, c2 = td.cohorts(spark, SF)
    plan = final_plan(spark, co.dsp_new_by_hour(dsp, c, max_hour=23))
    assert plan.count("SortMergeJoin") == 1 and sum("event_id" in x or "props" in x for x in plan.split("\n") if "FileScan" in x) == 1
    plan = final_plan(spark, co.cohort_by_app_flag(pv, c1, c2))
    assert plan.count("SortMergeJoin") == 1 and sum("props" in x for x in plan.split("\n") if "FileScan" in x) == 1


def test_new_by_hour_day_without_early_hours(spark):
    rows = [{"ts": ts(60 * 20 - 600), "row_id": 1, "synd_id": 112, "ext": {"IDFA": "a"}}]   # 20:00 only
    out = co.dsp_new_by_hour(feed(spark, "pv_dsp", rows), ids(spark, "a"), max_hour=2).collect()
    assert sorted((r.hour, r.n_new, r.n_total) for r in out) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
