"""Heavy hitters, salted joins, the Bloom prefilter and bucketed joins: results, plans and how rows are dealt."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from adsift.operators import cohort as co
from adsift.operators import enrich, membership, skew
from adsift.session import scratch_path
from adsift.sources import testdata as td
from adsift.sources import union_cohorts
from tests.test_cohort import final_plan, hot_pv

SF = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def put(**settings):
        for k, v in settings.items():
            key = "spark.sql." + k.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_hitters_are_found(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, "warm")
                                    .when(F.col("id") % 7 != 2, F.col("id").cast("string")).alias("k")).repartition(8)
    assert set(skew.heavy_hitters(df, "k", 0.02)) == {"hot", "warm"} and skew.heavy_hitters(df, "k", 0.2) == ["hot"]
    assert skew.heavy_hitters(df.filter("k is null"), "k", 0.1) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_join(spark, how):
    left = spark.createDataFrame([(k, i) for i in range(50) for k in ("a", "b", "x", None)], "l string, n int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "r string, m int")
    count = lambda df: collections.Counter(map(tuple, df.collect()))
    want = count(left.join(right, F.col("l") == F.col("r"), how))
    assert count(skew.join_salted(left, right, "l", "r", how, ["a", "x"], salts=5)) == want
    assert count(skew.join_salted(left, right, "l", "r", how, [])) == want
    with pytest.raises(ValueError):
        skew.join_salted(left, right, "l", "r", "full", ["a"])


def hot_dsp(spark, n=60_000):
    """One advertising id in most tuples; the second id makes the tuples differ."""
    return spark.range(n).select(
        F.lit(112).cast("bigint").alias("synd_id"), F.current_date().alias("dt"), (F.col("id") % 24).cast("int").alias("hour"),
        F.create_map(F.lit("IDFA"), F.when(F.col("id") % 4 != 0, "0000").otherwise(F.col("id").cast("string")),
                     F.lit("DEVICEID"), F.concat(F.lit("d"), F.col("id"))).alias("ext")).repartition(8)


def task_rows(joined):
    """Rows of the join's output in each of its tasks."""
    counts = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    return sorted(r.n for r in counts)


def test_hot_id_is_salted_where_adaptive_execution_cannot_split(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    dsp = hot_dsp(spark)
    cohort = spark.range(40_000).select(F.col("id").cast("string").alias("id")).unionByName(
        spark.createDataFrame([("0000",)], "id string"))
    tuples = dsp.select(*[c.alias(f"_c{i}") for i, c in enumerate(co.dsp_candidates())], "dt", "hour")
    stacked = co._stacked(tuples, ["_c0", "_c1"], outer=True)
    members = co._ids(cohort).withColumn("_member", F.lit(True))
    plain, salted = (task_rows(co._joined(stacked, members, share)) for share in (None, 0.01))
    assert sum(plain) == sum(salted) == 120_000
    assert plain[-1] > 45_000            # the hot id's tuples in one task
    assert salted[-1] < 2.5 * 120_000 / 8
    df = co.dsp_new_by_hour(dsp, cohort, max_hour=23, hot_share=0.01)
    plan = final_plan(spark, df)
    assert plan.count("SortMergeJoin") == 1 and "skew=true" not in plan
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, co.dsp_new_by_hour(dsp, cohort, max_hour=23).collect()))


SPLIT = {"autoBroadcastJoinThreshold": "-1", "adaptive__skewJoin__skewedPartitionThresholdInBytes": "10k",
         "adaptive__skewJoin__skewedPartitionFactor": "2", "adaptive__advisoryPartitionSizeInBytes": "10k",
         "adaptive__coalescePartitions__minPartitionSize": "1k"}   # sizes scaled down like the data


def test_the_registered_list_form_lets_a_hot_id_be_split(spark, conf):
    """``union_cohorts`` of two lists as the jobs pass it, with partition coalescing as it is by default."""
    conf(**SPLIT, adaptive__coalescePartitions__enabled="true")
    lists = [spark.range(a, b).select(F.col("id").cast("string").alias("id")) for a, b in ((0, 30_000), (20_000, 40_000))]
    hot = spark.createDataFrame([("00000000-0000",)], "id string")
    cohort = union_cohorts(*lists, hot, distinct=False)
    for build in (co.slot_device_pairs, co.slot_device_counts, co.slot_cohort_reach):
        plan = final_plan(spark, build(hot_pv(spark), cohort))
        assert plan.count("SortMergeJoin") == 1 and "skew=true" in plan
    assert co.slot_device_pairs(hot_pv(spark), cohort).count() == 45_000 + 10_000
    assert co.cohort_reach(hot_pv(spark), cohort).first().n_ids == co.cohort_reach(
        hot_pv(spark), union_cohorts(*lists, hot)).first().n_ids


def test_a_hot_bid_of_one_sponsor_is_split(spark, conf):
    conf(**SPLIT, adaptive__coalescePartitions__enabled="true")
    pv = spark.range(80_000).select(F.when(F.col("id") % 4 != 0, "hot").otherwise(F.col("id").cast("string")).alias("bid_id"),
                                    F.col("id").alias("row_id"), F.lit("x" * 50).alias("app_id")).repartition(8)
    events = spark.range(30_000).select(F.col("id").cast("string").alias("bid_id")).unionByName(
        spark.createDataFrame([("hot",), ("hot",), (None,)], "bid_id string"))
    df = enrich.restrict_to_bids(pv, events)
    plan = final_plan(spark, df)
    assert "skew=true" in plan and "LeftSemi" in plan
    assert df.count() == 60_000 + 7_500


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("id"), F.col("id")).alias("id"))
    bits = membership.filter_bits(ids)
    assert bits == 1 << 18 and membership.filter_bits(ids, max_bits=1 << 10) == 1 << 10 and membership.filter_bits(ids.limit(0)) == 64
    words = membership.bloom_words(ids.unionByName(spark.createDataFrame([(None,), ("",)], "id string")), bits).first().words
    assert len(words) == bits // 64
    rows = spark.range(60_000).select(F.concat(F.lit("id"), F.col("id")).alias("c")).unionByName(
        spark.createDataFrame([(None,), ("",)], "c string"))
    kept = {r.c for r in membership.prefilter(rows, "c", ids).collect()}
    assert {f"id{i}" for i in range(20_000)} <= kept and None not in kept
    assert len(kept) - 20_000 < 0.02 * 40_000
    weak = membership.prefilter(rows, "c", ids, bits=1 << 12)
    assert {f"id{i}" for i in range(20_000)} <= {r.c for r in weak.collect()}
    assert membership.prefilter(rows, "c", ids.limit(0)).count() == 0


def shuffled_rows(df):
    """Rows written to exchanges by the final plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found += node.metrics().get("shuffleRecordsWritten").get().value()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_bloom_filter_shrinks_the_shuffle_before_the_exact_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    tuples = spark.range(100_000).select(F.concat(F.lit("x"), F.col("id")).alias("_c0"), F.lit(None).cast("string").alias("_c1"))
    cohort = spark.range(0, 100_000, 50).select(F.concat(F.lit("x"), F.col("id")).alias("id"))
    plain, bloom = (co.first_members(tuples, ["_c0", "_c1"], cohort, bloom=b) for b in (False, True))
    assert shuffled_rows(plain) > 100_000 and shuffled_rows(bloom) < 15_000
    assert {r.id for r in bloom.collect()} == {r.id for r in plain.collect()} and bloom.count() == 2000


def test_both_feeds_join_the_bucketed_page_views_without_an_exchange(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    path = scratch_path(spark, "first")
    first = enrich.write_first_pv(td.pv(spark, SF), "first_pv_test", path, buckets=8, app_ids=None)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 8
    plain = enrich.first_pv_device(td.pv(spark, SF), None)
    for feed in (td.impr, td.click):
        df = enrich.enrich_with_first(feed(spark, SF), first, sponsor_id=None, tz="UTC")
        plan = final_plan(spark, df)
        left, right = plan[plan.index("SortMergeJoin"):].split("FileScan parquet spark_catalog", 1)[0], plan.split("first_pv_test")[-2]
        assert plan.count("Exchange") == 1 and "Exchange" in left and "Bucketed: true" in plan, right
        want = enrich.enrich_with_first(feed(spark, SF), plain, sponsor_id=None, tz="UTC")
        assert collections.Counter(map(tuple, df.collect())) == collections.Counter(map(tuple, want.collect()))
    spark.sql("DROP TABLE first_pv_test")
