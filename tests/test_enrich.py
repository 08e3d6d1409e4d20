from adsift.operators.enrich import enrich_events, enrich_text, restrict_to_bids
from tests.helpers import empty, feed, ts


def pv_row(bid, minute, row_id, ext, name="dev", app="252"):
    return {"ts": ts(minute), "row_id": row_id, "bid_id": bid, "app_id": app,
            "device_name": name, "ext": ext}


def impr_row(bid, minute=5, row_id=100, sponsor=262090):
    return {"ts": ts(minute), "row_id": row_id, "bid_id": bid, "sponsor_id": sponsor,
            "ip": "1.2.3.4", "slot_id": "s", "app_id": "252"}


def test_first_pv_and_no_pv_e9(spark):
    pv = feed(spark, "pv", [pv_row("b", 2, 2, {"auid": "q"}, "n2"), pv_row("b", 1, 1, {"auid": "p"}, "n1")])
    imp = feed(spark, "impr", [impr_row("b"), impr_row("z", row_id=101)])
    got = sorted((r.device_id, r.device_name) for r in enrich_events(imp, pv).collect())
    assert got == [("", ""), ("p", "n1")]


def test_device_id_fallback_and_strip(spark):
    pv = feed(spark, "pv", [pv_row("a", 1, 1, {"udid": "ifa:XY"}), pv_row("b", 1, 2, {"auid": "A", "udid": "U"}),
                            pv_row("c", 1, 3, {})])
    imp = feed(spark, "impr", [impr_row("a"), impr_row("b", row_id=2), impr_row("c", row_id=3)])
    ids = sorted((r.device_id is None, r.device_id) for r in enrich_events(imp, pv).collect())
    assert ids == [(False, "A"), (False, "XY"), (True, None)]          # E10: NULL in the frame
    lines = sorted(r.value for r in enrich_text(enrich_events(imp, pv)).collect())
    assert any(";null;dev;" in v for v in lines)                        # E10: 'null' in the text
    assert all(v.endswith(";") and v.count(";") == 6 for v in lines)


def test_sponsor_and_app_filters(spark):
    pv = feed(spark, "pv", [pv_row("b", 1, 1, {"auid": "X"}, app="999")])
    imp = feed(spark, "impr", [impr_row("b"), impr_row("b", sponsor=1, row_id=2)])
    got = enrich_events(imp, pv).collect()
    assert len(got) == 1 and got[0].device_id == ""      # pv app not in the ten apps
    got = enrich_events(imp, pv, sponsor_id=None, app_ids=None).collect()
    assert sorted(r.device_id for r in got) == ["X", "X"]


def test_null_bid_never_matches(spark):
    pv = feed(spark, "pv", [pv_row(None, 1, 1, {"auid": "X"})])
    imp = feed(spark, "impr", [impr_row(None), impr_row(None, row_id=2)])
    got = enrich_events(imp, pv, sponsor_id=None, app_ids=None).collect()
    assert [(r.device_id, r.device_name) for r in got] == [("", ""), ("", "")]


def test_empty_pv(spark):
    imp = feed(spark, "impr", [impr_row("b")])
    assert enrich_events(imp, empty(spark, "pv")).collect()[0].device_id == ""


def test_enrich_partition_invariance_and_sort_merge(spark):
    from adsift.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    imp, pv = td.impr(spark, sf), td.pv(spark, sf)
    a = sorted(map(tuple, enrich_events(imp, pv, sponsor_id=None, app_ids=None).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = enrich_events(imp.repartition(5), pv.repartition(3), sponsor_id=None, app_ids=None)
        b = sorted(map(tuple, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_sponsor_restriction_changes_nothing(spark):
    from pyspark.sql import functions as F

    from adsift.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    imp, pv = td.impr(spark, sf), td.pv(spark, sf)
    for sponsor in (0, 1, 2):
        got = enrich_events(imp, pv, sponsor_id=sponsor, app_ids=None)
        own = restrict_to_bids(pv, imp.filter(F.col("sponsor_id") == sponsor))
        assert "LeftSemi" in own._jdf.queryExecution().optimizedPlan().toString()
        tagged = imp.withColumn("ip", F.when(F.col("sponsor_id") == sponsor, F.col("ip")))
        want = enrich_events(tagged, pv, sponsor_id=None, app_ids=None).filter(F.col("ip").isNotNull())
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_bid_is_split_by_the_join(spark):
    """A bid with most of the events: AQE splits its partition, since the reduced
    page views are a checkpoint and not an aggregate below the join."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        bid = F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        base = [F.col("id").alias("row_id"), F.timestamp_seconds("id").alias("ts"), bid.alias("bid_id"), F.lit("a").alias("app_id"),
                F.lit("s").alias("slot_id")]
        ev = spark.range(80_000).select(*base, F.col("id").cast("string").alias("ip"), F.lit(1).alias("sponsor_id")).repartition(8)
        pv = spark.range(20_000).select(*base, F.lit("n").alias("device_name"),
                                        F.create_map(F.lit("auid"), F.lit("x")).alias("ext")).repartition(8)
        df = enrich_events(ev, pv, sponsor_id=None, app_ids=None)
        assert len(df.collect()) == 80_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
