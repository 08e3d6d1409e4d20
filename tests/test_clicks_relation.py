import datetime as dt

from adsift.operators import clicks, relation
from adsift.session import scratch_path
from adsift.sinks import write_text
from adsift.sources import read_lines
from adsift.sources import testdata as td
from tests.helpers import feed

T = dt.datetime(2024, 1, 1, 0, 0, 0, 123999)


def click_rows(spark):
    base = {"bid_id": "b", "slot_id": "s", "charge": 1}
    return feed(spark, "click", [
        {**base, "ts": T, "row_id": 1, "device_id": "d", "sponsor_id": 286304},
        {**base, "ts": T, "row_id": 2, "device_id": "d", "sponsor_id": 286304},
        {**base, "ts": T, "row_id": 3, "device_id": None, "sponsor_id": 286304},
        {**base, "ts": T, "row_id": 4, "device_id": "e", "sponsor_id": 5},
    ])


def test_click_device_times(spark):
    r = clicks.click_device_times(click_rows(spark)).collect()[0]
    assert (r.n_clicks, r.n_device_times) == (4, 3)


def test_sponsor_click_devices_text_roundtrip(spark):
    out = clicks.sponsor_click_devices(click_rows(spark))
    path = write_text(out, scratch_path(spark, "t-clicks"), num_files=1)
    got = sorted(r.value for r in read_lines(spark, path).collect())
    assert got == ["1704067200123 d", "1704067200123 null"]


def test_relation_basics(spark):
    recs = td.records(spark, "/root/testdata/sf0.001")
    relation.register(recs, "records_t")
    assert relation.count_rows(spark, "records_t").collect()[0].n == recs.count()
    lines = [r.line for r in relation.key_value_lines(spark, "records_t", below=3).collect()]
    assert sorted(lines) == ["Key: 0, Value: val_0", "Key: 1, Value: val_1", "Key: 2, Value: val_2"]
    assert [r.key for r in relation.key_lookup(recs).collect()] == [1]
    back = relation.parquet_roundtrip(spark, recs)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, recs.collect()))
    assert relation.value_alias(back).collect()[0].a == "val_1"


def test_filter_copy_and_take(spark):
    eps = td.episodes(spark, "/root/testdata/sf0.001")
    copy = relation.filter_copy(spark, eps)
    assert copy.count() == eps.filter("doctor > 5").count()
    top = relation.take_filtered(eps, n=3, order_by=["p_partkey"]).collect()
    assert len(top) == 3 and all(r.doctor > 5 for r in top)
    assert [r.p_partkey for r in top] == sorted(r.p_partkey for r in top)
