import datetime as dt

from adsift.operators import landing as la
from tests.helpers import feed

D1 = dt.datetime(2024, 3, 1, 5)
D2 = dt.datetime(2024, 3, 2, 6)


def land(spark, rows):
    base = {"sponsor_id": 1, "slot_id": "s", "ht": 0, "lt": 0, "pt": 0}
    return feed(spark, "land_page", [{**base, **r} for r in rows])


def test_daily_avg_and_zero_count_e15(spark):
    df = land(spark, [
        {"ts": D1, "ht": 10, "lt": 1, "pt": 4, "ext": {"fd": "x"}},
        {"ts": D1, "ht": 20, "lt": 2, "pt": 5, "ext": {"fd": "y"}},
        {"ts": D1, "ht": 999, "lt": 9, "pt": 9, "ext": {}},
        {"ts": D2, "ht": 5, "lt": 5, "pt": 5, "ext": {"nofd": "1"}},
    ])
    got = {r.dt: (r.ht_avg, r.lt_avg, r.pt_avg, r.fd_count) for r in la.landing_daily_avg(df).collect()}
    assert got == {D1.date(): (15.0, 1.5, 4.5, 2), D2.date(): (None, None, None, 0)}


def test_group_avg_strict_e14(spark):
    df = land(spark, [
        {"ts": D1, "ht": 1, "ext": {}}, {"ts": D1, "ht": 2, "ext": {"fd": ""}},
        {"ts": D1, "ht": 4, "ext": {"fd": "null"}}, {"ts": D1, "ht": 8, "ext": {"fd": "x"}},
    ])
    default = la.landing_group_avg(df).collect()[0]
    strict = la.landing_group_avg(df, strict=True).collect()[0]
    assert (default.fd_count, default.ht_sum, default.ht_avg) == (3, 14, 14 / 3)
    assert (strict.fd_count, strict.ht_sum, strict.ht_avg) == (1, 8, 8.0)


def test_form_dups_and_values(spark):
    df = land(spark, [
        {"ts": D1, "slot_id": "dc", "ext": {"fd": "a"}}, {"ts": D1, "slot_id": "780dc", "ext": {"fd": "a"}},
        {"ts": D1, "slot_id": "zz", "ext": {"fd": "a"}}, {"ts": D1, "slot_id": "", "ext": {}},
        {"ts": D1, "slot_id": "c", "ext": {}},
    ])
    got = sorted((r.fd, r.n_rows) for r in la.landing_form_dups(df, slot="780dc").collect())
    assert got == [("a", 2), ("null", 2)]
    vals = sorted(r.fd for r in la.slot_form_values(df, slot="dc").collect())
    assert vals == ["a"]


def test_form_quality_e16(spark):
    forms = ["a=1&school=x", "a=&school=x", "school=", "school=x", "zzz"]
    df = land(spark, [{"ts": D1, "slot_id": "s", "ext": {"fd": f}} for f in forms] +
              [{"ts": D1, "slot_id": "other", "ext": {"fd": "q=1&school=x"}},
               {"ts": D1, "slot_id": "s", "ext": {"fd": "school=x"}}])
    got = la.landing_form_quality(df, slot="s").collect()
    assert [(r.dt, r.n_complete) for r in got] == [(D1.date(), 2)]
    buckets = {r.bucket: r.n_rows for r in la.landing_form_buckets(df, slot="s").collect()}
    assert buckets["else"] == 1 and buckets["school=x"] == 2


def test_report_text_rounds_like_java_and_handles_huge_values(spark):
    groups = spark.createDataFrame(
        [(D1.date(), 1, "s", 1, 2, 3, 128, 1 / 128, 4.2265625, 1e35)],
        "dt date, sponsor_id bigint, slot_id string, ht_sum bigint, lt_sum bigint, pt_sum bigint, "
        "fd_count bigint, ht_avg double, lt_avg double, pt_avg double")
    line = la.landing_group_text(groups).collect()[0].value
    assert ",ht_avg:0.007813," in line and ",lt_avg:4.226563," in line      # half-up, like Java %f
    assert line.endswith(",pt_avg:1" + "0" * 35 + ".000000")                  # beyond decimal(38,6): Java %f
