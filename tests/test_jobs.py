import datetime as dt
import os
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from adsift.operators import clicks, enrich, funnel, landing
from adsift.plans import jobs
from adsift.session import scratch_path
from adsift.sinks import write_table, write_text
from adsift.sources import default_run_date, read_feed, read_hourly_layout, read_lines
from adsift.sources import testdata as td
from adsift.streaming import file_line_stream, read_batches, run_to_end, word_count_stream
from tests.helpers import feed, ts

SF = "/root/testdata/sf0.001"
DAY = "2024-01-05"


@pytest.fixture(scope="module")
def root(spark):
    r = scratch_path(spark, "feeds")
    for name, fn in (("pv", td.pv), ("bid", td.bid), ("impr", td.impr), ("click", td.click),
                     ("land_page", td.land_page)):
        write_table(fn(spark, SF), f"{r}/{name}", partition_by=["dt"])
    return r


def test_funnel_job_matches_operator(spark, root):
    out = scratch_path(spark, "fj")
    jobs.funnel_job(spark, root, out, "2024-01-03", "2024-01-06", dims="abtest", per_day=True, num_files=2)
    feeds = [f.filter(F.col("dt").between("2024-01-03", "2024-01-06")) for f in
             (td.pv(spark, SF), td.bid(spark, SF), td.impr(spark, SF), td.click(spark, SF))]
    want = funnel.funnel_text(funnel.funnel(*feeds, dims=funnel.abtest_dims(), per_day=True),
                              ["abtest", "=", "=", "="])
    got = spark.read.text(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_daily_enrichment_job(spark, root):
    out = scratch_path(spark, "ej")
    jobs.daily_enrichment_job(spark, root, out, run_date=DAY, sponsor_id=0, app_ids=None)
    pv = td.pv(spark, SF).filter(F.col("dt") == DAY)
    imp = td.impr(spark, SF).filter(F.col("dt") == DAY)
    want = enrich.enrich_text(enrich.enrich_events(imp, pv, sponsor_id=0, app_ids=None))
    got = read_lines(spark, f"{out}/{DAY}_impr")
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in want.collect())
    assert read_lines(spark, f"{out}/{DAY}_click").count() >= 0


def test_landing_report_text(spark, root):
    out = scratch_path(spark, "lj")
    jobs.landing_report_job(spark, root, out, "1995-01-01", "1995-01-31")
    lines = [r.value for r in read_lines(spark, f"{out}/daily_text").collect()]
    assert lines and all(v.startswith("1995-01-") and ",fd_count:" in v for v in lines)


def test_report_formats(spark):
    daily = spark.createDataFrame([(dt.date(2016, 4, 1), 1.5, None, 2.0, 3), (dt.date(2016, 4, 2), None, None, None, 0)],
                                  "dt date, ht_avg double, lt_avg double, pt_avg double, fd_count bigint")
    assert sorted(r.value for r in landing.landing_daily_text(daily).collect()) == [
        "2016-04-01: ht_avg:1.500000,lt_avg:0.000000,pt_avg:2.000000,fd_count:3",
        "2016-04-02: ht_avg:NaN,lt_avg:NaN,pt_avg:NaN,fd_count:0"]


def test_group_text_keeps_null_rows(spark):
    rows = [{"ts": ts(1), "sponsor_id": None, "slot_id": None, "ht": None, "lt": 4, "pt": None, "ext": {"fd": "x"}}]
    text = landing.landing_group_text(landing.landing_group_avg(feed(spark, "land_page", rows))).collect()
    assert [r.value for r in text] == [
        "2024/01/01,null,null,ht_sum:0,lt_sum:4,pt_sum:0,count:1,ht_avg:0.000000,lt_avg:4.000000,pt_avg:0.000000"]


def test_hourly_layout(spark):
    root = scratch_path(spark, "hourly")
    pv = td.pv(spark, SF)
    hrs = [(str(r.dt), r.hour) for r in pv.select("dt", "hour").distinct().orderBy("dt", "hour").limit(3).collect()]
    for d, h in hrs:
        part = pv.filter((F.col("dt") == d) & (F.col("hour") == h)).drop("dt", "hour")
        part.write.parquet(f"{root}/pv/hourly/{d.replace('-', '/')}/{h:02d}")
    first, last = hrs[0][0], hrs[-1][0]
    got = read_hourly_layout(spark, root, "pv", first, last, fmt="parquet")
    want = pv.filter(F.struct("dt", "hour").isin([F.struct(F.lit(d).cast("date"), F.lit(h)) for d, h in hrs]))
    assert sorted(map(tuple, got.select("row_id", "dt", "hour").collect())) == \
        sorted(map(tuple, want.select("row_id", "dt", "hour").collect()))


def test_missing_feed_is_an_error(spark):
    nothing = scratch_path(spark, "nothing")
    with pytest.raises(AnalysisException):
        read_hourly_layout(spark, nothing, "pv", "2024-02-01", "2024-02-02", fmt="parquet").count()
    with pytest.raises(AnalysisException):
        read_feed(spark, nothing, "pv", "2024-02-01").count()
    df = read_hourly_layout(spark, nothing, "pv", "2024-02-01", "2024-02-02", fmt="parquet", allow_empty=True)
    assert df.count() == 0 and "dt" in df.columns and "hour" in df.columns


def test_cli_cohort_and_click_jobs(spark, root):
    from adsift.__main__ import main
    from adsift.operators import clicks, cohort
    from adsift.sinks import write_text

    c_path = write_text(td.cohort_lines(spark, SF, "BUILDING"), scratch_path(spark, "cli-cohort"))
    out = scratch_path(spark, "cli-reach")
    main(["cohort-reach", "--root", root, "--out", out, "--start", "2024-01-01", "--end", "2024-01-31",
          "--cohort", c_path])
    want = cohort.cohort_ids(td.pv(spark, SF), td.cohorts(spark, SF)[0])
    assert sorted(r.value for r in read_lines(spark, out).collect()) == sorted(r.id for r in want.collect())

    out = scratch_path(spark, "cli-clicks")
    main(["click-devices", "--root", root, "--out", out, "--start", "2024-01-01", "--end", "2024-01-31",
          "--sponsor", "1", "--num-files", "1"])
    want = clicks.sponsor_click_devices(td.click(spark, SF), 1)
    assert sorted(r.value for r in read_lines(spark, out).collect()) == sorted(r.value for r in want.collect())


def test_word_count_job_file_source(spark):
    inbox = scratch_path(spark, "wc-inbox").replace("file:", "")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.txt"), "w") as f:
        f.write("x y  x\nz\n")
    out, ckpt = scratch_path(spark, "wc-out"), scratch_path(spark, "wc-ckpt")
    q = jobs.word_count_job(spark, out, ckpt, path=inbox, trigger={"availableNow": True}, num_files=1)
    q.awaitTermination(120)
    from adsift.streaming import read_batches
    got = sorted((r.word, r.n) for r in read_batches(spark, out).collect())
    assert got == [("", 1), ("x", 2), ("y", 1), ("z", 1)]
    files = [f for f in os.listdir(out.replace("file:", "") + "/batch_id=0") if f.endswith(".parquet")]
    assert len(files) == 1


def test_num_files_in_every_day(spark):
    days = spark.range(3000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("dt"),
                                    F.col("id").cast("string").alias("value"))
    out = write_text(days, scratch_path(spark, "per-day"), num_files=5, partition_by=["dt"]).replace("file:", "")
    folders = [d for d in os.listdir(out) if d.startswith("dt=")]
    assert len(folders) == 3
    for d in folders:
        files = [f for f in os.listdir(f"{out}/{d}") if f.endswith(".txt")]
        assert 2 <= len(files) <= 5
    assert spark.read.text(out).count() == 3000
    write_text(days, out, partition_by=["dt"])
    assert spark.read.text(out).count() == 3000


def test_yesterday_is_in_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Pacific/Kiritimati", "Pacific/Niue"):   # UTC+14 and UTC-11
            spark.conf.set("spark.sql.session.timeZone", zone)
            before = dt.datetime.now(ZoneInfo(zone)).date()
            got = default_run_date(spark)
            assert got in (before - dt.timedelta(days=1), dt.datetime.now(ZoneInfo(zone)).date() - dt.timedelta(days=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_default_run_date_reads_yesterday(spark, tmp_path):
    day = default_run_date(spark)
    root, out = scratch_path(spark, "daily"), scratch_path(spark, "daily-out")
    for name, fn in (("pv", td.pv), ("impr", td.impr), ("click", td.click)):
        one = fn(spark, SF).filter(F.col("dt") == DAY).withColumn("dt", F.lit(day))
        write_table(one, f"{root}/{name}", partition_by=["dt"])
    jobs.daily_enrichment_job(spark, root, out, sponsor_id=None, app_ids=None)
    assert read_lines(spark, f"{out}/{day}_impr").count() == td.impr(spark, SF).filter(F.col("dt") == DAY).count() > 0


def test_cli_needs_a_sponsor_or_all(spark, root):
    from adsift.__main__ import main

    out = scratch_path(spark, "cli-all")
    with pytest.raises(SystemExit):
        main(["click-devices", "--root", root, "--out", out, "--start", DAY])
    main(["click-devices", "--root", root, "--out", out, "--start", DAY, "--all-sponsors"])
    want = clicks.sponsor_click_devices(td.click(spark, SF).filter(F.col("dt") == DAY), None)
    assert sorted(r.value for r in read_lines(spark, out).collect()) == sorted(r.value for r in want.collect())


def test_landing_report_reads_the_feed_once(spark, root, monkeypatch):
    reads = []
    monkeypatch.setattr(jobs, "read_feed", lambda *a, **k: reads.append(a) or read_feed(*a, **k))
    out = scratch_path(spark, "lj2")
    jobs.landing_report_job(spark, root, out, "1995-01-01", "1995-01-31")
    land = td.land_page(spark, SF).filter("dt between '1995-01-01' and '1995-01-31'")
    want = landing.landing_daily_text(landing.landing_daily_avg(land))
    got = read_lines(spark, f"{out}/daily_text")
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in want.collect())
    assert len(reads) == 1


def test_stream_failure_and_many_batches(spark):
    inbox = scratch_path(spark, "wc-many").replace("file:", "")
    os.makedirs(inbox)
    for i in range(8):
        with open(os.path.join(inbox, f"{i}.txt"), "w") as f:
            f.write(f"w{i} x\n")
    out, ckpt = scratch_path(spark, "wc-out"), scratch_path(spark, "wc-ckpt")
    run_to_end(jobs.word_count_job(spark, out, ckpt, path=inbox, trigger={"availableNow": True}, max_files_per_trigger=1))
    got = read_batches(spark, out)
    assert got.select("batch_id").distinct().count() == 8
    assert sorted((r.word, r.n) for r in got.collect()) == sorted([(f"w{i}", 1) for i in range(8)] + [("x", 1)] * 8)
    broken = file_line_stream(spark, inbox).selectExpr("raise_error('broken') AS value")
    with pytest.raises(Exception, match="broken"):
        run_to_end(word_count_stream(broken, scratch_path(spark, "b"), scratch_path(spark, "c"), {"availableNow": True}))


def test_one_second_batches(spark):
    inbox = scratch_path(spark, "wc-second").replace("file:", "")
    os.makedirs(inbox)
    out = scratch_path(spark, "wc-out")
    q = jobs.word_count_job(spark, out, scratch_path(spark, "wc-ckpt"), path=inbox)
    try:
        for i in range(2):
            with open(os.path.join(inbox, f".{i}"), "w") as f:
                f.write(f"w{i}\n")
            os.rename(os.path.join(inbox, f".{i}"), os.path.join(inbox, f"{i}.txt"))
            q.processAllAvailable()
        starts = [dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")) for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    assert len(starts) == 2 and (starts[1] - starts[0]).total_seconds() >= 0.9
    assert sorted((r.batch_id, r.word) for r in read_batches(spark, out).collect()) == [(0, "w0"), (1, "w1")]


def test_cli_funnel_enrich_landing(spark, root):
    from adsift.__main__ import main

    out = scratch_path(spark, "cli-funnel")
    main(["funnel", "--root", root, "--out", out, "--start", "2024-01-03", "--end", "2024-01-04",
          "--dims", "version", "--grain", "day"])
    lines = spark.read.text(out).collect()
    assert lines and all(r.value.startswith("(") for r in lines) and {str(r.dt) for r in lines} <= {
        "2024-01-03", "2024-01-04"}

    out = scratch_path(spark, "cli-enrich")
    main(["enrich", "--root", root, "--out", out, "--date", DAY, "--sponsor", "0", "--all-apps"])
    assert read_lines(spark, f"{out}/{DAY}_impr").count() == \
        td.impr(spark, SF).filter(f"dt = '{DAY}' AND sponsor_id = 0").count()

    out = scratch_path(spark, "cli-landing")
    main(["landing", "--root", root, "--out", out, "--start", "1995-03-01", "--end", "1995-03-02", "--strict"])
    assert read_lines(spark, f"{out}/daily_text").count() >= 1


def test_jobs_read_the_hourly_layout(spark, root):
    from adsift.__main__ import main

    hourly = scratch_path(spark, "hourly-feeds")
    for name, fn in (("pv", td.pv), ("bid", td.bid), ("impr", td.impr), ("click", td.click)):
        day = fn(spark, SF).filter(F.col("dt") == DAY)
        for (h,) in day.select("hour").distinct().collect():
            (day.filter(F.col("hour") == h).drop("dt", "hour")
             .write.parquet(f"{hourly}/{name}/hourly/{DAY.replace('-', '/')}/{h:02d}"))
    a, b = scratch_path(spark, "fh"), scratch_path(spark, "fp")
    main(["funnel", "--root", hourly, "--layout", "hourly", "--out", a, "--start", DAY])
    main(["funnel", "--root", root, "--out", b, "--start", DAY])
    got, want = read_lines(spark, a).collect(), read_lines(spark, b).collect()
    assert got and sorted(r.value for r in got) == sorted(r.value for r in want)
