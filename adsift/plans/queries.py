"""Registered queries: each callable takes ``(spark, sf_dir)``, adapts the test
tables to feeds (``adsift.sources.testdata``) and runs one library job over
the whole tables. Sink queries write into the shared folder and return what
they read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.operators import clicks, cohort, enrich, funnel, landing, relation
from adsift.operators.funnel_store import FunnelStore, changed_hours
from adsift.operators.reach_store import ReachStore, dsp_hits
from adsift.session import cut_lineage, scratch_path
from adsift.sinks import write_table, write_text
from adsift.sources import default_run_date, read_cohort, read_feed, read_hourly_layout, read_lines, union_cohorts
from adsift.sources import testdata as td
from adsift.streaming import (
    file_line_stream, first_seen_stream, hourly_stream, ingest_hours, read_batches, read_first_seen, read_running_totals,
    run_to_end, running_totals_stream, word_count_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixture parameters (the library defaults name slots/sponsors/apps absent here).
FIXTURE_OWN_APPS = ("25", "46")
FIXTURE_MIN_DEVICES = 10
FIXTURE_LAND_SLOT = "F"
FIXTURE_FORM_MARKER = "ref="
FIXTURE_SLOT = "1"
FIXTURE_SPONSOR = 1
FIXTURE_APPS = tuple(str(i) for i in range(50))
FIXTURE_DAYS = ("2024-01-03", "2024-01-20")
FIXTURE_HOURS = range(6, 18)
FIXTURE_LATE_HOURS = (5, 6, 21)
FILES_PER_DAY = 20


def _feeds(spark, sf):
    return td.pv(spark, sf), td.bid(spark, sf), td.impr(spark, sf), td.click(spark, sf)


def funnel_by_dims(spark, sf):
    return funnel.funnel(*_feeds(spark, sf))


def funnel_day_grain(spark, sf):
    return funnel.funnel(*_feeds(spark, sf), grain="day")


def funnel_abtest_daily(spark, sf):
    return funnel.funnel(*_feeds(spark, sf), dims=funnel.abtest_dims(), per_day=True)


def funnel_version_daily(spark, sf):
    return funnel.funnel(*_feeds(spark, sf), dims=funnel.version_dims(), per_day=True)


def funnel_text(spark, sf):
    lines = funnel.funnel_text(funnel_by_dims(spark, sf), ["mcc", "vendor", "nsv", "av"])
    return read_lines(spark, write_text(lines, scratch_path(spark, "funnel")))


def funnel_abtest_daily_text(spark, sf):
    lines = funnel.funnel_text(funnel_abtest_daily(spark, sf), ["abtest", "=", "=", "="])
    path = write_text(lines, scratch_path(spark, "abtest"), num_files=FILES_PER_DAY, partition_by=["dt"])
    return spark.read.text(path)


def _feed_layout(spark, sf, *names):
    """The feeds as ``dt=`` directories; returns their root."""
    root = scratch_path(spark, "feeds")
    for name in names:
        write_table(getattr(td, name)(spark, sf), f"{root}/{name}", partition_by=["dt"])
    return root


def funnel_slot_range(spark, sf):
    """One slot over a range of days and hours, read from partitioned feeds."""
    names = ("pv", "bid", "impr", "click")
    root = _feed_layout(spark, sf, *names)
    feeds = [read_feed(spark, root, n, *FIXTURE_DAYS, hours=FIXTURE_HOURS) for n in names]
    return funnel.funnel(*feeds, slot_id=FIXTURE_SLOT)


def _late(feeds):
    """Some rows of some hours that come late."""
    late = F.col("hour").isin(*FIXTURE_LATE_HOURS) & (F.col("dt") >= F.lit(FIXTURE_DAYS[1]).cast("date")) & (F.col("row_id") % 3 == 0)
    return [f.filter(~late) for f in feeds], [f.filter(late) for f in feeds]


def funnel_incremental(spark, sf):
    """The funnel from a table of hourly partials, after late rows have had their hours (and no others) computed again."""
    feeds = _feeds(spark, sf)
    in_time, late = _late(feeds)
    store = FunnelStore(spark, scratch_path(spark, "funnel-store"))
    store.refresh(*in_time)
    rows = late[0].select("dt", "hour")
    for f in late[1:]:
        rows = rows.unionByName(f.select("dt", "hour"))
    store.refresh(*feeds, hours=changed_hours(rows))
    return store.report()


def funnel_version_daily_text(spark, sf):
    key = [F.date_format("dt", "yyyyMMdd"), "=", "=", "av"]
    lines = funnel.funnel_text(funnel_version_daily(spark, sf), key)
    path = write_text(lines, scratch_path(spark, "version"), partition_by=["dt"])
    return spark.read.text(path)


def impression_enrich(spark, sf):
    return enrich.enrich_events(td.impr(spark, sf), td.pv(spark, sf), sponsor_id=None, app_ids=None,
                                tz="UTC")


def click_enrich(spark, sf):
    return enrich.enrich_events(td.click(spark, sf), td.pv(spark, sf), sponsor_id=None, app_ids=None,
                                tz="UTC")


def impression_enrich_sponsor(spark, sf):
    """One sponsor, an app list and a day range."""
    return enrich.enrich_events(td.impr(spark, sf), td.pv(spark, sf), sponsor_id=FIXTURE_SPONSOR,
                                app_ids=FIXTURE_APPS, start=FIXTURE_DAYS[0], end=FIXTURE_DAYS[1], tz="UTC")


def click_enrich_sponsor(spark, sf):
    return enrich.enrich_events(td.click(spark, sf), td.pv(spark, sf), sponsor_id=FIXTURE_SPONSOR,
                                app_ids=FIXTURE_APPS, start=FIXTURE_DAYS[0], end=FIXTURE_DAYS[1], tz="UTC")


def _first_pv_table(spark, sf):
    """All page views reduced to a table in buckets by bid."""
    name = scratch_path(spark, "first_pv")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return enrich.write_first_pv(td.pv(spark, sf), name.rsplit("/", 1)[1].replace("-", "_"), name, buckets, app_ids=None)


def enrich_bucketed(spark, sf):
    """Impressions and clicks, both joined to one bucketed table of first page views."""
    first = _first_pv_table(spark, sf)
    both = [enrich.enrich_with_first(feed(spark, sf), first, sponsor_id=None, tz="UTC").withColumn("feed", F.lit(name))
            for name, feed in (("impr", td.impr), ("click", td.click))]
    return both[0].unionByName(both[1])


def impression_enrich_text(spark, sf):
    lines = enrich.enrich_text(impression_enrich(spark, sf))
    return read_lines(spark, write_text(lines, scratch_path(spark, "impr")))


def click_enrich_text(spark, sf):
    lines = enrich.enrich_text(click_enrich(spark, sf))
    return read_lines(spark, write_text(lines, scratch_path(spark, "click")))


def _both_cohorts(spark, sf):
    return union_cohorts(*td.cohorts(spark, sf), distinct=False)


def _cohort_files(spark, sf):
    return [write_text(td.cohort_lines(spark, sf, seg), scratch_path(spark, "cohort"))
            for seg in ("BUILDING", "MACHINERY")]


def slot_cohort_reach(spark, sf):
    return cohort.slot_cohort_reach(td.pv(spark, sf), read_cohort(spark, *_cohort_files(spark, sf), distinct=False))


def cohort_size(spark, sf):
    return cohort.cohort_size(read_cohort(spark, *_cohort_files(spark, sf)))


def click_device_times(spark, sf):
    return clicks.click_device_times(td.click(spark, sf))


def sponsor_click_devices(spark, sf):
    out = clicks.sponsor_click_devices(td.click(spark, sf), sponsor_id=None)
    return read_lines(spark, write_text(out, scratch_path(spark, "clicks")))


def one_sponsor_click_devices(spark, sf):
    out = clicks.sponsor_click_devices(td.click(spark, sf), sponsor_id=FIXTURE_SPONSOR,
                                       start=FIXTURE_DAYS[0], end=FIXTURE_DAYS[1])
    return read_lines(spark, write_text(out, scratch_path(spark, "clicks"), num_files=2))


def cohort_reach(spark, sf):
    return cohort.cohort_reach(td.pv(spark, sf), _both_cohorts(spark, sf))


def cohort_reach_ids(spark, sf):
    return cohort.cohort_ids(td.pv(spark, sf), _both_cohorts(spark, sf))


def cohort_reach_bloom(spark, sf):
    """The same ids, with a Bloom filter of the list tested before the shuffle."""
    return cohort.cohort_ids(td.pv(spark, sf), _both_cohorts(spark, sf), bloom=True)


def cohort_reach_ids_text(spark, sf):
    ids = cohort_reach_ids(spark, sf).select(F.col("id").alias("value"))
    return read_lines(spark, write_text(ids, scratch_path(spark, "reach")))


def dsp_new_by_hour(spark, sf):
    return cohort.dsp_new_by_hour(td.pv_dsp(spark, sf), _both_cohorts(spark, sf), max_hour=23)


def reach_cumulative_hours(spark, sf):
    """Cumulative distinct cohort ids over all hours of all days, from a bitmap store."""
    store = ReachStore(spark, scratch_path(spark, "reach-store"))
    store.add_hours(dsp_hits(td.pv_dsp(spark, sf), _both_cohorts(spark, sf)))
    return store.totals()


def reach_cumulative_late(spark, sf):
    """The same store filled in three steps (early days, later days, then hours that came late for some of either);
    the report starts at a day within the second step."""
    hits = cut_lineage(dsp_hits(td.pv_dsp(spark, sf), _both_cohorts(spark, sf)))
    late = F.col("hour").isin(*FIXTURE_LATE_HOURS)
    early = F.col("dt") <= F.lit(FIXTURE_DAYS[0]).cast("date")
    store = ReachStore(spark, scratch_path(spark, "reach-store"))
    for part in (early & ~late, ~early & ~late, late):
        store.add_hours(hits.filter(part))
    return store.totals(start=FIXTURE_DAYS[1])


def dsp_new_by_hour_salted(spark, sf):
    """The same, with ids that over a hundredth of the tuples have salted."""
    return cohort.dsp_new_by_hour(td.pv_dsp(spark, sf), _both_cohorts(spark, sf), max_hour=23, hot_share=0.01)


def cohort_by_app_flag_salted(spark, sf):
    c1, c2 = td.cohorts(spark, sf)
    return cohort.cohort_by_app_flag(td.pv(spark, sf), c1, c2, app_ids=FIXTURE_OWN_APPS, hot_share=0.01)


def cohort_by_app_flag(spark, sf):
    c1, c2 = td.cohorts(spark, sf)
    return cohort.cohort_by_app_flag(td.pv(spark, sf), c1, c2, app_ids=FIXTURE_OWN_APPS)


def slot_device_pairs(spark, sf):
    return cohort.slot_device_pairs(td.pv(spark, sf), _both_cohorts(spark, sf))


def slot_device_counts(spark, sf):
    return cohort.slot_device_counts(td.pv(spark, sf), _both_cohorts(spark, sf),
                                     min_devices=FIXTURE_MIN_DEVICES)


def landing_daily_avg(spark, sf):
    return landing.landing_daily_avg(td.land_page(spark, sf))


def landing_daily_strict(spark, sf):
    return landing.landing_daily_avg(td.land_page(spark, sf), strict=True)


def landing_daily_text(spark, sf):
    lines = landing.landing_daily_text(landing_daily_avg(spark, sf))
    return read_lines(spark, write_text(lines, scratch_path(spark, "landing")))


def landing_group_text(spark, sf):
    return landing.landing_group_text(landing_group_avg(spark, sf))


def landing_group_avg(spark, sf):
    return landing.landing_group_avg(td.land_page(spark, sf))


def landing_form_counts(spark, sf):
    return landing.landing_form_counts(td.land_page(spark, sf), slot=FIXTURE_LAND_SLOT)


def landing_form_dups(spark, sf):
    return landing.landing_form_dups(td.land_page(spark, sf), slot=FIXTURE_LAND_SLOT)


def landing_form_buckets(spark, sf):
    return landing.landing_form_buckets(td.form(spark, sf))


def landing_form_quality(spark, sf):
    return landing.landing_form_quality(td.form(spark, sf), marker=FIXTURE_FORM_MARKER)


def slot_form_values(spark, sf):
    return landing.slot_form_values(td.form(spark, sf))


def _records(spark, sf):
    recs = td.records(spark, sf)
    relation.register(recs, "records")
    return recs


def relation_select_all(spark, sf):
    _records(spark, sf)
    return relation.select_all(spark)


def relation_count(spark, sf):
    _records(spark, sf)
    return relation.count_rows(spark)


def relation_key_lines(spark, sf):
    _records(spark, sf)
    return relation.key_value_lines(spark)


def relation_key_lookup(spark, sf):
    return relation.key_lookup(_records(spark, sf))


def parquet_roundtrip(spark, sf):
    return relation.parquet_roundtrip(spark, td.records(spark, sf))


def parquet_value_alias(spark, sf):
    return relation.value_alias(relation.parquet_roundtrip(spark, td.records(spark, sf)))


def episodes_count(spark, sf):
    return td.episodes(spark, sf).agg(F.count("*").alias("n"))


def episodes_filter_copy(spark, sf):
    return relation.filter_copy(spark, td.episodes(spark, sf))


def episodes_take(spark, sf):
    return relation.take_filtered(td.episodes(spark, sf), order_by=["p_partkey"])


def stream_word_count(spark, sf):
    """The documents' lines arrive as text files, one for each micro-batch;
    every batch is counted on its own. ``parts_in_batch`` is the number of files that the
    word's batch held."""
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("wc-in", "wc-out", "wc-ckpt"))
    write_text(td.document_lines(spark, sf), inbox, num_files=1, partition_by=["part"])
    lines = file_line_stream(spark, inbox, max_files_per_trigger=1, line_sep="\n")
    run_to_end(word_count_stream(lines, out, ckpt, trigger={"availableNow": True}))
    counts = read_batches(spark, out)
    files = counts.groupBy("batch_id").agg(F.count_distinct("part").alias("parts_in_batch"))
    return counts.join(files, "batch_id").select("part", "parts_in_batch", "word", "n")


def stream_word_count_timed(spark, sf):
    """The same under the one-second trigger, stopped once all files are counted. Batches hold what has arrived."""
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("wc-in", "wc-out", "wc-ckpt"))
    write_text(td.document_lines(spark, sf), inbox, num_files=1, partition_by=["part"])
    query = word_count_stream(file_line_stream(spark, inbox, line_sep="\n"), out, ckpt, trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    query.stop()
    return read_batches(spark, out).groupBy("part", "word").agg(F.sum("n").alias("n"))


def _two_batches(files):
    """Files for each trigger, so that ``files`` (two or more) arrive in two batches, the first the larger."""
    return -(-2 * files // 3)


def stream_running_totals(spark, sf):
    """Word totals over all batches, in a stream that stops halfway and goes on from its checkpoint. Files grow in number with the table."""
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("rt-in", "rt-out", "rt-ckpt"))
    lines, files = td.document_lines(spark, sf), td.document_files(spark, sf) // 2
    schema = "value string"
    for own in (F.col("part") % 2 == 0, F.col("part") % 2 != 0):
        write_table(lines.filter(own).select("value"), inbox, num_files=files, mode="append")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", _two_batches(files)).parquet(inbox)
        run_to_end(running_totals_stream(stream, out, ckpt, trigger={"availableNow": True}))
    return read_running_totals(spark, out)


#: Page views in a file of the stream, about; each half of the feed comes in three files at least.
ROWS_PER_FILE = 1_000_000


def stream_first_seen(spark, sf):
    """The hour in which each cohort id was first seen, kept as the hours arrive: even hours first, then odd ones, in a stream that
    ends between the two and goes on from its checkpoint."""
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("fs-in", "fs-out", "fs-ckpt"))
    feed, cohort = td.pv_dsp(spark, sf), cut_lineage(union_cohorts(*td.cohorts(spark, sf)))
    files = max(3, feed.count() // (2 * ROWS_PER_FILE))
    for odd in (0, 1):
        write_table(feed.filter(F.col("hour") % 2 == odd), inbox, num_files=files, mode="append")
        stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", _two_batches(files)).parquet(inbox)
        run_to_end(first_seen_stream(stream, cohort, out, ckpt, trigger={"availableNow": True}))
    return read_first_seen(spark, out)


def hourly_ingest(spark, sf):
    """Hourly directories taken in by two runs of one stream: the second run reads only the days that came after the first,
    and the files that came late for earlier ones. ``run`` is 1 or 2."""
    root, out, ckpt = (scratch_path(spark, n) for n in ("hr-in", "hr-out", "hr-ckpt"))
    bids = td.bid(spark, sf)
    late = (F.col("dt") > F.lit(FIXTURE_DAYS[1]).cast("date")) | (F.col("row_id") % 10 == 0)
    first = 0
    for run, own in enumerate((~late, late)):
        td.hourly_layout(bids.filter(own), root, "bid")
        run_to_end(ingest_hours(hourly_stream(spark, root, "bid", fmt="parquet"), out, ckpt, num_files=1))
        if run == 0:
            first = read_batches(spark, out).agg(F.max("batch_id")).first()[0]
    return (read_batches(spark, out).groupBy(F.when(F.col("batch_id") <= first, 1).otherwise(2).alias("run"), "dt", "hour")
            .agg(F.count("*").alias("n_rows"), F.count_distinct("row_id").alias("n_ids")))


def hourly_layout_range(spark, sf):
    """A range of days and hours read through the directory glob."""
    root = scratch_path(spark, "hourly")
    td.hourly_layout(td.bid(spark, sf), root, "bid")
    rows = read_hourly_layout(spark, root, "bid", *FIXTURE_DAYS, hours=FIXTURE_HOURS, fmt="parquet")
    return rows.groupBy("dt", "hour", "slot_id").agg(F.count("*").alias("n_rows"))


def yesterday_clicks(spark, sf):
    """The default daily partition: the clicks' last day becomes yesterday (of the session time zone), and the run without a
    date takes exactly that day. Days are counted back from the default date."""
    clicks_ = td.click(spark, sf)
    yesterday = default_run_date(spark)
    shift = F.date_diff(F.lit(yesterday), F.lit(clicks_.agg(F.max("dt")).first()[0]))
    root = scratch_path(spark, "yesterday")
    write_table(clicks_.withColumn("dt", F.date_add("dt", shift)), f"{root}/click", partition_by=["dt"])
    day = default_run_date(spark)
    rows = read_feed(spark, root, "click", start=day, end=day)
    return rows.groupBy(F.date_diff(F.lit(day), F.col("dt")).alias("days_back"), "slot_id").agg(F.count("*").alias("n_rows"))


QUERIES: dict[str, Query] = {
    "funnel_by_dims": funnel_by_dims,
    "funnel_day_grain": funnel_day_grain,
    "funnel_abtest_daily": funnel_abtest_daily,
    "funnel_version_daily": funnel_version_daily,
    "funnel_slot_range": funnel_slot_range,
    "funnel_text": funnel_text,
    "funnel_abtest_daily_text": funnel_abtest_daily_text,
    "funnel_version_daily_text": funnel_version_daily_text,
    "impression_enrich": impression_enrich,
    "click_enrich": click_enrich,
    "impression_enrich_sponsor": impression_enrich_sponsor,
    "click_enrich_sponsor": click_enrich_sponsor,
    "impression_enrich_text": impression_enrich_text,
    "click_enrich_text": click_enrich_text,
    "slot_cohort_reach": slot_cohort_reach,
    "cohort_size": cohort_size,
    "click_device_times": click_device_times,
    "sponsor_click_devices": sponsor_click_devices,
    "one_sponsor_click_devices": one_sponsor_click_devices,
    "cohort_reach": cohort_reach,
    "cohort_reach_ids": cohort_reach_ids,
    "cohort_reach_ids_text": cohort_reach_ids_text,
    "dsp_new_by_hour": dsp_new_by_hour,
    "reach_cumulative_hours": reach_cumulative_hours,
    "reach_cumulative_late": reach_cumulative_late,
    "cohort_by_app_flag": cohort_by_app_flag,
    "cohort_reach_bloom": cohort_reach_bloom,
    "dsp_new_by_hour_salted": dsp_new_by_hour_salted,
    "cohort_by_app_flag_salted": cohort_by_app_flag_salted,
    "funnel_incremental": funnel_incremental,
    "enrich_bucketed": enrich_bucketed,
    "slot_device_pairs": slot_device_pairs,
    "slot_device_counts": slot_device_counts,
    "landing_daily_avg": landing_daily_avg,
    "landing_group_avg": landing_group_avg,
    "landing_daily_strict": landing_daily_strict,
    "landing_daily_text": landing_daily_text,
    "landing_group_text": landing_group_text,
    "landing_form_counts": landing_form_counts,
    "landing_form_dups": landing_form_dups,
    "landing_form_buckets": landing_form_buckets,
    "landing_form_quality": landing_form_quality,
    "slot_form_values": slot_form_values,
    "relation_select_all": relation_select_all,
    "relation_count": relation_count,
    "relation_key_lines": relation_key_lines,
    "relation_key_lookup": relation_key_lookup,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_value_alias": parquet_value_alias,
    "episodes_count": episodes_count,
    "episodes_filter_copy": episodes_filter_copy,
    "episodes_take": episodes_take,
    "stream_word_count": stream_word_count,
    "stream_word_count_timed": stream_word_count_timed,
    "stream_running_totals": stream_running_totals,
    "stream_first_seen": stream_first_seen,
    "hourly_ingest": hourly_ingest,
    "hourly_layout_range": hourly_layout_range,
    "yesterday_clicks": yesterday_clicks,
}
