"""End-to-end jobs: read feeds for a time range, run an operator, write a sink.

These are what a scheduler calls for the hourly/daily feeds; the operators
they use are plain DataFrame functions (``adsift.operators``). Feed format,
time range, output file count and output layout are parameters; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.operators import clicks, cohort, enrich, funnel, landing
from adsift.session import cut_lineage
from adsift.sinks import read_table, write_table, write_text
from adsift.sources import default_run_date, read_cohort, read_feed, read_hourly_layout, time_range
from adsift.streaming import file_line_stream, socket_line_stream, word_count_stream

_DIMS = {"default": funnel.default_dims, "abtest": funnel.abtest_dims, "version": funnel.version_dims}


def _feeds(spark, root, start, end, fmt, names, layout="partitioned"):
    """Feeds for a day range from ``<root>/<feed>/dt=...`` (``partitioned``) or
    from the ``<root>/<feed>/hourly/YYYY/MM/DD/HH`` directories (``hourly``)."""
    if layout == "hourly":
        if start is None:
            raise ValueError("the hourly layout needs a start date")
        return [read_hourly_layout(spark, root, n, start, end, fmt=fmt) for n in names]
    if layout != "partitioned":
        raise ValueError("layout must be 'partitioned' or 'hourly'")
    return [read_feed(spark, root, n, start, end, fmt=fmt) for n in names]


def funnel_job(spark: SparkSession, root: str, out: str, start, end=None, slot_id=None,
               dims: str = "default", grain: str = "hour", per_day: bool = False,
               fmt: str = "parquet", num_files: int | None = None,
               layout: str = "partitioned") -> DataFrame:
    """Funnel counters as ``(key,(pv,bid,impr,click,charge))`` text; with
    ``per_day`` one ``dt=`` directory per day."""
    pv, bid, impr, click = _feeds(spark, root, start, end or start, fmt, ("pv", "bid", "impr", "click"), layout)
    per_day = per_day or dims == "version"          # the day is part of the version key
    result = funnel.funnel(pv, bid, impr, click, dims=_DIMS[dims](), grain=grain, per_day=per_day,
                           slot_id=slot_id)
    key = {"default": ["mcc", "vendor", "nsv", "av"], "abtest": ["abtest", "=", "=", "="],
           "version": [F.date_format("dt", "yyyyMMdd"), "=", "=", "av"]}[dims]
    lines = funnel.funnel_text(result, key)
    write_text(lines, out, num_files=num_files, partition_by=["dt"] if per_day else None)
    return result


def daily_enrichment_job(spark: SparkSession, root: str, out: str, run_date=None,
                         sponsor_id=enrich.DEFAULT_SPONSOR_ID, app_ids=enrich.DEFAULT_APP_IDS,
                         fmt: str = "parquet", num_files: int | None = None,
                         tz: str | None = None, layout: str = "partitioned") -> None:
    """Yesterday's (or ``run_date``'s) impressions and clicks of one sponsor,
    enriched from page views, as ``;``-separated text under
    ``<out>/<date>_impr`` and ``<out>/<date>_click``. The page-view side is
    reduced once and joined to both feeds."""
    day = run_date or default_run_date(spark)
    pv, impr, click = _feeds(spark, root, day, day, fmt, ("pv", "impr", "click"), layout)
    if sponsor_id is not None:          # only the sponsor's bids need a page view
        pv = enrich.restrict_to_bids(pv, *[e.filter(F.col("sponsor_id") == sponsor_id) for e in (impr, click)])
    # Reduce the page views once, checkpointed in the shared folder (also cuts
    # lineage, so a lost executor does not re-scan the page views).
    first = cut_lineage(enrich.first_pv_device(pv, app_ids))
    for name, events in (("impr", impr), ("click", click)):
        rows = enrich.enrich_with_first(events, first, sponsor_id=sponsor_id, tz=tz)
        write_text(enrich.enrich_text(rows), f"{out.rstrip('/')}/{day}_{name}", num_files=num_files)


def click_devices_job(spark: SparkSession, root: str, out: str, start, end=None,
                      sponsor_id=clicks.DEFAULT_SPONSOR_ID, fmt: str = "parquet",
                      num_files: int | None = None, layout: str = "partitioned") -> DataFrame:
    """Distinct ``"<ms> <device>"`` lines of one sponsor's clicks."""
    (click,) = _feeds(spark, root, start, end or start, fmt, ("click",), layout)
    lines = clicks.sponsor_click_devices(click, sponsor_id)
    write_text(lines, out, num_files=num_files)
    return lines


def cohort_reach_job(spark: SparkSession, root: str, cohort_paths: list[str], out: str, start,
                     end=None, fmt: str = "parquet", num_files: int | None = None,
                     layout: str = "partitioned") -> DataFrame:
    """Distinct cohort ids reached by page views, one per line."""
    (pv,) = _feeds(spark, root, start, end or start, fmt, ("pv",), layout)
    ids = cohort.cohort_ids(pv, read_cohort(spark, *cohort_paths, distinct=False))
    write_text(ids.withColumnRenamed("id", "value"), out, num_files=num_files)
    return ids


def landing_report_job(spark: SparkSession, root: str, out: str, start, end=None,
                       strict: bool = False, fmt: str = "parquet", layout: str = "partitioned") -> None:
    """Daily and per-(day, sponsor, slot) landing metrics as text and parquet."""
    (land,) = _feeds(spark, root, start, end or start, fmt, ("land_page",), layout)
    write_table(landing.landing_group_avg(land, strict=strict), f"{out}/groups", partition_by=["dt"])
    # The feed is read once: both texts derive from the groups.
    groups = time_range(read_table(spark, f"{out}/groups").withColumn("dt", F.col("dt").cast("date")), start, end or start)
    write_text(landing.landing_group_text(groups), f"{out}/group_text")
    write_text(landing.landing_daily_text(landing.landing_daily_of_groups(groups)), f"{out}/daily_text")


def word_count_job(spark: SparkSession, out: str, checkpoint: str, path: str | None = None,
                   host: str | None = None, port: int | None = None, trigger: dict | None = None,
                   num_files: int | None = None, max_files_per_trigger: int | None = None):
    """Per-batch word counts from a text-file directory or a socket server."""
    lines = socket_line_stream(spark, host, port) if host else file_line_stream(spark, path, max_files_per_trigger)
    return word_count_stream(lines, out, checkpoint, trigger, num_files)
