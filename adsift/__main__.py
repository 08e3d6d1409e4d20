"""Command line for the end-to-end jobs (use with spark-submit).

    spark-submit --py-files adsift.zip adsift/__main__.py funnel --root R --out O --start 2016-06-29
    python -m adsift enrich --root R --out O --sponsor 7   # yesterday by default

Cluster settings (master, shuffle partitions, checkpoint dir) come from the
submitting environment; nothing here overrides them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from adsift.plans import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="adsift")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp, dated=True):
        sp.add_argument("--root", required=True, help="feed root (<root>/<feed>/dt=.../hour=...)")
        sp.add_argument("--out", required=True)
        sp.add_argument("--format", default="parquet", help="feed format: parquet, avro, orc, ...")
        sp.add_argument("--layout", choices=["partitioned", "hourly"], default="partitioned",
                        help="feed directories: dt=YYYY-MM-DD/hour=H or hourly/YYYY/MM/DD/HH")
        if dated:
            sp.add_argument("--start", required=True)
            sp.add_argument("--end")
        sp.add_argument("--num-files", type=int, help="output file count (default: parallel)")

    def sponsors(sp):
        one = sp.add_mutually_exclusive_group(required=True)
        one.add_argument("--sponsor", type=int)
        one.add_argument("--all-sponsors", action="store_true")

    f = sub.add_parser("funnel", help="funnel counters by page-view dimensions")
    common(f)
    f.add_argument("--slot")
    f.add_argument("--dims", choices=["default", "abtest", "version"], default="default")
    f.add_argument("--grain", choices=["hour", "day"], default="hour")
    f.add_argument("--per-day", action="store_true")

    e = sub.add_parser("enrich", help="daily impression/click enrichment")
    common(e, dated=False)
    e.add_argument("--date", help="run date (default: yesterday)")
    sponsors(e)
    e.add_argument("--all-apps", action="store_true")

    c = sub.add_parser("click-devices", help="distinct click time/device lines of a sponsor")
    common(c)
    sponsors(c)

    r = sub.add_parser("cohort-reach", help="cohort ids reached by page views")
    common(r)
    r.add_argument("--cohort", nargs="+", required=True, help="device list text files")

    la = sub.add_parser("landing", help="landing-page averages")
    common(la)
    la.add_argument("--strict", action="store_true")

    w = sub.add_parser("word-count", help="per-batch word count stream")
    w.add_argument("--out", required=True)
    w.add_argument("--checkpoint", required=True)
    w.add_argument("--path", help="directory of arriving text files")
    w.add_argument("--host")
    w.add_argument("--port", type=int)
    w.add_argument("--num-files", type=int, help="files per batch (default: one per shuffle partition)")
    return p


def main(argv=None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"adsift-{a.job}").getOrCreate()
    if a.job == "funnel":
        jobs.funnel_job(spark, a.root, a.out, a.start, a.end, slot_id=a.slot, dims=a.dims,
                        grain=a.grain, per_day=a.per_day, fmt=a.format, num_files=a.num_files,
                        layout=a.layout)
    elif a.job == "enrich":
        kw = {"app_ids": None} if a.all_apps else {}
        jobs.daily_enrichment_job(spark, a.root, a.out, run_date=a.date, fmt=a.format,
                                  num_files=a.num_files, layout=a.layout, sponsor_id=a.sponsor, **kw)
    elif a.job == "click-devices":
        jobs.click_devices_job(spark, a.root, a.out, a.start, a.end, fmt=a.format,
                               num_files=a.num_files, layout=a.layout, sponsor_id=a.sponsor)
    elif a.job == "cohort-reach":
        jobs.cohort_reach_job(spark, a.root, a.cohort, a.out, a.start, a.end, fmt=a.format,
                              num_files=a.num_files, layout=a.layout)
    elif a.job == "landing":
        jobs.landing_report_job(spark, a.root, a.out, a.start, a.end, strict=a.strict, fmt=a.format,
                                layout=a.layout)
    elif a.job == "word-count":
        jobs.word_count_job(spark, a.out, a.checkpoint, path=a.path, host=a.host,
                            port=a.port, num_files=a.num_files).awaitTermination()


if __name__ == "__main__":
    main()
