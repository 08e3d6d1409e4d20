"""Summarise the physical plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts come from the final adaptive plan: each DataFrame is collected through
its own query execution, then its executed plan is read.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from adsift.plans.queries import QUERIES  # noqa: E402
from adsift.session import build_session  # noqa: E402

SINKS = {"funnel_text", "funnel_abtest_daily_text", "funnel_version_daily_text", "impression_enrich_text",
         "click_enrich_text", "sponsor_click_devices", "one_sponsor_click_devices", "cohort_reach_ids_text", "landing_daily_text", "parquet_roundtrip",
         "parquet_value_alias", "episodes_filter_copy", "stream_word_count"}


SCALE_NOTE = """Reading this at 100 TB: every aggregation has map-side partial aggregation, so hot keys (a NULL bid, one
device, one word) collapse before they are shuffled; the only joins are membership/enrichment joins against
an id list (a semi join, or an outer join that only sets flags) or one page view per bid, so no join multiplies
rows; NULL candidates never reach a join, NULL bids are salted, and both sides of every large join come straight from
an exchange, so that adaptive execution can split a hot id or bid (tested); no plan has a Python node, a cross
join, a driver collect or a single-partition stage other than final one-row counts and the bounded merge of
per-partition top-10s in `episodes_take`. The funnel needs exactly
two shuffles whatever the input size; the cohort queries shuffle distinct candidate tuples, not raw rows.
"""

JOINS = ["impression_enrich", "slot_cohort_reach", "cohort_reach", "dsp_new_by_hour",
         "cohort_by_app_flag", "slot_device_counts"]


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]       # keep the final adaptive plan only
    c = lambda pat: len(re.findall(pat, plan))
    fresh = "\n".join(ln for ln in plan.splitlines() if "ReusedExchange" not in ln)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", fresh)),
        "reused exchanges": c(r"ReusedExchange"),
        "broadcast joins": c(r"BroadcastHashJoin"),
        "sort-merge joins": c(r"SortMergeJoin"),
        "hash aggs": c(r"HashAggregate\("),
        "sort aggs": c(r"SortAggregate\("),
        "windows": c(r"\bWindow \["),
        "scans": c(r"FileScan "),
        "pushed filters": c(r"PushedFilters: \[[^\]]"),
        "python": c(r"Python|ArrowEval|BatchEval"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    cols = ["shuffles", "reused exchanges", "broadcast joins", "sort-merge joins", "hash aggs", "sort aggs", "windows",
            "scans", "pushed filters", "python"]
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}` on local mode (final adaptive plans; a shuffle")
    print("or broadcast that AQE reuses is counted once under `reused exchanges`). Sink queries")
    print("show the plan of reading their written output back; their write jobs use the plan of the")
    print("query they render. Broadcast joins appear where Spark's size check chose them at this scale;")
    print("with `autoBroadcastJoinThreshold=-1` (large cohorts) the same queries plan sort-merge joins")
    print("(see tests/test_cohort.py and tests/test_enrich.py).\n")
    print(SCALE_NOTE)
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, q in QUERIES.items():
        df = q(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        tag = " (sink read-back)" if name in SINKS else ""
        print(f"| `{name}`{tag} | " + " | ".join(str(s[c]) for c in cols) + " |")
    print("\n## Join queries with broadcast disabled (cohort / page-view side too large to broadcast)\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in JOINS:
        df = QUERIES[name](spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
