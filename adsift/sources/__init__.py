"""Sources: hourly log feeds, cohort lists, and adapters from the test tables."""

from adsift.sources.feeds import (  # noqa: F401
    cohort_of, default_run_date, hourly_glob, read_cohort, read_feed, read_hourly_layout, read_lines,
    time_range, union_cohorts, with_partitions, with_path_hour,
)
