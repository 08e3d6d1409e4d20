"""Hourly funnel partials as a table, so that a report over many hours adds up small rows and a late hour is computed alone.

Attribution is by hour, so the counters of an hour depend on that hour's feeds only. The store keeps them, by dimensions, in one partition for
every ``(dt, hour)``; ``refresh`` computes the hours it is told (those a feed has new files for) and replaces just their partitions;
``report`` sums partitions. Any order of refreshes ends at what one run over all feeds gives.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.operators.funnel import COUNTERS, default_dims, funnel
from adsift.sinks import write_table
from adsift.sources.feeds import time_range


def in_hours(df: DataFrame, hours: Iterable[tuple]) -> DataFrame:
    """Rows of the given ``(day, hour)`` pairs: one predicate for each day, which prunes partitions."""
    by_day: dict[_dt.date, list[int]] = {}
    for day, hour in hours:
        by_day.setdefault(day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day)), []).append(int(hour))
    cond = F.lit(False)
    for day, own in by_day.items():
        cond = cond | ((F.col("dt") == F.lit(day)) & F.col("hour").isin(sorted(set(own))))
    return df.filter(cond)


def changed_hours(rows: DataFrame) -> list[tuple]:
    """The distinct ``(dt, hour)`` of new rows, as pairs for ``refresh`` (a pair for each hour, however many rows)."""
    return [(r["dt"], r["hour"]) for r in rows.select("dt", "hour").distinct().toLocalIterator()]


class FunnelStore:
    """Partials under ``root`` (a folder that all executors share) for fixed dimensions, ``files`` files an hour."""

    def __init__(self, spark: SparkSession, root: str, dims: dict[str, Column] | None = None, files: int = 1):
        self.spark, self.root, self.dims, self.files = spark, root.rstrip("/"), dims or default_dims(), files

    def refresh(self, pv: DataFrame, bid: DataFrame, impr: DataFrame, click: DataFrame, hours: Iterable[tuple] | None = None) -> None:
        """Compute ``hours`` (every hour of the feeds without them) from whole feeds and replace their partitions.
        An hour that has no row left in any feed keeps its old partition."""
        feeds = [pv, bid, impr, click]
        if hours is not None:
            hours = list(hours)
            if not hours:
                return
            feeds = [in_hours(f, hours) for f in feeds]
        write_table(funnel(*feeds, dims=self.dims, per_hour=True), self.root, num_files=self.files, partition_by=["dt", "hour"])

    def partials(self, start=None, end=None) -> DataFrame:
        schema = ", ".join([*(f"`{d}` string" for d in self.dims), "attributed boolean", *(f"{c} bigint" for c in COUNTERS),
                            "dt date, hour int"])
        return time_range(self.spark.read.schema(schema).parquet(self.root), start, end)

    def report(self, start=None, end=None, per_day: bool = False) -> DataFrame:
        """What ``funnel`` with the same dimensions gives for the days ``start`` to ``end``, from partials alone."""
        return (self.partials(start, end).groupBy(*(["dt"] if per_day else []), *self.dims, "attributed")
                .agg(*[F.sum(c).alias(c) for c in COUNTERS]))
