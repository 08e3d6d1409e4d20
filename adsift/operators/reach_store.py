"""Cumulative distinct reach over many days, kept as exact bitmaps.

A store holds, under one folder:

* ``ids``: the dictionary, one dense number (from 1) for every id ever seen;
* ``hours``: for every ``(dt, hour)`` the set of ids it reached, as 4 KB bitmaps of 32,768 numbers each;
* ``days`` and ``months``: the same sets, merged by bitwise or.

New hours are encoded and written as partitions of their own, and only their day and month are merged again;
feeds of earlier hours are never read twice. A report from any hour on starts from the months and days before it
and runs over the hours from there. Sets are exact, so an hour that is sent again simply
replaces its partition, and late hours come out as if they had been in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adsift import fixed
from adsift.operators.cohort import distinct_matches, dsp_candidates
from adsift.session import cut_lineage
from adsift.sinks import write_table
from adsift.sources.feeds import time_range

_SETS = "bucket bigint, bitmap binary"
_SCHEMAS = {"ids": "id string, num bigint", "hours": f"{_SETS}, dt date, hour int", "days": f"{_SETS}, dt date",
            "months": f"{_SETS}, month date"}
_PARTS = {"ids": None, "hours": ["dt", "hour"], "days": ["dt"], "months": ["month"]}
_ROW_BITS = 33   # monotonically_increasing_id: the partition above, the row below


def dsp_hits(pv_dsp: DataFrame, cohort: DataFrame, synd_id: int = fixed.DSP_SYND_ID, start=None, end=None) -> DataFrame:
    """``(dt, hour, id)``: the cohort ids that each hour of one partner's page views reached, and one
    row with a NULL id for every hour of the feed, so that hours without members are known."""
    pv = time_range(pv_dsp, start, end)
    own = pv.filter(F.col("synd_id") == synd_id)
    hits = distinct_matches(own, ["dt", "hour"], dsp_candidates(), cohort, out="id")
    return hits.unionByName(pv.select("dt", "hour", F.lit(None).cast("string").alias("id")).distinct())


def _first_of_month(c):
    return F.trunc(c, "month")


def _merged(sets: DataFrame, *keys: str) -> DataFrame:
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


class ReachStore:
    """A store of hourly reach under ``root`` (a folder that all executors share), ``files`` files for each set."""

    def __init__(self, spark: SparkSession, root: str, files: int = 1):
        self.spark, self.root, self.files = spark, root.rstrip("/"), files

    def _write(self, sets: DataFrame, name: str) -> None:
        write_table(sets, f"{self.root}/{name}", num_files=self.files, partition_by=_PARTS[name])

    def table(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        empty = self.spark.createDataFrame([], _SCHEMAS[name])
        writer = empty.write.mode("ignore")
        (writer.partitionBy(*_PARTS[name]) if _PARTS[name] else writer).parquet(path)
        return self.spark.read.schema(_SCHEMAS[name]).parquet(path)

    def _number(self, ids: DataFrame) -> None:
        """Give ids that the dictionary lacks the next dense numbers: their place among the new ids
        of their task, after those of the tasks before it."""
        known = self.table("ids")
        last = known.agg(F.coalesce(F.max("num"), F.lit(0))).first()[0]
        new = cut_lineage(ids.filter(F.col("id").isNotNull()).select("id").distinct().join(known, "id", "left_anti")
                          .select("id", F.monotonically_increasing_id().alias("_at")))
        new = new.select("id", F.shiftright("_at", _ROW_BITS).alias("_task"), F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"))
        before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)   # one row a task
        offsets = new.groupBy("_task").agg(F.count("*").alias("_n")).select(
            "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        numbered = new.join(offsets, "_task").select("id", (F.col("_before") + F.col("_row") + last + 1).alias("num"))
        write_table(numbered, f"{self.root}/ids", mode="append")

    def add_hours(self, hits: DataFrame) -> None:
        """Add (or replace) every hour that ``hits`` (``dt, hour, id``) has rows of. A NULL id is no id but
        marks its hour; repeated rows count once. Running it again with the same hours changes nothing."""
        hits = cut_lineage(hits.select("dt", "hour", F.col("id").cast("string").alias("id")).distinct())
        self._number(hits)
        coded = hits.join(self.table("ids"), "id", "left")
        sets = coded.groupBy("dt", "hour", F.bitmap_bucket_number("num").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("num")).alias("bitmap"))
        self._write(sets, "hours")
        days = hits.select("dt").distinct()
        self._write(_merged(self.table("hours").join(days, "dt", "left_semi"), "dt"), "days")
        months = days.select(_first_of_month("dt").alias("month")).distinct()
        in_months = self.table("days").withColumn("month", _first_of_month("dt")).join(months, "month", "left_semi")
        self._write(_merged(in_months, "month"), "months")

    def seen_before(self, start) -> DataFrame:
        """``(bucket, bitmap)``: all ids of the days before ``start``, from whole months and the days after them."""
        day = F.lit(start).cast("date")
        month = _first_of_month(day)
        return _merged(self.table("months").filter(F.col("month") < month).select("bucket", "bitmap").unionByName(
            self.table("days").filter((F.col("dt") < day) & (F.col("dt") >= month)).select("bucket", "bitmap")))

    def totals(self, start=None, end=None) -> DataFrame:
        """Per hour of the store from day ``start`` to ``end``: ``n_ids`` (distinct ids of the hour), ``n_new`` (never seen before, on
        any day) and ``n_total`` (distinct ids up to and with the hour, those of days before ``start`` included)."""
        hours = time_range(self.table("hours"), start, end).select("dt", "hour", "bucket", "bitmap")
        rows = hours
        if start is not None:
            rows = hours.unionByName(self.seen_before(start).select(
                F.lit(None).cast("date").alias("dt"), F.lit(None).cast("int").alias("hour"), "bucket", "bitmap"))
        order = Window.partitionBy("bucket").orderBy("dt", "hour")   # what was seen before comes first
        seen = F.bitmap_count(F.bitmap_or_agg("bitmap").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        counted = rows.select("dt", "hour", "bucket", seen.alias("seen"), F.bitmap_count("bitmap").alias("n"))
        new = counted.select("dt", "hour", "n", (F.col("seen") - F.coalesce(F.lag("seen").over(order), F.lit(0))).alias("new"))
        per_hour = new.groupBy("dt", "hour").agg(F.sum("n").alias("n_ids"), F.sum("new").alias("n_new"))
        running = Window.orderBy("dt", "hour").rowsBetween(Window.unboundedPreceding, 0)   # one row an hour
        return (per_hour.select("dt", "hour", "n_ids", "n_new", F.sum("n_new").over(running).alias("n_total"))
                .filter(F.col("dt").isNotNull()))
