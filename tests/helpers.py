"""Small builders for literal feed rows (tests only)."""

from __future__ import annotations

import datetime as dt

from adsift import schemas
from adsift.sources.feeds import with_partitions

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def ts(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def feed(spark, name, rows):
    """rows: list of dicts with any subset of the feed's columns (ts required)."""
    sch = schemas.FEEDS[name]
    cols = [f.name for f in sch.fields if f.name not in ("dt", "hour")]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    from pyspark.sql.types import StructType
    df = spark.createDataFrame(data, StructType([sch[c] for c in cols]))
    return with_partitions(df)


def empty(spark, name):
    return feed(spark, name, [])
