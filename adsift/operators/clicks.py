"""Click device/time sets: distinct ``(timestamp, device)`` per day, and the
list of one sponsor's clicks over a day range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift import fixed
from adsift.functions import to_text
from adsift.sources.feeds import time_range

DEFAULT_SPONSOR_ID = fixed.CLICK_SPONSOR_ID


def _parts(ts="ts", device="device_id") -> list[Column]:
    return [to_text(F.unix_millis(F.col(ts).cast("timestamp"))), to_text(device)]


def click_key(ts="ts", device="device_id") -> Column:
    """``"<epoch millis> <device>"`` with a NULL time or device as ``null``."""
    return F.concat_ws(" ", *_parts(ts, device))


def click_device_times(click: DataFrame, start=None, end=None) -> DataFrame:
    """Per day: click rows (``n_clicks``) and distinct ``(ms, device)`` pairs."""
    c = time_range(click, start, end)
    return c.groupBy("dt").agg(F.count("*").alias("n_clicks"),
                               F.count_distinct(*_parts()).alias("n_device_times"))


def sponsor_click_devices(click: DataFrame, sponsor_id=DEFAULT_SPONSOR_ID,
                          start=None, end=None) -> DataFrame:
    """Distinct ``"<ms> <device>"`` lines (``value``) of one sponsor's clicks
    (all sponsors when ``None``)."""
    c = time_range(click, start, end)
    if sponsor_id is not None:
        c = c.filter(F.col("sponsor_id") == sponsor_id)
    return c.select(click_key().alias("value")).distinct()
