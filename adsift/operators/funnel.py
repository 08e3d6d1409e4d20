"""Delivery funnel: page views -> bids -> impressions -> clicks, rolled up by
page-view dimensions.

The four feeds are stacked with ``unionByName`` (one-hot counters), folded to
one row per ``(grain, bid_id)`` and then summed by the dimensions of the bid's
latest page view. This is a cogroup expressed as two hash-partitioned
aggregations, both with map-side partial aggregation: a hot ``bid_id`` is
collapsed before the shuffle, NULL bids group together (as in a cogroup), and
nothing per bid is materialised in memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift import fixed
from adsift.functions import map_value, tag_value
from adsift.sources.feeds import time_range

COUNTERS = ("pv", "bid", "impr", "click", "charge")


def default_dims() -> dict[str, Column]:
    """Dimensions of the daily funnel: mcc, vendor tag, nsv, app version."""
    return {
        "mcc": map_value("dims", fixed.DIM_MCC),
        "vendor": tag_value("tags", fixed.TAG_VENDOR, fixed.TAG_SEP),
        "nsv": map_value("dims", fixed.DIM_NSV),
        "av": map_value("dims", fixed.DIM_AV),
    }


def abtest_dims() -> dict[str, Column]:
    return {"abtest": tag_value("tags", fixed.TAG_ABTEST, fixed.TAG_SEP)}


def version_dims() -> dict[str, Column]:
    return {"av": map_value("dims", fixed.DIM_AV)}


def _stage(df: DataFrame, kind: str, grain_cols, key_type=None, dims=None) -> DataFrame:
    one = lambda name: F.lit(1 if kind == name else 0).alias(name)
    if kind == "pv":
        key = F.struct(*[c.alias(n) for n, c in dims.items()])
        order = F.struct(F.col("ts"), F.col("row_id"))
    else:
        key = F.lit(None).cast(key_type)
        order = F.lit(None).cast("struct<ts:timestamp,row_id:bigint>")
    charge = F.col("charge").cast("int") if kind == "click" else F.lit(0)
    return df.select(*grain_cols, "bid_id", key.alias("k"), order.alias("o"),
                     one("pv"), one("bid"), one("impr"), one("click"), charge.alias("charge"))


def funnel(pv: DataFrame, bid: DataFrame, impr: DataFrame, click: DataFrame,
           dims: dict[str, Column] | None = None, grain: str = "hour",
           per_day: bool = False, slot_id: str | None = None,
           start=None, end=None, per_hour: bool = False) -> DataFrame:
    """Funnel counters by page-view dimensions.

    ``grain`` is the attribution window: ``hour`` (an event only meets page
    views of its own hour, as in the hourly jobs) or ``day``. Each
    ``(grain, bid_id)`` takes its dimensions from its latest page view by
    ``(ts, row_id)``; groups with no page view are reported with NULL
    dimensions and ``attributed = false``. ``per_day`` keeps ``dt`` in the
    output key, ``per_hour`` (with the hour grain) ``dt`` and ``hour``. ``slot_id``/``start``/``end`` filter every feed (pushed to the
    scans). Counters are bigint (``charge`` cannot wrap).
    """
    if grain not in ("hour", "day"):
        raise ValueError("grain must be 'hour' or 'day'")
    if per_hour and grain != "hour":
        raise ValueError("counters per hour need the hour grain")
    dims = dims or default_dims()
    grain_cols = ["dt", "hour"] if grain == "hour" else ["dt"]

    def scope(df):
        df = time_range(df, start, end)
        return df.filter(F.col("slot_id") == slot_id) if slot_id is not None else df

    p = _stage(scope(pv), "pv", grain_cols, dims=dims)
    key_type = p.schema["k"].dataType
    parts = [p] + [_stage(scope(df), kind, grain_cols, key_type=key_type)
                   for kind, df in (("bid", bid), ("impr", impr), ("click", click))]
    stacked = reduce(DataFrame.unionByName, parts)

    # bid_id first: the sort aggregate then sorts on a discriminating prefix.
    per_bid = stacked.groupBy("bid_id", *grain_cols).agg(
        F.max_by("k", "o").alias("k"),
        *[F.sum(c).alias(c) for c in COUNTERS],
    )
    kept = ["dt", "hour"] if per_hour else ["dt"] if per_day else []
    return (per_bid
            .select(*kept, *[F.col("k")[n].alias(n) for n in dims], F.col("k").isNotNull().alias("attributed"), *COUNTERS)
            .groupBy(*kept, *dims.keys(), "attributed")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTERS]))


def funnel_text(result: DataFrame, key_fields: list[Column | str]) -> DataFrame:
    """Render funnel rows as ``(key,(pv,bid,impr,click,charge))`` text lines.

    ``key`` joins ``key_fields`` with commas for attributed rows and is empty
    for rows without a page view. A ``dt`` column, when present, is kept.
    """
    fields = [F.lit(f[1:]) if isinstance(f, str) and f.startswith("=") else
              (F.col(f) if isinstance(f, str) else f) for f in key_fields]
    key = F.when(F.col("attributed"), F.concat_ws(",", *fields)).otherwise(F.lit(""))
    counters = F.concat_ws(",", *[F.col(c).cast("string") for c in COUNTERS])
    line = F.concat(F.lit("("), key, F.lit(",("), counters, F.lit("))"))
    keep = [c for c in result.columns if c == "dt"]
    return result.select(line.alias("value"), *keep)
