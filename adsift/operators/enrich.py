"""Enrich impressions/clicks with device fields of the bid's first page view.

The page-view side is first reduced to one row per ``bid_id`` (``min_by`` over
``(ts, row_id)``, partial-aggregated map-side) and checkpointed in the shared
folder, then left-joined: it never multiplies left rows, one reduction can
serve both event feeds, and with exchanges directly below both sides of the
join AQE can split a hot bid on the left (it does not where an aggregate stands
between). NULL bids (which never match) are salted across reducers. Spark
picks broadcast vs sort-merge from the runtime size of the
reduced side (``autoBroadcastJoinThreshold``), so nothing is broadcast blind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift import fixed
from adsift.functions import iso_millis, strip_id_prefix, to_text
from adsift.session import cut_lineage
from adsift.sinks import write_bucketed
from adsift.sources.feeds import time_range

DEFAULT_APP_IDS = fixed.ENRICH_APP_IDS
DEFAULT_SPONSOR_ID = fixed.ENRICH_SPONSOR_ID


def first_match(right: DataFrame, key: str, values: dict[str, Column],
                order: list[str]) -> DataFrame:
    """One row per ``key``: ``values`` of the earliest row by ``order``."""
    picked = F.min_by(F.struct(*[c.alias(n) for n, c in values.items()]),
                      F.struct(*[F.col(o) for o in order]))
    return (right.groupBy(key).agg(picked.alias("_first"))
            .select(key, *[F.col("_first")[n].alias(n) for n in values],
                    F.lit(True).alias("_matched")))


def first_pv_device(pv: DataFrame, app_ids=DEFAULT_APP_IDS) -> DataFrame:
    """Per bid: device id (``auid`` else ``udid``) and name of the first page
    view among ``app_ids`` (all apps when ``None``)."""
    p = pv if app_ids is None else pv.filter(F.col("app_id").isin(list(app_ids)))
    did = F.coalesce(F.try_element_at("ext", F.lit(fixed.EXT_AUID)),
                     F.try_element_at("ext", F.lit(fixed.EXT_UDID)))
    return first_match(p, "bid_id", {"did": did, "dn": F.col("device_name")}, ["ts", "row_id"])


def enrich_events(events: DataFrame, pv: DataFrame, sponsor_id=DEFAULT_SPONSOR_ID,
                  app_ids=DEFAULT_APP_IDS, start=None, end=None, tz: str | None = None) -> DataFrame:
    """Events of one sponsor (all when ``None``) with the first page view's
    device id and name.

    Output: ``ts_iso, device_id, device_name, ip, slot_id, app_id``. Without a
    page view both device fields are ``''``; with one, the id loses a 4-char
    scheme prefix when it contains ``:`` and stays NULL if the view had none.
    ``ts_iso`` is rendered in the session time zone, or UTC with ``tz="UTC"``.
    Runs the reduction of the page views at once.
    """
    pv = time_range(pv, start, end)
    if sponsor_id is not None:
        pv = restrict_to_bids(pv, _sponsor_events(events, sponsor_id, start, end))
    first = cut_lineage(first_pv_device(pv, app_ids))
    return enrich_with_first(events, first, sponsor_id, start, end, tz)


def write_first_pv(pv: DataFrame, table: str, path: str, buckets: int, app_ids=DEFAULT_APP_IDS,
                   start=None, end=None) -> DataFrame:
    """The reduced page-view side as a table bucketed and sorted by bid. Every event feed that is joined to it
    (``enrich_with_first``) brings its rows to the table's buckets, and the page views are not exchanged again. Take at least as
    many ``buckets`` as there are shuffle partitions, or Spark prefers to exchange both sides."""
    return write_bucketed(first_pv_device(time_range(pv, start, end), app_ids), table, path, "bid_id", buckets)


def _sponsor_events(events: DataFrame, sponsor_id, start=None, end=None) -> DataFrame:
    ev = time_range(events, start, end)
    return ev if sponsor_id is None else ev.filter(F.col("sponsor_id") == sponsor_id)


def restrict_to_bids(pv: DataFrame, *events: DataFrame) -> DataFrame:
    """Page views whose bid occurs in ``events`` (left-semi join on the
    non-NULL bids), so a one-sponsor run reduces only its own bids. A semi join cannot multiply, so the bids
    are not made distinct first: with an exchange directly below both sides AQE can split a hot bid."""
    bids = None
    for ev in events:
        b = ev.select("bid_id").filter(F.col("bid_id").isNotNull())
        bids = b if bids is None else bids.unionByName(b)
    return pv.join(bids, "bid_id", "left_semi")


def enrich_with_first(events: DataFrame, first: DataFrame, sponsor_id=DEFAULT_SPONSOR_ID,
                      start=None, end=None, tz: str | None = None) -> DataFrame:
    """``enrich_events`` against an already reduced page-view side
    (``first_pv_device``, checkpointed or written), so one reduction can serve
    several event feeds."""
    ev = _sponsor_events(events, sponsor_id, start, end).select("bid_id", "ts", "ip", "slot_id", "app_id")
    # NULL bids can never match; salt their join key so they spread over all
    # reducers instead of piling onto the one NULL hashes to.
    salt = F.xxhash64("ts", "ip", "slot_id", "app_id").cast("string")
    ev = ev.withColumn("_key", F.coalesce(F.col("bid_id"), F.concat(F.lit("\u0000"), salt)))
    first = first.withColumnRenamed("bid_id", "_pv_bid")
    j = ev.join(first, F.col("_key") == F.col("_pv_bid"), "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False)) & F.col("bid_id").isNotNull()
    return j.select(
        iso_millis("ts", tz).alias("ts_iso"),
        F.when(matched, strip_id_prefix("did", fixed.ID_SCHEME_MARKER, fixed.ID_PREFIX_LEN)).otherwise(F.lit("")).alias("device_id"),
        F.when(matched, F.col("dn")).otherwise(F.lit("")).alias("device_name"),
        "ip", "slot_id", "app_id",
    )


def enrich_text(enriched: DataFrame) -> DataFrame:
    """``ts;device;name;ip;slot;app;`` lines (trailing ``;``), NULL as ``null``."""
    cols = ["ts_iso", "device_id", "device_name", "ip", "slot_id", "app_id"]
    return enriched.select(F.concat_ws(fixed.ENRICH_SEP, *[to_text(c) for c in cols], F.lit("")).alias("value"))


__all__ = ["first_match", "first_pv_device", "enrich_events", "enrich_with_first", "enrich_text",
           "restrict_to_bids", "write_first_pv"]
