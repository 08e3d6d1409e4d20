"""Explicit schemas of the log feeds (named columns replace ordinal access).

Every feed also carries the partition columns ``dt`` (date) and ``hour`` (int)
derived from ``ts``; on disk a feed is laid out as ``<root>/<feed>/dt=../hour=..``
so a time range becomes partition pruning instead of a loop over paths.
"""

from pyspark.sql.types import (
    ArrayType, DateType, IntegerType, LongType, MapType, StringType, StructField,
    StructType, TimestampType,
)

_STR_MAP = MapType(StringType(), StringType())

_PARTS = [StructField("dt", DateType()), StructField("hour", IntegerType())]

PV = StructType([
    StructField("ts", TimestampType()),
    StructField("row_id", LongType()),
    StructField("bid_id", StringType()),
    StructField("app_id", StringType()),
    StructField("slot_id", StringType()),
    StructField("device_id", StringType()),
    StructField("device_name", StringType()),
    StructField("tags", ArrayType(StringType())),
    StructField("ext", _STR_MAP),    # udid, auid
    StructField("dims", _STR_MAP),   # mcc, nsv, av
    *_PARTS,
])

BID = StructType([
    StructField("ts", TimestampType()),
    StructField("row_id", LongType()),
    StructField("bid_id", StringType()),
    StructField("slot_id", StringType()),
    *_PARTS,
])

IMPR = StructType([
    StructField("ts", TimestampType()),
    StructField("row_id", LongType()),
    StructField("bid_id", StringType()),
    StructField("slot_id", StringType()),
    StructField("sponsor_id", LongType()),
    StructField("app_id", StringType()),
    StructField("ip", StringType()),
    *_PARTS,
])

CLICK = StructType([
    *IMPR.fields[:-2],
    StructField("device_id", StringType()),
    StructField("charge", IntegerType()),
    *_PARTS,
])

PV_DSP = StructType([
    StructField("ts", TimestampType()),
    StructField("row_id", LongType()),
    StructField("synd_id", LongType()),
    StructField("ext", _STR_MAP),    # IDFA, DEVICEID
    *_PARTS,
])

LAND_PAGE = StructType([
    StructField("ts", TimestampType()),
    StructField("sponsor_id", LongType()),
    StructField("slot_id", StringType()),
    StructField("ht", LongType()),
    StructField("lt", LongType()),
    StructField("pt", LongType()),
    StructField("ext", _STR_MAP),    # fd
    *_PARTS,
])

COHORT = StructType([StructField("id", StringType())])

RECORDS = StructType([
    StructField("key", IntegerType()),
    StructField("value", StringType()),
])

LINES = StructType([StructField("value", StringType())])

FEEDS = {
    "pv": PV, "bid": BID, "impr": IMPR, "click": CLICK,
    "pv_dsp": PV_DSP, "land_page": LAND_PAGE,
}
