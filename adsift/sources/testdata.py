"""Adapters from the driver's test tables to the feed schemas (FIXTURES.md §2).

These only rename and re-shape columns so the jobs can run on the given data;
they do none of the jobs' work. ``k`` below is the JSON field ``props.k``.
"""

from __future__ import annotations

import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift import fixed
from adsift.sinks import write_table
from adsift.sources.feeds import with_partitions

# The form feed cycles over the two landing slot ids and a suffix of the first.
FORM_SLOTS = (fixed.LANDING_SLOT, fixed.LANDING_SLOT[-4:], "another-landing-slot")


#: A repeated vendor (the last that splits into two parts is '8'), and an abtest tag of three parts.
BAD_TAGS = ("vendor", "vendor:", "vendor:9", "abtest:1:2", ":abtest", "vendor:8:")


def _utc(c) -> Column:
    """The tables' naive timestamps are UTC wall-clock times: make instants."""
    spark = SparkSession.getActiveSession()
    tz = spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(c).cast("timestamp_ntz")).cast("timestamp")


def _parts(df: DataFrame) -> DataFrame:
    return with_partitions(df, tz="UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir, event_type=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if event_type is not None:
        ev = ev.filter(F.col("event_type") == event_type)
    return ev.withColumn("k", F.get_json_object("props", "$.k"))


def _unless(n: int, value, key: str = "event_id") -> Column:
    """``value``, but NULL in every ``n``-th row (by ``key``)."""
    return F.when(F.col(key) % n != 0, value)


def _ids(ev: DataFrame):
    uid = F.col("user_id")
    return [
        _utc("ts").alias("ts"),
        F.col("event_id").alias("row_id"),
        _unless(101, uid.cast("string")).alias("bid_id"),
        _unless(103, (uid % 4).cast("string")).alias("slot_id"),
    ]


def pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "view")
    uid, k = F.col("user_id"), F.col("k")
    udid = F.concat(F.lit("ifa:"), k)
    ext = F.when(F.col("event_id") % 2 == 0,
                 F.create_map(F.lit("udid"), udid, F.lit("auid"), k)
                 ).otherwise(F.create_map(F.lit("udid"), udid))
    df = ev.select(
        *_ids(ev),
        k.alias("app_id"),
        _unless(107, uid.cast("string")).alias("device_id"),
        F.concat(F.lit("device-"), (F.col("event_id") % 7).cast("string")).alias("device_name"),
        F.when(F.col("event_id") % 11 == 0, F.array(*[F.lit(t) for t in BAD_TAGS])).otherwise(
            F.array(F.concat(F.lit("vendor:"), (uid % 3).cast("string")),
                    F.concat(F.lit("abtest:"), (uid % 2).cast("string")))).alias("tags"),
        ext.alias("ext"),
        F.create_map(F.lit("av"), k, F.lit("mcc"), (uid % 5).cast("string")).alias("dims"),
    )
    return _parts(df).select("ts", "row_id", "bid_id", "app_id", "slot_id", "device_id",
                                      "device_name", "tags", "ext", "dims", "dt", "hour")


def bid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "signup")
    return _parts(ev.select(*_ids(ev)))


def impr(spark: SparkSession, sf_dir: str, event_type: str = "click") -> DataFrame:
    ev = _events(spark, sf_dir, event_type)
    return _parts(ev.select(
        *_ids(ev),
        _unless(109, F.col("user_id") % 3).alias("sponsor_id"),
        F.col("k").alias("app_id"),
        F.col("event_id").cast("string").alias("ip"),
        *([_unless(107, F.col("user_id").cast("string")).alias("device_id"),
           F.round(F.col("value") * 100).cast("int").alias("charge")]
          if event_type == "purchase" else []),
    ))


def click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impr(spark, sf_dir, "purchase")


def pv_dsp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    uid = F.col("user_id")
    return _parts(ev.select(
        _utc("ts").alias("ts"),
        F.col("event_id").alias("row_id"),
        F.when(uid % 5 == 0, F.lit(0)).otherwise(F.lit(112)).cast("bigint").alias("synd_id"),
        F.create_map(F.lit("IDFA"), uid.cast("string"), F.lit("DEVICEID"), F.col("k")).alias("ext"),
    ))


def land_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    flag, order = F.col("l_returnflag"), F.col("l_orderkey") % 13
    # Values that the strict rule rejects: '', 'null', 'None' and a present key without a value.
    fd = (F.when(order == 0, F.lit("")).when(order == 1, F.lit("null")).when(order == 2, F.lit("None"))
          .when(order == 3, F.lit(None).cast("string")).otherwise(flag))
    ext = F.when(flag != "N", F.create_map(F.lit("fd"), fd)).otherwise(
        F.create_map().cast("map<string,string>"))
    return _parts(li.select(
        _utc("l_shipdate").alias("ts"),
        _unless(17, F.col("l_suppkey"), "l_orderkey").alias("sponsor_id"),
        _unless(19, F.col("l_linestatus"), "l_orderkey").alias("slot_id"),
        F.col("l_extendedprice").cast("bigint").alias("ht"),
        _unless(23, F.col("l_linenumber").cast("bigint"), "l_orderkey").alias("lt"),
        F.col("l_partkey").alias("pt"),
        ext.alias("ext"),
    ))


def form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing-page feed whose ``fd`` is a form text (page urls; ``ref=`` plays
    the marker). ``page=2`` loses its value on every fourth page; every seventh has no ``fd``."""
    pg = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    fd = F.when(pid % 4 == 0, F.replace(F.col("url"), F.lit("page=2"), F.lit("page="))
                ).otherwise(F.col("url"))
    slot = (F.when(pid % 3 == 0, F.lit(FORM_SLOTS[0]))
            .when(pid % 3 == 1, F.lit(FORM_SLOTS[1])).otherwise(F.lit(FORM_SLOTS[2])))
    ts = F.timestamp_seconds(F.lit(1704067200) + (pid % 48) * 3600)   # 2024-01-01 + 0..47 h
    return _parts(pg.select(
        ts.alias("ts"), pid.alias("sponsor_id"), slot.alias("slot_id"),
        F.length("url").cast("bigint").alias("ht"), F.lit(0).cast("bigint").alias("lt"),
        F.lit(0).cast("bigint").alias("pt"),
        F.when(pid % 7 == 0, F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("fd"), fd)).alias("ext"),
    ))


def cohorts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two raw device lists (``id``): customer keys of two market segments."""
    cu = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    ids = lambda s: cu.filter(seg == s).select(F.col("c_custkey").cast("string").alias("id"))
    return ids("BUILDING"), ids("MACHINERY")


def cohort_lines(spark: SparkSession, sf_dir: str, segment: str) -> DataFrame:
    """A device list as text lines (``value``), before any cleaning."""
    cu = table(spark, sf_dir, "customer")
    return cu.filter(F.col("c_mktsegment") == segment).select(
        F.col("c_custkey").cast("string").alias("value"))


#: Files that the documents arrive in as a stream: six, or one for so many documents.
STREAM_FILES, DOCS_PER_FILE = 6, 50_000


def document_files(spark: SparkSession, sf_dir: str) -> int:
    """The number of files that the documents arrive in."""
    return max(STREAM_FILES, table(spark, sf_dir, "documents").count() // DOCS_PER_FILE)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of the documents (``value``) and the number of the file
    (``part``) that each document arrives in."""
    docs, files = table(spark, sf_dir, "documents"), document_files(spark, sf_dir)
    return docs.select((F.col("doc_id") % files).cast("int").alias("part"),
                       F.explode(F.split(F.col("text"), "\n", -1)).alias("value"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key int, value 'val_<key>')`` rows, one per part."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("key"),
                    F.concat(F.lit("val_"), F.col("p_partkey").cast("string")).alias("value"))


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the numeric ``doctor`` column the filter/copy jobs read."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", "p_brand", F.col("p_size").alias("doctor"))


def hourly_layout(df: DataFrame, root: str, feed: str) -> None:
    """Write a feed as ``<root>/<feed>/hourly/YYYY/MM/DD/HH`` directories, one file each: partition
    directories first, then each is given its place (a directory that is already there gets one more file)."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    at = lambda *parts: fs_path("/".join(parts))
    staged = f"{root}/{feed}-staged-{uuid.uuid4().hex}"
    stamped = df.withColumn("_dir", F.concat(F.date_format("dt", "yyyy/MM/dd"), F.lit("/"), F.lpad(F.col("hour").cast("string"), 2, "0")))
    write_table(stamped.drop("dt", "hour"), staged, num_files=1, partition_by=["_dir"])
    fs = at(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in fs.globStatus(at(staged, "_dir=*")):
        name = urllib.parse.unquote(d.getPath().getName().removeprefix("_dir="))
        target = at(root, feed, "hourly", name)
        fs.mkdirs(target)
        for f in fs.globStatus(fs_path(d.getPath(), "part-*")):
            fs.rename(f.getPath(), fs_path(target, f.getPath().getName()))
