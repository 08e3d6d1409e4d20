"""Reading hourly log feeds and device cohort lists.

A feed lives at ``<root>/<feed>/dt=YYYY-MM-DD/hour=H/`` in any file format
Spark reads (parquet by default; ``avro`` needs Spark's external Avro module
on the classpath). One read plus a filter on ``dt``/``hour`` replaces the
per-hour path loops: Spark prunes partitions, so only the requested hours are
listed and scanned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from adsift import schemas


def wall_clock(ts, tz: str | None = None) -> Column:
    """Local date-time (``timestamp_ntz``) of an instant in zone ``tz``
    (default: the session time zone)."""
    t = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp").cast("timestamp_ntz")
    if tz is None:
        return t
    return F.convert_timezone(F.lit(_session_tz()), F.lit(tz), t)


def _session_tz() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"


def with_partitions(df: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Add ``dt``/``hour`` partition columns: the event time's date and hour in
    zone ``tz`` (default: the session time zone)."""
    local = wall_clock(ts, tz)
    return df.withColumn("dt", F.to_date(local)).withColumn("hour", F.hour(local))


def default_run_date(spark: SparkSession, days_back: int = 1) -> _dt.date:
    """"Yesterday" (or ``days_back`` days ago) in the session time zone: the
    default daily partition."""
    return spark.range(1).select(F.date_sub(F.current_date(), days_back)).first()[0]


def _as_date(d):
    if d is None or isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)))


def time_range(df: DataFrame, start=None, end=None, hours=None) -> DataFrame:
    """Keep rows with ``start <= dt <= end`` (inclusive) and ``hour in hours``.

    On a partitioned feed these predicates become ``PartitionFilters``.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("dt") >= _as_date(start))
    if end is not None:
        cond = cond & (F.col("dt") <= _as_date(end))
    if hours is not None:
        cond = cond & F.col("hour").isin(list(hours))
    return df if (start is None and end is None and hours is None) else df.filter(cond)


def read_feed(spark: SparkSession, root: str, feed: str, start=None, end=None,
              hours=None, fmt: str = "parquet", schema=None) -> DataFrame:
    """Scan one feed over a time range; the schema is given, never inferred.

    The feed is laid out as ``<root>/<feed>/dt=YYYY-MM-DD[/hour=H]``, so the
    range becomes partition pruning. For the ``hourly/YYYY/MM/DD/HH`` layout
    use ``read_hourly_layout``; for unpartitioned files read them directly and
    add the columns with ``with_partitions``.
    """
    schema = schema or schemas.FEEDS.get(feed)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return time_range(reader.load(f"{root.rstrip('/')}/{feed}"), start, end, hours)


def hourly_glob(root: str, feed: str, start, end=None, hours=range(24)) -> str:
    """One glob over ``<root>/<feed>/hourly/YYYY/MM/DD/HH`` for a day range and
    a set of hours (a driver-side string of the day list, never data)."""
    d0 = start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start))
    end = start if end is None else end
    d1 = end if isinstance(end, _dt.date) else _dt.date.fromisoformat(str(end))
    days = []
    while d0 <= d1:
        days.append(f"{d0:%Y/%m/%d}")
        d0 += _dt.timedelta(days=1)
    hh = ",".join(f"{h:02d}" for h in hours)
    return f"{root.rstrip('/')}/{feed}/hourly/{{{','.join(days)}}}/{{{hh}}}"


def read_hourly_layout(spark: SparkSession, root: str, feed: str, start, end=None,
                       hours=range(24), fmt: str = "avro", schema=None,
                       allow_empty: bool = False) -> DataFrame:
    """Scan the hourly directory layout (``.../hourly/YYYY/MM/DD/HH/*``) for a
    day range and derive ``dt``/``hour`` from each file's path.

    Only the matching hour directories are listed (hours without data are
    simply absent from the glob's matches). A range without any directory (or
    a wrong root) is an error, unless ``allow_empty`` asks for an empty feed.
    """
    reader = spark.read.format(fmt)
    schema = schema or schemas.FEEDS.get(feed)
    if schema is not None:
        reader = reader.schema(StructType([f for f in schema.fields if f.name not in ("dt", "hour")]))
    try:
        df = reader.load(hourly_glob(root, feed, start, end, hours))
    except AnalysisException as e:
        if not allow_empty or "PATH_NOT_FOUND" not in str(e) or schema is None:
            raise
        return spark.createDataFrame([], schema)
    return with_path_hour(df)


def with_path_hour(df: DataFrame) -> DataFrame:
    """Add ``dt``/``hour`` from the ``hourly/YYYY/MM/DD/HH`` directory of each row's file."""
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"/hourly/(\d{4}/\d{2}/\d{2}/\d{2})/", 1)
    return (df.withColumn("_stamp", stamp)
            .withColumns({"dt": F.to_date(F.left("_stamp", F.lit(10)), "yyyy/MM/dd"),
                          "hour": F.right("_stamp", F.lit(2)).cast("int")})
            .drop("_stamp"))


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text files as one ``value`` row per line (bag union of all files)."""
    return spark.read.text(list(paths))


def read_cohort(spark: SparkSession, *paths: str, distinct: bool = True) -> DataFrame:
    """Device list files -> one-column ``id`` DataFrame, de-duplicated.

    Empty lines are not ids. With ``distinct=False`` repeated ids stay: membership joins do not mind them, and a list that
    comes to its join straight from an exchange lets adaptive execution split a hot id, which a ``distinct`` bars.
    """
    return cohort_of(read_lines(spark, *paths).select(F.col("value").alias("id")), distinct=distinct)


def union_cohorts(*cohorts: DataFrame, distinct: bool = True) -> DataFrame:
    """Set union of device lists (each a one-column ``id`` frame); the bag union with ``distinct=False``."""
    out = cohorts[0].select("id")
    for c in cohorts[1:]:
        out = out.unionByName(c.select("id"))
    return cohort_of(out, distinct=distinct)


def cohort_of(ids: DataFrame, col: str = "id", distinct: bool = True) -> DataFrame:
    """Normalise any one-column id frame into a cohort (non-empty, distinct unless told otherwise)."""
    out = (ids.select(F.col(col).cast("string").alias("id"))
           .filter(F.col("id").isNotNull() & (F.col("id") != "")))
    return out.distinct() if distinct else out
