"""Sinks: text, parquet/avro tables, date-partitioned directories.

Output file count is a parameter and is applied with ``repartition`` at the
sink only, so it never narrows an upstream aggregation to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _shape(df: DataFrame, num_files: int | None, partition_by) -> DataFrame:
    """``num_files`` files in all, or in every ``partition_by`` directory (a
    directory of few rows may get fewer). Without it, directories are
    rebalanced: adaptive execution joins small ones and splits a large one."""
    if not partition_by:
        return df if num_files is None else df.repartition(num_files)
    if num_files is None:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    rest = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    # An explicit count: adaptive execution would join a day's parts again.
    n = max(num_files, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *partition_by, F.pmod(F.xxhash64(*rest), F.lit(num_files)))


def write_text(df: DataFrame, path: str, num_files: int | None = None,
               partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """One line per row from the single string column ``value`` (plus
    ``partition_by`` columns, written as ``col=value`` directories)."""
    w = _shape(df, num_files, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.text(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", num_files: int | None = None,
                partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Write ``df`` as ``fmt`` (parquet, orc, json, avro where deployed)."""
    w = _shape(df, num_files, partition_by).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as table ``table`` at ``path``, in ``buckets`` buckets sorted by ``key`` (one file each), and
    return it. Joins and aggregates on ``key`` read it without an exchange."""
    (df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").format(fmt)
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
