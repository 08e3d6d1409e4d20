"""Relational basics over a ``(key int, value string)`` table and a filter/copy
job: temp views, SQL and DSL queries, parquet round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.session import scratch_path
from adsift.sinks import read_table, write_table


def register(df: DataFrame, name: str = "records") -> str:
    df.createOrReplaceTempView(name)
    return name


def select_all(spark: SparkSession, view: str = "records") -> DataFrame:
    return spark.sql(f"SELECT * FROM {view}")


def count_rows(spark: SparkSession, view: str = "records") -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS n FROM {view}")


def key_value_lines(spark: SparkSession, view: str = "records", below: int = 10) -> DataFrame:
    """``SELECT key, value WHERE key < below`` rendered as ``Key: k, Value: v``."""
    rows = spark.sql(f"SELECT key, value FROM {view} WHERE key < {int(below)}")
    return rows.select(F.format_string("Key: %s, Value: %s", "key", "value").alias("line"))


def key_lookup(records: DataFrame, key: int = 1) -> DataFrame:
    """DSL: ``where(key = k).orderBy(value).select(key)``."""
    return records.where(F.col("key") == key).orderBy(F.col("value").asc()).select("key")


def parquet_roundtrip(spark: SparkSession, records: DataFrame, path: str | None = None,
                      fmt: str = "parquet") -> DataFrame:
    """Write (overwrite) and read back; the result is queryable as a view."""
    path = path or scratch_path(spark, "pair")
    write_table(records, path, fmt=fmt)
    back = read_table(spark, path, fmt)
    register(back, "parquet_file")
    return spark.sql("SELECT * FROM parquet_file")


def value_alias(table: DataFrame, key: int = 1) -> DataFrame:
    """``where(key = k).select(value AS a)``."""
    return table.where(F.col("key") == key).select(F.col("value").alias("a"))


def filter_copy(spark: SparkSession, df: DataFrame, condition: str = "doctor > 5",
                fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Filter and write back in the same format; returns the written copy."""
    path = path or scratch_path(spark, "filtered")
    write_table(df.filter(condition), path, fmt=fmt)
    return read_table(spark, path, fmt)


def take_filtered(df: DataFrame, condition: str = "doctor > 5", n: int = 10,
                  order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows passing ``condition`` (ordered when ``order_by``)."""
    f = df.filter(condition)
    return (f.orderBy(*order_by) if order_by else f).limit(n)
