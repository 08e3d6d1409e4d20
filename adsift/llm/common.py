"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.session import scratch_path

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(text_col: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def row_key(c: Column) -> Column:
    """With the id, this names a row: rows equal in both are repeats of one document."""
    return F.xxhash64(c)


def hash128(c: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes, ``h1`` and ``h2``."""
    return [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit("second"), c).alias("h2")]


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage,
    survives lost executors, and lets adaptive execution split a skewed join on it."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
