"""Per-batch word count over a stream of text lines.

Each micro-batch is counted on its own (no running state): ``foreachBatch``
groups the batch's words and writes ``<out>/batch_id=N`` in overwrite mode, so
a batch replayed after a failure rewrites the same directory (idempotent).
Progress is checkpointed at ``checkpoint_path`` (a path in the shared folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adsift import fixed
from adsift.functions import java_split


def socket_line_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP text server the user runs (column ``value``)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def file_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     line_sep: str | None = None) -> DataFrame:
    """Lines of text files arriving in ``path`` (column ``value``, and those of
    ``name=value`` directories)."""
    r = spark.readStream.format("text")
    if line_sep:
        r = r.option("lineSep", line_sep)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def words(lines: DataFrame, sep: str = fixed.WORD_SEP) -> DataFrame:
    """One row per word (``word``, and the lines' other columns), split with
    Java ``split`` rules."""
    return lines.select(*[c for c in lines.columns if c != "value"], F.explode(java_split("value", sep)).alias("word"))


def word_count_stream(lines: DataFrame, out_path: str, checkpoint_path: str,
                      trigger: dict | None = None, num_files: int | None = None) -> StreamingQuery:
    """Start the per-batch word count; ``trigger`` defaults to 1-second
    micro-batches (pass ``{"availableNow": True}`` to drain and stop).
    ``num_files`` caps the files per batch (repartitioned after counting)."""

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*batch.columns).agg(F.count("*").alias("n"))
        if num_files:
            counts = counts.repartition(num_files)
        counts.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = (words(lines).writeStream.foreachBatch(count_batch)
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    return w.start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait, without a limit, for a query that ends by itself (``availableNow``);
    a failed query raises."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_batches(spark: SparkSession, out_path: str) -> DataFrame:
    """All batch results: ``(batch_id, ..., word, n)``."""
    df = spark.read.parquet(out_path)
    return df.select(F.col("batch_id").cast("bigint").alias("batch_id"), *[c for c in df.columns if c != "batch_id"])
