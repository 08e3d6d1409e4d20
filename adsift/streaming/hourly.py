"""Incremental discovery of hourly feed directories.

A file stream over ``<root>/<feed>/hourly/YYYY/MM/DD/HH`` lists the directories and remembers in its checkpoint what it has
read, so each run takes only what has come since the last one, each file exactly once, and a late file of an old hour is
still found. With the ``availableNow`` trigger (the default) a run drains what there is and ends: an hourly batch job without
bookkeeping of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adsift import schemas
from adsift.sinks import write_table
from adsift.sources.feeds import with_path_hour

#: Hours of any age are read: the source's own limit (7 days before the newest file) would drop late backfills.
ANY_AGE = "36500d"


def hourly_stream(spark: SparkSession, root: str, feed: str, fmt: str = "avro", schema: StructType | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed's files as they arrive, with ``dt`` and ``hour`` from their directory. The schema is given, never inferred."""
    schema = schema or schemas.FEEDS[feed]
    reader = (spark.readStream.format(fmt).option("maxFileAge", ANY_AGE)
              .schema(StructType([f for f in schema.fields if f.name not in ("dt", "hour")])))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_path_hour(reader.load(f"{root.rstrip('/')}/{feed}/hourly/*/*/*/*"))


def for_each_batch(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint_path: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that gives every micro-batch to ``take(batch, batch_id)``. A batch that fails is given again, with the
    same rows and number, when the stream starts from its checkpoint the next time."""
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def ingest_hours(stream: DataFrame, out_path: str, checkpoint_path: str, trigger: dict | None = None,
                 num_files: int | None = None) -> StreamingQuery:
    """Write each batch of a feed to ``<out>/batch_id=N/dt=D/hour=H`` (``num_files`` files an hour), in overwrite mode, so
    that a batch given twice is there once. ``read_batches`` reads the whole."""
    def take(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{out_path}/batch_id={batch_id}", num_files=num_files, partition_by=["dt", "hour"])

    return for_each_batch(stream, take, checkpoint_path, trigger)


def hours_of(batch: DataFrame) -> DataFrame:
    """The distinct ``(dt, hour)`` of a batch."""
    return batch.select("dt", "hour").distinct()
