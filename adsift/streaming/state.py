"""Streams that keep state: ids first seen as the hours arrive, and running word totals.

State lies in Spark's state store under the checkpoint (for very many keys set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which keeps it on disk). A stream that stops or fails goes on
from its checkpoint. Every batch writes a directory of its own in overwrite mode, so one that is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adsift import fixed
from adsift.operators.cohort import dsp_candidates
from adsift.streaming.wordcount import words


def member_hits(rows: DataFrame, candidates: list, cohort: DataFrame) -> DataFrame:
    """``(dt, hour, id)`` of rows with a member among their candidates: the first in order. Stateless, so it may stand
    before a stateful operator: one left join for each candidate (``cohort`` has distinct ids). NULL and empty candidates, which are
    never members, are spread over all tasks."""
    out = rows.select("dt", "hour", *[c.alias(f"_c{i}") for i, c in enumerate(candidates)])
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*out.columns).cast("string"))
    hits = []
    for i in range(len(candidates)):
        own = cohort.select(F.col("id").cast("string").alias(f"_id{i}"))
        key = F.when(F.col(f"_c{i}") != "", F.col(f"_c{i}")).otherwise(salt)
        out = out.withColumn(f"_k{i}", key).join(own, F.col(f"_k{i}") == F.col(f"_id{i}"), "left")
        hits.append(F.col(f"_id{i}"))
    return out.select("dt", "hour", F.coalesce(*hits).alias("id")).filter(F.col("id").isNotNull())


def first_seen_stream(pv_dsp: DataFrame, cohort: DataFrame, out_path: str, checkpoint_path: str,
                      synd_id: int = fixed.DSP_SYND_ID, trigger: dict | None = None) -> StreamingQuery:
    """Keep, for every cohort id that a partner's page views reach, the earliest ``(dt, hour)`` seen so far. Hours may arrive in
    any order. Each batch writes the ids it met, with their hour as it stands."""
    hits = member_hits(pv_dsp.filter(F.col("synd_id") == synd_id), dsp_candidates(), cohort)
    first = hits.groupBy("id").agg(F.min(F.struct("dt", "hour")).alias("first"))

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.select("id", "first.dt", "first.hour").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = first.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def read_first_seen(spark: SparkSession, out_path: str) -> DataFrame:
    """``(id, dt, hour)`` after the last batch: an id's hour only ever moves back, so the least is the latest."""
    rows = spark.read.parquet(out_path)
    return rows.groupBy("id").agg(F.min(F.struct("dt", "hour")).alias("first")).select("id", "first.dt", "first.hour")


def running_totals_stream(lines: DataFrame, out_path: str, checkpoint_path: str, mode: str = "update",
                          trigger: dict | None = None) -> StreamingQuery:
    """Word counts over all batches so far. In ``update`` mode a batch writes the totals it has changed, in
    ``complete`` mode all totals."""
    if mode not in ("update", "complete"):
        raise ValueError("mode must be 'update' or 'complete'")
    totals = words(lines).groupBy("word").agg(F.count("*").alias("n"))

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = totals.writeStream.outputMode(mode).foreachBatch(take).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def read_running_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """``(word, n)`` after the last batch, from either mode: a word's latest total (in complete mode every batch repeats it)."""
    rows = spark.read.parquet(out_path)
    return rows.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))
