"""A training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``. Rows with null or empty texts pass every
filter (they have nothing to reject) and are packed as an end token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsift.llm.common import read_table, row_key, text_of, written
from adsift.llm.decontam import drop_contaminated
from adsift.llm.jaccard_forest import near_duplicates
from adsift.llm.line_dedup import dedup_lines
from adsift.llm.packing import pack_documents
from adsift.llm.toxicity import score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go. Learns from the rows of ``labels`` outside the held-out fold."""
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < 0.5).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; ``n_chars`` follows the text."""
    found = dedup_lines(docs)
    return found.select(*[
        F.col("kept_text").alias(c) if c == "text" else
        F.char_length("kept_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"row.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest id.
    Rows without an id stay."""
    classes = near_duplicates(docs).select(F.col("id").alias("c_id"), F.col("row_hash").alias("c_hash"), "is_first").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("c_id"), row_key(text_of("text")).alias("c_hash"))
    kept = rows.join(classes.filter("is_first"), ["c_id", "c_hash"]).dropDuplicates(["c_id", "c_hash"]).select("row.*")
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly, go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    import public_tokenizers
    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontamination), ("packing", packing)]

#: Models and tokenizers are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
