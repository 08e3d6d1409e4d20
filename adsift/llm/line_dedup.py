"""Line de-duplication with levelled sorted runs of line hashes.

Documents are taken in batches of ascending id. The line hashes seen so far
lie in *runs*: tables partitioned and sorted by hash, whose keys are disjoint.
A batch reduces its own lines to one row per hash (the smallest id), removes by
a sort-merge anti join the hashes that some run holds, and writes the rest as a
new run of level 0. When a level has ``fan_out`` runs they are merged
into one run of the next level, so a batch never joins more than
``fan_out * levels`` runs. At the end the runs together map each hash to the
smallest document holding it, and every later holder loses the line.

Only hashes, ids and line numbers are shuffled until the texts are rebuilt.
Each run is written under ``spark.checkpoint.dir`` before it is joined, so both
sides of every large join come straight from an exchange and adaptive
execution can split a line that a third of all documents holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsift.llm.common import SPACE_CHARS, ascii_lower, hash128, row_key, text_of, written

KEY = ["h1", "h2"]


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points:
    ``id, row_hash, line, h1, h2``. Rows without an id take no part."""
    text = text_of(text_col)
    # Hash and lines come before the explode: beside it, the whole text would be hashed again for every line.
    rows = (docs.filter(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("id"), row_key(text).alias("row_hash"), F.split(text, "\n", -1).alias("lines")))
    lines = rows.select("id", "row_hash", F.posexplode("lines").alias("line", "content"))
    keyed = lines.select("id", "row_hash", "line",
                         ascii_lower(F.btrim("content", F.lit(SPACE_CHARS))).alias("key"))
    return (keyed.filter(F.char_length("key") >= min_chars)
            .select("id", "row_hash", "line", *hash128(F.col("key"))))


def batch_bounds(docs: DataFrame, id_col: str, batches: int) -> list:
    """Upper ids of all batches but the last (about equal row counts)."""
    shares = [i / batches for i in range(1, batches)]
    ids = docs.select(F.col(id_col).cast("double").alias("id"))
    return sorted(set(ids.approxQuantile("id", shares, 0.01))) if shares else []


class LineRuns:
    """The levelled runs: ``levels[i]`` holds fewer than ``fan_out`` tables."""

    def __init__(self, fan_out: int):
        self.fan_out = fan_out
        self.levels: list[list[DataFrame]] = [[]]

    def tables(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def seen(self) -> DataFrame | None:
        runs = self.tables()
        if not runs:
            return None
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out

    def add(self, batch_lines: DataFrame) -> None:
        """Merge-anti-join a batch against the runs and add its new hashes."""
        own = batch_lines.groupBy(*KEY).agg(F.min("id").alias("first_id"))
        seen = self.seen()
        if seen is not None:
            own = own.join(seen.select(*KEY).hint("merge"), KEY, "left_anti")
        self.levels[0].append(written(own.sortWithinPartitions(*KEY), "line-run-0"))
        self._compact()

    def _compact(self) -> None:
        for i in range(len(self.levels) + 1):
            if i == len(self.levels) or len(self.levels[i]) < self.fan_out:
                return
            merged = self.levels[i][0]
            for run in self.levels[i][1:]:
                merged = merged.unionByName(run)
            merged = merged.repartition(*KEY).sortWithinPartitions(*KEY)
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(written(merged, f"line-run-{i + 1}"))
            self.levels[i] = []


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10, batches: int = 4, fan_out: int = 2) -> DataFrame:
    """Drop every line that a document with a smaller id also holds.

    A line's key is the line without white space at either end, A-Z lower-cased;
    keys under ``min_chars`` code points stay. Within the smallest document all
    copies of a line stay.

    Returns one row per input row: ``row`` (a struct of all its columns, so that
    no name can clash), ``n_lines``, ``n_dropped``, ``kept_text``. Null or empty
    text is one empty line. Rows with a null id keep all lines and hide none of
    others. Rows equal in id and text get equal results; rows that share an id
    but not the text are one document for the "smaller id" rule. An empty
    table gives an empty result.
    """
    bounds = batch_bounds(docs, id_col, batches)
    batch = F.lit(0)
    for b in bounds:
        batch = batch + (F.col("id") > F.lit(b)).cast("int")
    lines = written(line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", batch),
                    "line-hashes", ["batch"])
    runs = LineRuns(fan_out)
    for b in range(len(bounds) + 1):
        runs.add(lines.filter(F.col("batch") == b))

    dropped = (lines.join(runs.seen().hint("merge"), KEY).filter(F.col("id") > F.col("first_id"))
               .groupBy("id", "row_hash").agg(F.collect_set("line").alias("dropped")))
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("id"), row_key(text).alias("row_hash"))
    joined = rows.join(dropped, ["id", "row_hash"], "left")
    split = joined.select("row", "dropped", text.alias("full_text"), F.split(text, "\n", -1).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    return split.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.array_size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("full_text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")).alias("kept_text"))
