"""A Bloom filter of a long id list, tested before rows are shuffled to the exact join.

The filter is built from built-in expressions: every id sets a few bits, bits are or-ed together by word,
and the words become one array of at most ``MAX_BITS / 8`` bytes, which a scalar subquery hands to the scan's tasks. Rows that fail
the test are not in the list for certain; the rest go to the exact join, so a filter that is too small for its list
only lets more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB, enough for 6.7 million ids at 1 % false positives; a longer list gets a weaker filter.
MAX_BITS = 1 << 26
BITS_PER_ID = 10
HASHES = 7


def filter_bits(ids: DataFrame, id_col: str = "id", bits_per_id: int = BITS_PER_ID, max_bits: int = MAX_BITS) -> int:
    """Size of a filter for a list: a power of two of about ``bits_per_id`` for each distinct id."""
    n = ids.agg(F.approx_count_distinct(id_col)).first()[0]
    return min(max_bits, max(64, 1 << (max(1, n * bits_per_id) - 1).bit_length()))


def _positions(c: Column, bits: int, hashes: int) -> list[Column]:
    return [F.xxhash64(F.lit(j), c).bitwiseAND(bits - 1) for j in range(hashes)]


def bloom_words(ids: DataFrame, bits: int, id_col: str = "id", hashes: int = HASHES) -> DataFrame:
    """One row, ``words``: the filter as an array of 64-bit words."""
    own = ids.select(F.col(id_col).cast("string").alias("_id")).filter(F.col("_id") != "")
    placed = own.select(F.explode(F.array(*_positions(F.col("_id"), bits, hashes))).alias("p"))
    words = (placed.select(F.shiftright("p", 6).alias("word"), F.col("p").bitwiseAND(63).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    every = ids.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("word"), "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(F.transform(listed, lambda w: w["bits"]).alias("words"))   # bits / 64 rows


def may_contain(words: Column, id_col: Column, bits: int, hashes: int = HASHES) -> Column:
    """False only for ids that are not in the list; NULL counts as none."""
    test = F.lit(True)
    for p in _positions(id_col, bits, hashes):
        word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
        test = test & (F.getbit(word, p.bitwiseAND(63).cast("int")) == 1)
    return F.coalesce(id_col.isNotNull() & test, F.lit(False))


def prefilter(rows: DataFrame, col: str, ids: DataFrame, id_col: str = "id", bits: int | None = None) -> DataFrame:
    """The rows whose ``col`` may be in the list ``ids``. The test runs in the tasks that made the rows, before any exchange."""
    bits = bits or filter_bits(ids, id_col)
    return rows.filter(may_contain(bloom_words(ids, bits, id_col).scalar(), F.col(col).cast("string"), bits))
