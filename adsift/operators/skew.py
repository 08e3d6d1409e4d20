"""Joins that a hot key cannot hold up, where adaptive execution may not split them.

Heavy hitters are found by a sketch (``approx_top_k``: a bounded number of counters a task, merged). Their rows on the left
are dealt over ``salts`` tasks, and their rows on the right, one list entry or one reduced row each, are
repeated once for every salt. All other keys are joined as they are. Which keys the sketch reports changes the plan's balance, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift.functions import is_one_of

#: Keys that are salted, at most, and counters of the sketch.
MAX_HEAVY, TRACKED = 256, 10_000


def heavy_hitters(df: DataFrame, key: str, share: float) -> list:
    """Values of ``key`` that more than about ``share`` of all rows have (256 at most; NULL is none)."""
    top = F.expr(f"approx_top_k(_key, {MAX_HEAVY}, {TRACKED})")
    found = df.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()).agg(F.count("*").alias("n"), top.alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def default_salts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_salted(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, heavy: list,
                salts: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``left_key = right_key``, with the ``heavy`` keys spread over ``salts`` tasks (as many as there
    are shuffle partitions, by default). ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``: kinds in which a
    left row finds its whole match in one copy of the right side. The salt of a row follows from its content, so a task that is run again deals alike."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("a salted join keeps left rows: inner, left, left_semi or left_anti")
    same = F.col(left_key) == F.col(right_key)
    if not heavy:
        return left.join(right, same, how)
    salts = salts or default_salts(left)
    plain = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.when(is_one_of(left_key, heavy), F.pmod(F.xxhash64(F.lit("salt"), *plain), F.lit(salts))).otherwise(0)
    copies: Column = F.when(is_one_of(right_key, heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.withColumn("_salt", salt.cast("int"))
    spread = right.withColumn("_copy", F.explode(copies))
    return dealt.join(spread, same & (F.col("_salt") == F.col("_copy")), how).drop("_salt", "_copy")
