"""Quality rules as a short-circuit cascade ordered by rejection per cost.

A rule is a native Boolean expression over a document's text that is true when
the document is rejected. On a bounded sample the operator measures each rule's
cost (seconds a row) and selectivity (share rejected), orders the rules by
rejection per cost, and evaluates them as one ``CASE`` chain, so a row pays for
a later rule only when all earlier ones let it pass. The order changes
cost and the name of the first failing rule, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift.llm.common import text_of, written

SYMBOLS = "#*$%&|<>"
SPACE = r"\x20\x09-\x0D"
WORD_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds the rejecting condition from the ``full_text`` and ``n_words`` columns."""
    name: str
    rejects: Callable[[Column, Column], Column]


def _count_chars(text: Column, chars: str) -> Column:
    """How many characters of a regex class a text has."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


RULES = [
    Rule("symbols", lambda t, n: _count_chars(t, SYMBOLS) * 10 > n),
    Rule("shouting", lambda t, n: _count_chars(t, "A-Z") * 2 > F.char_length(t)),
    Rule("exclamations", lambda t, n: _count_chars(t, "!?") * 2 > n),
    Rule("digits", lambda t, n: _count_chars(t, "0-9") * 2 > F.char_length(t)),
    Rule("word_length", lambda t, n: ~(F.char_length(t) - _count_chars(t, SPACE)).between(2 * n, 20 * n)),
    Rule("undecodable", lambda t, n: _count_chars(t, "�") * 100 > F.char_length(t)),
    Rule("ellipsis", lambda t, n: F.regexp_count(t, F.lit(r"(\.\.\.|…)[\x20\x09-\x0D]*(\n|$)")) * 10
         > 3 * (_count_chars(t, "\n") + 1)),
    Rule("bullets", lambda t, n: F.regexp_count(t, F.lit(r"(^|\n)[\x20\t]*[•●■-]\x20")) * 10
         > 9 * (_count_chars(t, "\n") + 1)),
    Rule("markup", lambda t, n: F.regexp_count(t, F.lit(r"(?i)lorem ipsum|\{\{|\}\}|javascript:")) * 50 > n),
]


def base_metrics(rows: DataFrame) -> DataFrame:
    """Adds the base metrics to ``rows`` (which has ``full_text``).

    Repeated 5-word windows are found by their hashes: a document without an
    equal pair (the common case) is done after one hash set; the others sort
    their (hash, position) pairs."""
    base = rows.select(
        "*", F.filter(F.split("full_text", WORD_GAP), lambda w: w != "").alias("words"),
        F.filter(F.split("full_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("filled_lines"))
    words = F.col("words")
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                          lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))
    base = base.select(
        *rows.columns, F.size(words).cast("long").alias("n_words"),
        (F.char_length("full_text") - _count_chars(F.col("full_text"), SPACE)).cast("long").alias("word_chars"),
        _count_chars(F.col("full_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("filled_lines") - F.size(F.array_distinct("filled_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(words) > WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    own = [c for c in base.columns if c != "windows"]
    hashes = F.col("windows")
    base = base.select(*own, F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("pairs"))
    pairs = F.col("pairs")
    twice = F.filter(pairs, lambda x, j: ((j > 0) & (F.get(pairs, j - 1)["h"] == x["h"]))
                     | ((j < F.size(pairs) - 1) & (F.get(pairs, j + 1)["h"] == x["h"])))
    base = base.select(*own, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("starts"))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("total"), F.lit(0).alias("free")),
        lambda acc, s: F.struct((acc["total"] + s + WINDOW - F.greatest(s, acc["free"])).alias("total"),
                                (s + WINDOW).alias("free")),
        lambda acc: acc["total"])
    return base.select(*own, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


#: Timed runs of each rule on the sample.
PROBES = 2


def quality_sample(docs: DataFrame, id_col: str, text_col: str, rows: int, max_chars: int) -> DataFrame:
    """At most ``rows`` texts: those with the smallest hashes of the id. The
    ids alone are ranked; texts are read only up to the last chosen hash."""
    at = F.xxhash64(F.col(id_col))
    last = docs.select(at.alias("at")).orderBy("at").limit(rows).agg(F.max("at")).first()[0]
    chosen = docs.filter(at <= last) if last is not None else docs
    return (chosen.select(text_of(text_col).alias("full_text")).filter(F.char_length("full_text") <= max_chars)
            .limit(rows)
            .select("full_text", F.size(F.filter(F.split("full_text", WORD_GAP), lambda w: w != "")).alias("n_words")))


def measure(sample: DataFrame, rules: list[Rule]) -> dict[str, tuple[float, float]]:
    """For each rule its (cost in seconds a row, share of rows rejected) on the
    sample; one aggregate row a rule reaches the driver. A cost is the least of ``PROBES`` runs, over that of a probe that only
    reads the rows; a first probe warms up."""
    n = max(1, sample.count())

    def probe(rejects) -> tuple[float, int]:
        took, job = [], sample.agg(F.count_if(rejects).alias("k"))
        for _ in range(PROBES):
            began = time.perf_counter()
            k = job.first()["k"]
            took.append(time.perf_counter() - began)
        return min(took), k

    reads = (F.col("n_words") < 0) | F.col("full_text").isNull()
    probe(reads)
    empty, _ = probe(reads)
    out = {}
    for rule in rules:
        took, rejected = probe(rule.rejects(F.col("full_text"), F.col("n_words")))
        out[rule.name] = (max(0.0, took - empty) / n, rejected / n)
    return out


def order_rules(rules: list[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """By rejection per cost, highest first; ties by the given order."""
    return sorted(rules, key=lambda r: -(measured[r.name][1] / max(measured[r.name][0], 1e-9)))


def apply_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        rules: list[Rule] | None = None, min_words: int = 10,
                        max_repeat_pct: int = 20, sample_rows: int = 2000,
                        sample_max_chars: int = 100_000) -> DataFrame:
    """Base metrics, the base rule and the cascade's verdict for every row.

    ``sample_rows`` bounds the sample (rows with the smallest hash of the id, of
    texts up to ``sample_max_chars``) that only sets the rules' order.

    Returns per row: ``row`` (struct of all input columns), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept`` and ``first_failed`` (the base rule's or the first
    rejecting rule's name, null if kept; it depends on the measured order).
    Null text has no words and fails the base rule; ids may be null or repeat;
    an empty table gives an empty result.
    """
    rules = RULES if rules is None else rules
    rows = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("full_text"))
    sample = quality_sample(docs, id_col, text_col, sample_rows, sample_max_chars) if rules else None
    ordered = order_rules(rules, measure(written(sample, "quality-sample"), rules)) if rules else []

    found = base_metrics(rows)
    failed = ((F.col("n_words") < min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct))
    chain = F.when(failed, F.lit("base"))
    for rule in ordered:
        chain = chain.when(rule.rejects(F.col("full_text"), F.col("n_words")), F.lit(rule.name))
    return found.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), chain.alias("first_failed")).select(
        "*", F.col("first_failed").isNull().alias("kept"))
