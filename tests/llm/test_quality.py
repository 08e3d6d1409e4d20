"""Quality rules: base metrics against a brute-force version, order, verdicts."""

import re
from collections import Counter

from adsift.llm.quality import RULES, apply_quality_rules, order_rules
from tests.llm import cases


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered), failed)


def test_metrics_against_brute_force(spark):
    texts = cases.EDGES + cases.random_texts(80, seed=3) + ["a b c d e a b c d e", "x " * 30, "one two three four five six"]
    got = apply_quality_rules(cases.frame(spark, texts)).collect()
    mine = sorted((r.row.doc_id, r.row.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in got if r.row.doc_id is not None and r.row.text is not None)
    want = sorted((i, t, *brute(t)) for i, t, *_ in cases.rows(texts) if i is not None and t is not None)
    assert mine == want
    assert len(got) == len(texts)
    assert all(r.kept == (r.first_failed is None) and not (r.kept and r.base_failed) for r in got)


def test_junk_goes_and_clean_stays(spark):
    clean = "The quick brown fox jumps over the lazy dog while many people look at it from the old bridge. " \
            "Später gingen alle nach Hause, où ils ont mangé du pain."
    junk = ["word### " * 5 + " ".join(f"w{i}%%%" for i in range(30)), clean.upper(),
            " ".join(f"hey{i}!!" for i in range(30)), " ".join(str(10**9 + i) for i in range(30))]
    got = {r.row.doc_id: r.kept for r in apply_quality_rules(cases.frame(spark, [clean, *junk])).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_order_is_by_rejection_per_cost():
    a, b, c = RULES[:3]
    cost = {a.name: (2.0, 0.5), b.name: (1.0, 0.5), c.name: (0.1, 0.0)}
    assert order_rules([a, b, c], cost) == [b, a, c]


def test_empty_table_and_no_rules(spark):
    assert apply_quality_rules(cases.empty(spark)).collect() == []
    assert apply_quality_rules(cases.frame(spark, ["a b c d e f g h i j k"]), rules=[]).first().kept


def test_cost_of_a_rule_is_what_it_adds_to_reading_the_rows(spark, monkeypatch):
    from pyspark.sql import functions as F
    from adsift.llm import quality
    monkeypatch.setattr(quality, "PROBES", 4)
    df = spark.range(3000).select(F.repeat(F.lit("some words and numbers 123 "), 40).alias("full_text"), F.lit(200).alias("n_words")).cache()
    df.count()
    cheap = quality.Rule("cheap", lambda t, n: n < 0)
    dear = quality.Rule("dear", lambda t, n: F.size(F.regexp_extract_all(t, F.lit("([a-z]+) ([a-z]+)? ?[0-9]*"), F.lit(0))) < 0)
    got = quality.measure(df, [cheap, dear])
    assert got["cheap"][1] == got["dear"][1] == 0
    assert got["dear"][0] > 3 * got["cheap"][0]
    df.unpersist()
