"""Toxicity: held-out accuracy, located sentences, edge rows."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adsift.llm import toxicity
from tests.llm import cases


def corpus(n, seed=1):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "st", "rd", "l")]
    bad = ["gruntle", "snarkus", "vileno", "brokrat"]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rnd.choices(vocab, k=rnd.randint(4, 12))) for _ in range(rnd.randint(1, 30))]
        toxic = rnd.random() < 0.3
        if toxic:
            k = rnd.randrange(len(sentences))
            sentences[k] += " " + rnd.choice(bad) + rnd.choice(["", "ez", "ion"]) + " " + rnd.choice(vocab)
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_held_out_accuracy_and_sentences(spark):
    docs, labels = corpus(1500)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = toxicity.score_toxicity(d, y).select("row.*", "score", "offending", "n_sentences").join(y, "doc_id") \
        .withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r.held]
    assert len(held) > 200
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    for r in held:
        for s in r.offending:
            assert re.search("gruntle|snarkus|vileno|brokrat", r.text[s.start:s.end])
            assert "." not in r.text[s.start:s.end]
        assert r.n_sentences == r.text.count(".")


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(600, seed=2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    turned = y.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda labels: sorted((r.row.doc_id, round(r.score, 9)) for r in toxicity.score_toxicity(d, labels).collect())
    assert score(y) == score(turned)


def test_edge_rows(spark):
    df = cases.frame(spark, cases.EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 1)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(df, labels).collect()
    assert len(rows) == len(cases.EDGES)
    assert all(0 <= r.score < 0.5 for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert len(toxicity.score_toxicity(df, none).collect()) == len(cases.EDGES)
    assert toxicity.score_toxicity(cases.empty(spark), labels).collect() == []


def test_long_clean_text_stays_low(spark):
    docs, labels = corpus(800, seed=3)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    clean = " ".join(t for (_, t), (_, toxic, _) in zip(docs, labels, strict=True) if not toxic) * 3
    model_rows = d.unionByName(spark.createDataFrame([(10**6, clean)], "doc_id long, text string"))
    scores = {r.row.doc_id: r.score for r in toxicity.score_toxicity(model_rows, y).collect()}
    assert scores[10**6] < 0.5


def test_length_alone_is_no_evidence():
    bad = toxicity.features(toxicity.textscan.scan(*toxicity.textscan.utf8(pa.array(["gruntle"]))))[0, :1]
    model = toxicity.Model(bad, np.array([20.0]), float(np.log(1e-5)))
    clean = "a line of the log\n" * 120_000
    scores = toxicity.score_texts(pa.array([clean, clean + "gruntle here\n", "gruntle", "", None]), model, 0.5)
    assert scores["n_sentences"].to_pylist() == [120_000, 120_001, 1, 0, 0]
    got = scores["score"].to_pylist()
    assert got[0] == got[3] == got[4] == 0 and got[1] == got[2] > 0.99
