"""Quality classifier: features against a plain version, held-out accuracy, edge rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adsift.llm import quality_embedding as q
from adsift.llm import textscan
from adsift.llm.toxicity import held_out
from tests.llm import cases


def found(text, limit=None):
    """Buckets by kind (words, pairs, one list for each n-gram size)."""
    raw, at = textscan.utf8(pa.array([text]))
    kinds = [[] for _ in range(2 + len(q.NGRAMS))]
    for body, offsets, _ in q.pieces(raw, at, limit or q.PIECE_BYTES):
        for k, (bucket, doc) in enumerate(q.features(body, offsets)):
            assert (doc == 0).all()
            kinds[k] += bucket.tolist()
    return kinds


def grams(text, n):
    plain = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text)
    return [plain[i:i + n] for i in range(len(plain) - n + 1) if " " not in plain[i + 1:i + n - 1]]


TEXT = "Der Äpfel, der  Baum!\nder Äpfel, 中文 🙂 a a a b"


def test_features_against_a_plain_version():
    words = TEXT.split()
    kinds = found(TEXT)
    assert len(kinds[0]) == len(words) and len(kinds[1]) == len(words) - 1
    assert len(set(kinds[0])) == len(set(words))
    pairs = [frozenset(p) if len(set(p)) > 1 else "again" for p in zip(words, words[1:])]
    same = {}
    for a, b in zip(pairs, kinds[1], strict=True):
        assert same.setdefault(a, b) == b
    assert len(set(same.values())) == len(same)
    for kind, n in zip(kinds[2:], q.NGRAMS, strict=True):
        want, same = grams(TEXT, n), {}
        assert len(kind) == len(want)
        for a, b in zip(want, kind, strict=True):
            assert same.setdefault(a, b) == b
        assert len(set(same.values())) == len(same)


def test_texts_of_a_batch_do_not_touch():
    texts = ["ab cd", "", "cd ab", " x", "end"]
    raw, at = textscan.utf8(pa.array(texts))
    own = [[] for _ in texts]
    for bucket, doc in q.features(raw, at):
        for b, d in zip(bucket, doc, strict=True):
            own[d].append(int(b))
    assert [sorted(o) for o in own] == [sorted(sum(found(t), [])) for t in texts]


def test_long_texts_go_in_pieces():
    text = " ".join(f"wörd{i % 50}" for i in range(4000))
    whole, cut = found(text), found(text, 1000)
    assert whole[0] == cut[0] and whole[2:] == cut[2:]
    assert 0 <= len(whole[1]) - len(cut[1]) <= len(text.encode()) // 500
    assert sum(map(len, found("ü" * 100_000, 1000))) > 100_000  # one word longer than a piece


def corpus(n, seed=1):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "st", "rd", "l")]
    docs, labels = [], []
    for i in range(n):
        words, good = rnd.choices(vocab, k=rnd.randint(15, 120)), rnd.random() < 0.7
        if not good:
            kind = rnd.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + rnd.choice("#$%&") * 3 for w in words] if kind == 1 \
                else [w for w in words[:10] for _ in range(8)]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(good)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(900)
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_held_out_accuracy(tables):
    d, y = tables
    rows = (q.score_quality(d, y).select("row.doc_id", "score").join(y, "doc_id")
            .filter(held_out(F.col("doc_id"))).collect())
    assert len(rows) > 120 and all(0 <= r.score <= 1 for r in rows)
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in rows) / len(rows) > 0.98


def test_held_out_labels_are_never_read_and_runs_repeat(tables):
    d, y = tables
    turned = y.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda labels: sorted((r.row.doc_id, r.score) for r in q.score_quality(d, labels).collect())
    assert score(y) == score(turned.repartition(5))


def test_the_layer_folds_into_the_vectors():
    """The table of scalars gives the softmax of the averaged vectors."""
    rng = np.random.default_rng(2)
    vectors, layer = rng.normal(size=(1 << 8, 5)), rng.normal(size=(5, 2))
    model = q.Model(vectors @ (layer[:, 1] - layer[:, 0]), 0.25, 8)
    ids, share = q.bags(pa.array([TEXT]), 8)[0]
    z = (share @ vectors[ids]) @ layer + np.array([0, 0.25])
    assert abs(model.scores(pa.array([TEXT]))[0] - np.exp(z[1]) / np.exp(z).sum()) < 1e-6


def test_edge_rows(spark):
    df = cases.frame(spark, cases.EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 1), (11, 0)], "doc_id long, quality int")
    rows = q.score_quality(df, labels).collect()
    assert len(rows) == len(cases.EDGES) and all(0 <= r.score <= 1 for r in rows)
    empty = [r.score for r in rows if not r.row.text]
    assert len(set(empty)) == 1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.score_quality(df, none).collect()} == {0.5}
    assert q.score_quality(cases.empty(spark), labels).collect() == []
