"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's probability is a logistic function of the weights of its
features (words and word beginnings); a document's score joins them by noisy-or,
``1 - prod(1 - p)``, so one bad sentence is enough. In scores, a sentence counts only by
what it has over one without known features, so that length alone is no evidence. Only document labels
train it: the gradient of the document loss reaches the sentences through the
noisy-or, and the trained sentence scores then locate the offending ones.

Training reads a bounded sample of labelled rows on the driver; scoring runs in
tasks over whole texts and takes nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsift.llm import textscan
from adsift.llm.common import text_of

PREFIX_BYTES = (4, 5, 6)
FILTER_BITS = 20
COUNT_BITS = 21
SENTENCE_END = np.zeros(256, dtype=bool)
SENTENCE_END[[ord(c) for c in ".!?\n"]] = True


def features(scan: textscan.Scan) -> np.ndarray:
    """(words, features): hashes of each word and its beginnings (0: none, the word is shorter)."""
    cols = [scan.word_hashes()]
    for k in PREFIX_BYTES:
        longer = scan.end - scan.start > k
        h = scan.hash_of(scan.start, np.minimum(scan.start + k, scan.end)) ^ np.uint64(k)
        cols.append(np.where(longer, h, np.uint64(0)))
    return np.stack(cols, axis=1) if len(scan.start) else np.zeros((0, 1 + len(PREFIX_BYTES)), np.uint64)


def sentences(scan: textscan.Scan) -> tuple[np.ndarray, np.ndarray]:
    """The sentence number of each word and the document of each sentence that has words."""
    ends = np.cumsum(SENTENCE_END[scan.raw])
    doc = scan.doc_of_word()
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = ends[scan.start]
    new = np.empty(len(doc), dtype=bool)
    new[0] = True
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return np.cumsum(new) - 1, doc[new]


class Model:
    """Sorted feature hashes with their weights, and the sentence bias."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        order = np.argsort(hashes)
        self.hashes, self.weights, self.bias = hashes[order], weights[order], bias
        self.near = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.near[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def sentence_weights(self, found: np.ndarray, sent: np.ndarray, n_sent: int) -> np.ndarray:
        """The summed weight of each sentence's distinct features, given each word's
        features and sentence; most features fail a small table first."""
        if not len(self.hashes):
            return np.zeros(n_sent)
        pairs = []
        for col in found.T:
            at = np.flatnonzero(self.near[col >> np.uint64(64 - FILTER_BITS)])
            i = np.minimum(np.searchsorted(self.hashes, col[at]), len(self.hashes) - 1)
            hit = self.hashes[i] == col[at]
            pairs.append(sent[at[hit]] * len(self.hashes) + i[hit])
        pairs = np.unique(np.concatenate(pairs))
        return np.bincount(pairs // len(self.hashes), weights=self.weights[pairs % len(self.hashes)], minlength=n_sent)


def train(texts: pa.Array, labels: np.ndarray, sentence_prior: float = 1e-5, min_z: float = 5.0,
          label_noise: float = 0.02, l1: float = 2e-4, steps: int = 300, rate: float = 0.15) -> Model:
    """Fit the sentence weights to document labels (0 or 1) by full-batch Adam.

    ``sentence_prior`` is the probability of a sentence without any known
    feature; ``label_noise`` is the share of positive labels taken to be wrong;
    a feature needs a share of positive documents ``min_z`` standard errors over chance.
    With labels of one class only, the model has no features.
    """
    bias = float(np.log(sentence_prior / (1 - sentence_prior)))
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    n_doc, chance = len(labels), labels.mean() if len(labels) else 0
    if not 0 < chance < 1:
        return empty
    body, offsets = textscan.utf8(texts)
    bucket = np.uint64(64 - COUNT_BITS)
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    for i, j in textscan.chunks(offsets):
        counts += np.bincount(features(textscan.scan(body, offsets[i:j + 1])).ravel() >> bucket, minlength=len(counts))
    # A feature of so few documents cannot be min_z standard errors over chance, even if all are positive.
    frequent = counts > min_z**2 * chance / (1 - chance)
    feats, sents, docs, n_sent = [], [], [], 0
    for i, j in textscan.chunks(offsets):
        s = textscan.scan(body, offsets[i:j + 1])
        sent, doc = sentences(s)
        f = features(s)
        keep = (f != 0) & frequent[f >> bucket]
        feats.append(f[keep])
        sents.append((np.repeat(sent, f.shape[1]).reshape(f.shape)[keep] + n_sent).astype(np.int32))
        docs.append((doc + i).astype(np.int32))
        n_sent += len(doc)
    feat, sent, doc = np.concatenate(feats), np.concatenate(sents), np.concatenate(docs)
    del feats, sents, docs
    if not len(feat):
        return empty
    known, index = np.unique(feat, return_inverse=True)
    by_doc = np.unique(index * n_doc + doc[sent])
    in_docs = np.bincount(by_doc // n_doc, minlength=len(known))
    in_toxic = np.bincount(by_doc // n_doc, weights=labels[by_doc % n_doc], minlength=len(known))
    useful = in_toxic - in_docs * chance > min_z * np.sqrt(in_docs * chance * (1 - chance))
    if not useful.any():
        return empty
    known, renumber = known[useful], np.cumsum(useful) - 1
    at = useful[index]
    pairs = np.unique(renumber[index[at]] * n_sent + sent[at])  # a feature counts once a sentence
    index, sent = pairs // n_sent, pairs % n_sent
    y = labels.astype(float)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w = np.zeros(len(known))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = bias + np.bincount(sent, weights=w[index], minlength=n_sent)
        total = np.bincount(doc, weights=np.logaddexp(0, z), minlength=n_doc)  # -log prod(1 - p)
        miss = np.exp(-total)
        slope = np.where(y > 0, -(1 - label_noise) * miss / (label_noise + (1 - label_noise) * (1 - miss)), 1.0)
        by_sentence = (share * slope)[doc] * np.exp(-np.logaddexp(0, -z))
        g = np.bincount(index, weights=by_sentence[sent], minlength=len(w))
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * rate, 0)
    kept = np.abs(w) > 0.05
    return Model(known[kept], w[kept], bias)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  sample_rows: int, sample_max_chars: int) -> DataFrame:
    """At most ``sample_rows`` labelled rows, half of them of each label, of at
    most ``sample_max_chars``: those with the smallest hash of the id. Only ids
    whose crc32 (of the id as text) modulo 5 is not 0 are eligible, and of those the ones that have such a text."""
    short = docs.filter(F.char_length(text_of(text_col)) <= sample_max_chars).select(F.col(id_col).alias("id"))
    own = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
           .filter(~held_out(F.col("id"))).join(short, "id", "left_semi"))
    picked = [own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample_rows // 2) for y in (0, 1)]
    ids = picked[0].unionByName(picked[1])  # at most sample_rows narrow rows
    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .filter(F.char_length("text") <= sample_max_chars)
            .join(F.broadcast(ids), "id").dropDuplicates(["id"]).select("id", "text", "y"))


def held_out(id_col):
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


SCORED = pa.schema([("score", pa.float64()), ("n_sentences", pa.int64()),
                    ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                                      ("score", pa.float64())])))])


def score_texts(texts: pa.Array, model: Model, sentence_threshold: float) -> pa.Table:
    parts = []
    body, offsets = textscan.utf8(texts)
    for i, j in textscan.chunks(offsets):
        s = textscan.scan(body, offsets[i:j + 1])
        sent, doc = sentences(s)
        z = model.bias + model.sentence_weights(features(s), sent, len(doc))
        # Over the prior alone: what holds no evidence adds nothing, or length would.
        over = np.maximum(0, np.logaddexp(0, z) - np.logaddexp(0, model.bias))
        total = np.bincount(doc, weights=over, minlength=s.n_docs)
        p = np.exp(-np.logaddexp(0, -z))
        bad = np.flatnonzero(p >= sentence_threshold)
        first = np.searchsorted(sent, bad, "left")
        last = np.searchsorted(sent, bad, "right") - 1
        point = np.cumsum((s.raw & 0xC0) != 0x80)
        base = np.concatenate([[0], point])[s.doc_at[doc[bad]]]
        begin = point[s.start[first]] - 1 - base if len(bad) else bad
        stop = point[s.end[last] - 1] - base if len(bad) else bad
        spans = pa.StructArray.from_arrays(
            [pa.array(begin, pa.int64()), pa.array(stop, pa.int64()), pa.array(p[bad], pa.float64())],
            names=["start", "end", "score"])
        cuts = np.searchsorted(doc[bad], np.arange(s.n_docs + 1))
        parts.append(pa.table([pa.array(-np.expm1(-total)), pa.array(np.bincount(doc, minlength=s.n_docs)),
                               pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)],
                              schema=SCORED))
    return pa.concat_tables(parts) if parts else SCORED.empty_table()


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample_rows: int = 4000, sample_max_chars: int = 20_000,
                   sentence_threshold: float = 0.5) -> DataFrame:
    """Train on ``labels`` (by ``id_col``) and score every whole text.

    ``sample_rows`` and ``sample_max_chars`` bound the labelled rows that
    reach the driver for training. Returns per row of ``docs``: ``row`` (struct
    of all its columns), ``score`` (0 to 1), ``n_sentences`` and
    ``offending`` (array of ``start``, ``end`` in code points from the first to
    the last word of a sentence, and its score) for sentences at or over the threshold.
    Null or empty text has no sentences and scores 0. Ids may be null or repeat;
    a label row with a null id or label is not used, and of labels that contradict
    each other the larger counts. Without labels of both classes every score is near 0.
    """
    sample = training_rows(docs, labels, id_col, text_col, label_col, sample_rows, sample_max_chars).orderBy("id").toArrow()
    model = train(sample["text"], sample["y"].to_numpy().astype(np.int64))
    return score_with(docs, model, text_col, sentence_threshold)


def score_with(docs: DataFrame, model: Model, text_col: str = "text", sentence_threshold: float = 0.5) -> DataFrame:
    """Score every text with a trained model. Only texts go to Python, and only scores come back."""
    @F.arrow_udf("score double, n_sentences bigint, "
                 "offending array<struct<start:bigint,end:bigint,score:double>>")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield score_texts(batch, model, sentence_threshold).to_struct_array().combine_chunks()

    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    return rows.select("row", scored(text).alias("found")).select("row", "found.score", "found.n_sentences", "found.offending")
