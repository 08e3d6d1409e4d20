"""Quality classifier by supervised subword embeddings.

A text's features are its words, its pairs of neighbouring words and its character n-grams, hashed into buckets.
Every bucket has a learned vector; a text is the average of its features' vectors, and a softmax over a linear layer gives
its label. Vectors and layer are trained together by stochastic gradient descent (numpy, on the driver, over
a bounded sample of labelled rows). For two labels the layer folds into the vectors: a text's log odds are the average of one number for
each bucket, so that scoring whole texts in the tasks is one table lookup a feature.

Words are runs between white space, as written (case and marks are evidence). A character n-gram may begin or end
with the space beside its word, never reach over it. A pair's hash is the exclusive or of its words' hashes, so that any word repeated
at once is the same pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsift.llm import textscan
from adsift.llm.toxicity import training_rows

NGRAMS = (3, 4)
BITS = 18
#: A longer text is cut at white space into pieces of so many bytes (a longer word is cut); a pair of words over a cut is not counted.
PIECE_BYTES = 1 << 20
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_STEPS = [np.uint64(int(x)) for x in np.random.Generator(np.random.PCG64(7)).integers(1, 2**62, size=max(NGRAMS)) * 2 + 1]


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


def _firsts(raw: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words' beginnings and ends; a text's edge ends a word."""
    inside = np.concatenate([[False], ~IS_SPACE[raw], [False]])
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = doc_at[(doc_at > 0) & (doc_at < len(raw))]
    begins[edge] = inside[1:-1][edge]
    ends[edge - 1] = inside[1:-1][edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def features(raw: np.ndarray, doc_at: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: the buckets of one kind of feature, and the texts (numbers within ``doc_at``) that have them."""
    if not len(raw):
        return
    start, end = _firsts(raw, doc_at)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(textscan.BYTE_VALUE[raw] * textscan.powers(len(raw)), out=sums[1:])
    words = textscan.mix((sums[end] - sums[start]) * textscan.powers(len(sums), True)[start])
    doc = np.searchsorted(doc_at, start, "right") - 1
    yield _bucket(words, bits), doc
    same = doc[1:] == doc[:-1]
    yield _bucket(textscan.mix((words[1:] ^ words[:-1])[same] + np.uint64(2)), bits), doc[1:][same]
    # Characters: the place and value of every code point, white space all alike.
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    if len(at) == len(raw):
        point = raw.astype(np.uint64)
    else:
        point = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = IS_SPACE[raw[at]]
    point[space] = 32
    owner = np.repeat(np.arange(len(doc_at) - 1), np.diff(np.searchsorted(at, doc_at)))
    for n in NGRAMS:
        count = len(at) - n + 1
        if count <= 0:
            continue
        good = owner[:count] == owner[n - 1:]
        for j in range(1, n - 1):
            good &= ~space[j:j + count]
        h = np.zeros(count, dtype=np.uint64)
        for j in range(n):
            h += point[j:j + count] * _STEPS[j]
        yield _bucket(h[good] ^ (h[good] >> np.uint64(29)) ^ np.uint64(n), bits), owner[:count][good]


def pieces(raw: np.ndarray, doc_at: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and offsets of about ``limit`` bytes, and the number of their first text. A text beyond that comes alone, in several pieces."""
    for i, j in textscan.chunks(doc_at, limit):
        low, high = doc_at[i], doc_at[j]
        if high - low <= 2 * limit:
            yield raw[low:high], doc_at[i:j + 1] - low, i
            continue
        while low < high:
            cut = min(low + limit, high)
            if cut < high:
                spaces = np.flatnonzero(IS_SPACE[raw[low:cut]])
                if len(spaces) and spaces[-1] > 0:
                    cut = low + spaces[-1]  # the space belongs to both pieces
                    yield raw[low:cut + 1], np.array([0, cut + 1 - low]), i
                    low = cut
                    continue
                while cut > low + 1 and (raw[cut] & 0xC0) == 0x80:
                    cut -= 1
            yield raw[low:cut], np.array([0, cut - low]), i
            low = cut


@dataclass
class Model:
    """``value``: for each bucket its share of the log odds of label 1; ``bias``: those of a text without features."""
    value: np.ndarray
    bias: float
    bits: int = BITS

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        raw, doc_at = textscan.utf8(texts)
        n = len(doc_at) - 1
        total, count = np.zeros(n), np.zeros(n)
        for body, at, first in pieces(raw, doc_at):
            k = len(at) - 1
            for bucket, doc in features(body, at, self.bits):
                total[first:first + k] += np.bincount(doc, weights=self.value[bucket], minlength=k)
                count[first:first + k] += np.bincount(doc, minlength=k)
        return self.bias + total / np.maximum(count, 1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return np.exp(-np.logaddexp(0, -self.log_odds(texts)))


def bags(texts: pa.Array, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares of all its features."""
    raw, doc_at = textscan.utf8(texts)
    out = []
    for i in range(len(doc_at) - 1):
        parts = [b for body, at, _ in pieces(raw, doc_at[i:i + 2]) for b, _ in features(body, at, bits)]
        ids, n = np.unique(np.concatenate(parts or [np.zeros(0, np.int64)]), return_counts=True)
        out.append((ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


def train(texts: pa.Array, labels: np.ndarray, dims: int = 8, epochs: int = 6, rate: float = 2.0, bits: int = BITS,
          seed: int = 11) -> Model:
    """Vectors and softmax layer by stochastic gradient descent, one text a step, each label with half the weight of all;
    the rate falls to 0. With labels of one class (or none) every text gets even odds."""
    y = np.asarray(labels, dtype=np.int64)
    if len(np.unique(y)) < 2:
        return Model(np.zeros(1 << bits), 0.0, bits)
    rng = np.random.Generator(np.random.PCG64(seed))
    bag = bags(texts, bits)
    vectors = (rng.random((1 << bits, dims), dtype=np.float32) - 0.5) / dims
    layer, bias = np.zeros((dims, 2), np.float32), np.zeros(2, np.float32)
    weight = 0.5 * len(y) / np.bincount(y, minlength=2)
    target = np.eye(2, dtype=np.float32)
    steps, done = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids, share = bag[i]
            own = vectors[ids]
            mean = share @ own
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            slope = (p / p.sum() - target[y[i]]) * np.float32(rate * (1 - done / steps) * weight[y[i]])
            # The gradient of a vector has its small share as a factor; the step is normed by the largest share.
            vectors[ids] -= (share / max(share.max(initial=0), 1e-12))[:, None] * (layer @ slope)[None, :] * np.float32(0.1)
            layer -= mean[:, None] * slope[None, :]
            bias -= 0.01 * slope
            done += 1
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]), bits)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = 4000, sample_max_chars: int = 20_000) -> DataFrame:
    """Train on ``labels`` (by ``id_col``) and score every whole text.

    ``sample_rows`` and ``sample_max_chars`` bound the labelled rows that reach the driver for training (half of them of each label, if there
    are so many; never of the held-out fold). Returns per row of ``docs``: ``row`` (struct of all its columns) and ``score`` (0 to 1, the
    probability of label 1). A null or empty text has no features and scores by the layer's bias alone. Ids may be null or repeat; a label
    row with a null id or label is not used, and of labels that contradict each other the larger counts. Without labels of both
    classes every score is 0.5.
    """
    sample = training_rows(docs, labels, id_col, text_col, label_col, sample_rows, sample_max_chars).orderBy("id").toArrow()
    return score_with(docs, train(sample["text"], sample["y"].to_numpy()), text_col)


def score_with(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Score every text with a trained model. Only texts go to Python, and only scores come back."""
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.scores(batch), pa.float64())

    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", scored(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))).alias("score"))

