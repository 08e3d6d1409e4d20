"""Benchmark decontamination with SimHash windows and multi-index Hamming blocks.

Every document is read through windows of the benchmark items' own sizes (in words); for
an item longer than the document, the whole document is the one window. A
window and an item are fingerprinted alike: 128 bits, each the sign of the sum
over their shingles of a random +1 or -1. Fingerprints are cut into 8 blocks
of 16 bits; two that differ in at most 31 bits agree in some block up to 3
bits (pigeonhole), so indexing, for each item block, every value within 3
bits finds all windows within the radius. What is found is verified by the
exact similarity of the weighted (counted) word shingles.

Windows without any shingle in common with any item cannot reach a positive similarity;
a table of the items' shingles leaves them out before fingerprints are made.

The benchmark is taken in blocks of bounded size, each sent to the tasks of one
pass over all documents; nothing is shuffled and no key can be hot.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from adsift.llm import textscan
from adsift.llm.common import hash128, text_of, written

BITS, BLOCKS, RADIUS = 128, 8, 31
BLOCK_RADIUS = RADIUS // BLOCKS
SHINGLE = 5


def _flips() -> np.ndarray:
    """All 16-bit masks of at most BLOCK_RADIUS set bits."""
    masks = [sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in itertools.combinations(range(16), r)]
    return np.array(sorted(masks), dtype=np.uint16)


def signs(shingles: np.ndarray) -> np.ndarray:
    """(n, BITS) of +1 and -1: the bits of two hashes of each shingle."""
    two = np.stack([textscan.mix(shingles ^ np.uint64(1)), textscan.mix(shingles ^ np.uint64(2))], axis=1)
    return np.unpackbits(two.view(np.uint8).reshape(len(shingles), 16), axis=1).astype(np.int16) * 2 - 1


def as_blocks(sums: np.ndarray) -> np.ndarray:
    """(n, BLOCKS) of uint16: the fingerprints of summed signs."""
    return np.packbits(sums > 0, axis=1).view(np.uint16).reshape(len(sums), BLOCKS)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    return textscan.shingle_hashes(words, min(SHINGLE, size))


def similarity(a: list[bytes], b: list[bytes]) -> float:
    """Weighted Jaccard of the counted shingles of two word lists; a list of
    under SHINGLE words is one shingle."""
    def bag(w):
        k = min(SHINGLE, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / sum((x | y).values())


class ItemIndex:
    """Items of one size in words: their fingerprints and the block index."""

    def __init__(self, size: int, items: list[tuple[int, list[bytes], np.ndarray]]):
        self.size = size
        self.numbers = [i[0] for i in items]
        self.words = [i[1] for i in items]
        prints = np.concatenate([as_blocks(signs(shingles_of(i[2], size)).sum(axis=0, dtype=np.int32)[None]) for i in items])
        self.prints = prints
        flips = _flips()
        self.values, self.owners, self.present = [], [], []
        for b in range(BLOCKS):
            value = (prints[:, b][:, None] ^ flips[None, :]).ravel()
            owner = np.repeat(np.arange(len(items)), len(flips))
            order = np.argsort(value, kind="stable")
            self.values.append(value[order])
            self.owners.append(owner[order])
            present = np.zeros(1 << 16, dtype=bool)
            present[value] = True
            self.present.append(present)

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) of at most RADIUS bits."""
        pairs = []
        for b in range(BLOCKS):
            w = np.flatnonzero(self.present[b][windows[:, b]])
            lo = np.searchsorted(self.values[b], windows[w, b], "left")
            hi = np.searchsorted(self.values[b], windows[w, b], "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs.append(np.repeat(w, n) * len(self.numbers) + self.owners[b][at])
        pairs = np.unique(np.concatenate(pairs))
        w, i = pairs // len(self.numbers), pairs % len(self.numbers)
        distance = np.bitwise_count(windows[w] ^ self.prints[i]).sum(axis=1, dtype=np.int64)
        near = distance <= RADIUS
        return w[near], i[near], distance[near]


class Benchmark:
    """A block of items, ready to be searched."""

    def __init__(self, texts: list[str]):
        body, offsets = textscan.utf8(pa.array(texts, pa.string()))
        s = textscan.scan(body, offsets)
        hashes = s.word_hashes()
        by_size: dict[int, list] = {}
        self.kinds: dict[int, set] = {}  # shingle length (SHINGLE, or less for a short item): hashes
        for n in range(len(texts)):
            lo, hi = s.first[n], s.first[n + 1]
            if hi > lo:
                by_size.setdefault(int(hi - lo), []).append((n, [s.word(i) for i in range(lo, hi)], hashes[lo:hi]))
                self.kinds.setdefault(min(SHINGLE, int(hi - lo)), set()).update(shingles_of(hashes[lo:hi], int(hi - lo)).tolist())
        self.indexes = {size: ItemIndex(size, items) for size, items in sorted(by_size.items())}
        self.known = {k: np.array(sorted(v), dtype=np.uint64) for k, v in self.kinds.items()}
        self.near = {}
        for k, v in self.known.items():
            self.near[k] = np.zeros(1 << 16, dtype=bool)
            self.near[k][v >> np.uint64(48)] = True

    def shared(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """Which shingles some item has."""
        out = self.near[k][shingles >> np.uint64(48)]
        at = np.flatnonzero(out)
        i = np.minimum(np.searchsorted(self.known[k], shingles[at]), len(self.known[k]) - 1)
        out[at] = self.known[k][i] == shingles[at]
        return out

    def search(self, s: textscan.Scan, threshold: float) -> list[tuple[int, int, int, int, float, int]]:
        """(document, item, first word, words, similarity, distance) of the
        best window of each document and item at or over the threshold."""
        hashes, best = s.word_hashes(), {}
        doc_end = s.first[1:][s.doc_of_word()]
        doc_words = np.diff(s.first)
        for k in self.known:
            shingles = textscan.shingle_hashes(hashes, k)
            if not len(shingles):
                continue
            hits = np.concatenate([[0], np.cumsum(self.shared(shingles, k))])
            if not hits[-1]:
                continue
            for size, index in self.indexes.items():
                if min(SHINGLE, size) != k:
                    continue
                span = size - k + 1
                # Shorter documents are one window each; of other shingle lengths, or with too few shingles
                # for the threshold even if all are the item's, they cannot match.
                own = doc_words - k + 1
                short = np.flatnonzero((own > 0) & (own < span) & (own / span >= threshold))
                short = short[hits[s.first[short] + own[short]] > hits[s.first[short]]]
                self._verify(s, shingles, s.first[short], own[short], doc_words[short], index, threshold, best)
                if span > len(shingles):
                    continue
                first = np.arange(len(shingles) - span + 1)
                first = first[(hits[span:] > hits[:-span]) & (first + size <= doc_end[:len(first)])]
                for part in np.array_split(first, 1 + len(first) // 20_000):
                    self._verify(s, shingles, part, np.full(len(part), span), np.full(len(part), size), index, threshold, best)
        return [(d, i, *found) for (d, i), found in sorted(best.items())]

    @staticmethod
    def _verify(s, shingles, first, span, n_words, index, threshold, best) -> None:
        if not len(first):
            return
        # Windows lie close together: fingerprint only the stretch that they cover.
        used = np.zeros(len(shingles) + 1, dtype=np.int32)
        np.add.at(used, first, 1)
        np.add.at(used, first + span, -1)
        covered = np.cumsum(used[:-1]) > 0
        at = np.cumsum(covered) - 1
        sums = np.zeros((int(covered.sum()) + 1, BITS), dtype=np.int32)
        np.cumsum(signs(shingles[covered]), axis=0, out=sums[1:])
        windows = as_blocks(sums[at[first] + span] - sums[at[first]])
        for w, i, distance in zip(*index.within(windows), strict=True):
            start = int(first[w])
            doc = int(np.searchsorted(s.first, start, "right") - 1)
            key = (doc, index.numbers[i])
            if key in best and best[key][2] == 1.0:
                continue
            same = similarity([s.word(j) for j in range(start, start + int(n_words[w]))], index.words[i])
            if same >= threshold and (key not in best or same > best[key][2]):
                best[key] = (start - int(s.first[doc]), int(n_words[w]), same, int(distance))


@functools.lru_cache(maxsize=2)
def _benchmark(texts: tuple[str, ...]) -> Benchmark:
    return Benchmark(list(texts))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_items: int, block_chars: int) -> Iterator[list]:
    """The items in blocks of at most ``block_items`` rows, and of at most
    ``block_chars`` characters or one item. Rows come to the driver one partition at a time."""
    block, chars = [], 0
    for row in items.select(F.col(id_col), text_of(text_col)).sort(id_col).toLocalIterator():
        if block and (len(block) == block_items or chars + len(row[1]) > block_chars):
            yield block
            block, chars = [], 0
        block.append((row[0], row[1]))
        chars += len(row[1])
    if block:
        yield block


def _without(sent, threshold: float):
    """A function of a text column: no window of the text matches an item of the broadcast block."""
    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bench = _benchmark(sent.value)
        for batch in texts:
            keep = np.ones(len(batch), dtype=bool)
            body, offsets = textscan.utf8(batch)
            for i, j in textscan.chunks(offsets):
                for found in bench.search(textscan.scan(body, offsets[i:j + 1]), threshold):
                    keep[i + found[0]] = False
            yield pa.array(keep)
    return clean


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", threshold: float = 0.8,
                      block_items: int = 2000, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` without a window as ``find_contamination`` reports
    it; null and empty texts stay. One block of items is a filter of the rows. Of several blocks each is a pass that writes the hashes of
    the texts it finds and then gives its broadcast back, so no more than one is held however many items there are; the rows
    meet the hashes in one join."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    blocks = item_blocks(items, item_id_col, item_text_col, block_items, block_chars)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs
    if second is None:
        return rows.filter(_without(sc.broadcast(tuple(t for _, t in first)), threshold)(text)).select("row.*")
    found = None
    for block in itertools.chain([first, second], blocks):
        sent = sc.broadcast(tuple(t for _, t in block))
        hits = written(rows.filter(~_without(sent, threshold)(text)).select(*hash128(text)).distinct(), "contaminated-texts")
        sent.destroy()
        found = hits if found is None else found.unionByName(hits)
    keyed = rows.select("row", *hash128(text))
    return keyed.join(found.hint("merge"), ["h1", "h2"], "left_anti").select("row.*")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.8,
                       block_items: int = 2000, block_chars: int = 4_000_000) -> DataFrame:
    """Windows of documents that equal or nearly equal a benchmark item.

    Returns one row per (row of ``docs``, item) with a window of the item's size (or the whole
    document, if that is shorter) whose weighted 5-word shingle similarity is at least ``threshold``: ``id``, ``item_id``,
    ``row_hash``, ``start_word`` and ``n_words`` (the most similar window, the first
    of ties), ``similarity``, ``distance`` (Hamming). Items of under 5 words are one shingle; items
    without words match nothing. Null text is empty; ids may be null or repeat (each row is
    searched; equal items are each reported). No items or no documents: no rows.
    """
    spark = docs.sparkSession
    doc_type = docs.schema[id_col].dataType
    item_type = items.schema[item_id_col].dataType
    out = StructType([StructField("id", doc_type), StructField("text_hash", LongType()),
                      StructField("item", StringType() if isinstance(item_type, StringType) else LongType()),
                      StructField("start_word", LongType()), StructField("n_words", LongType()),
                      StructField("similarity", DoubleType()), StructField("distance", LongType())])
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       text_of(text_col).alias("text"))

    def matches(sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids = [i for i, _ in sent.value]
            bench = _benchmark(tuple(t for _, t in sent.value))
            for batch in batches:
                body, offsets = textscan.utf8(batch.column("text"))
                for i, j in textscan.chunks(offsets):
                    found = bench.search(textscan.scan(body, offsets[i:j + 1]), threshold)
                    if found:
                        d = pa.array([i + f[0] for f in found], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("id").take(d), batch.column("text_hash").take(d),
                             pa.array([ids[f[1]] for f in found]),
                             *[pa.array([f[c] for f in found], t) for c, t in
                               ((2, pa.int64()), (3, pa.int64()), (4, pa.float64()), (5, pa.int64()))]], names=out.names)
        return rows.mapInArrow(run, out)

    result = None
    for block in item_blocks(items, item_id_col, item_text_col, block_items, block_chars):
        # Bounded by block_items and block_chars, and given back when the block's matches are written.
        sent = spark.sparkContext.broadcast(block)
        part = written(matches(sent), "contamination")
        sent.destroy()
        result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame([], out)
    return result.select("id", F.col("item").cast(item_type).alias("item_id"), F.col("text_hash").alias("row_hash"),
                         "start_word", "n_words", "similarity", "distance")
