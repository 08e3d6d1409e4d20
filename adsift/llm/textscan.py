"""Whole-batch text scanning with numpy, for use inside Spark tasks.

Works on the UTF-8 bytes of many documents at once. A *word* is a run of
digits, letters a-z (A-Z lower-cased) and bytes from 0x80 on. Words, prefixes
and shingles get 64-bit polynomial hashes (random byte values, odd base, mixed
at the end) taken from one prefix sum, without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[ord("0"):ord("9") + 1] = True
IS_WORD[ord("a"):ord("z") + 1] = True
IS_WORD[0x80:] = True

#: Documents are scanned together up to about so many bytes; a longer one is scanned alone.
CHUNK_BYTES = 500_000

_powers = {True: np.ones(1, dtype=np.uint64), False: np.ones(1, dtype=np.uint64)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1) modulo 2 ** 64, or of its inverse."""
    if len(_powers[inverse]) < n:
        steps = np.full(n, BASE_INVERSE if inverse else BASE, dtype=np.uint64)
        steps[0] = 1
        out = np.multiply.accumulate(steps)
        if n > 8 * CHUNK_BYTES:
            return out
        _powers[inverse] = out
    return _powers[inverse][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the public splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Scan:
    """Documents ``0..n-1`` of a chunk; ``first`` has the word number at which each begins."""
    raw: np.ndarray        # bytes as given
    folded: np.ndarray     # A-Z lower-cased
    doc_at: np.ndarray     # byte offset of each document, and the end
    start: np.ndarray      # words: byte offsets
    end: np.ndarray
    first: np.ndarray      # word number of each document, and the end
    prefix_sum: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.doc_at) - 1

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges of the folded text."""
        return mix((self.prefix_sum[end] - self.prefix_sum[start]) * powers(len(self.prefix_sum), True)[start])

    def word_hashes(self) -> np.ndarray:
        return self.hash_of(self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.folded[self.start[i]:self.end[i]].tobytes()

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together (one document at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def scan(body: np.ndarray, offsets: np.ndarray) -> Scan:
    """Find the words of the documents ``offsets[i]:offsets[i + 1]``."""
    doc_at = offsets - offsets[0]
    raw = body[offsets[0]:offsets[-1]]
    folded = FOLD[raw]
    inside = IS_WORD[folded]
    # A document's first byte always begins anew.
    prev = np.empty(len(raw), dtype=bool)
    if len(raw):
        prev[0] = False
        prev[1:] = inside[:-1]
        inner = doc_at[1:-1]
        prev[inner[inner < len(raw)]] = False
        start = np.flatnonzero(inside & ~prev)
        nxt = np.empty(len(raw), dtype=bool)
        nxt[-1] = False
        nxt[:-1] = inside[1:]
        last = inner[(inner > 0) & (inner <= len(raw))] - 1
        nxt[last] = False
        end = np.flatnonzero(inside & ~nxt) + 1
    else:
        start = end = np.zeros(0, dtype=np.int64)
    prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[folded] * powers(max(1, len(raw)))[:len(raw)], out=prefix[1:])
    return Scan(raw, folded, doc_at, start, end, np.searchsorted(start, doc_at), prefix)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive word hashes (over document edges, too)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j:j + n]
    return mix(out)
