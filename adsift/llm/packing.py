"""Packing tokenized documents into training sequences: vector bin packing.

A piece of a document has a demand vector: tokens, one segment, and
loss-bearing tokens (those a model is trained to predict). A sequence has a capacity
in each. Sequences are filled one at a time: of the pieces that fit, the one
with the largest dot product of its demand and the sequence's remaining
capacity (both as shares of the limits) goes in; when none fits, the
best one is cut to fill the gap.

Each task packs its own documents, a bounded group of tokens at a time, and
carries what is left into its next group; at its end the rest goes into
sequences whose lengths are powers of two. Nothing is shuffled, so no key can be
hot, and a lost task is simply run again with the same result: sequence ids
are made from the partition number and a counter.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from adsift.llm import textscan

#: Texts are encoded together up to about so many bytes: the more, the fewer pieces are looked up again.
ENCODE_BYTES = 4_000_000

GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
#: 1: ASCII letter; 2: ASCII punctuation other than the apostrophe; 0: all else.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[*range(ord("a"), ord("z") + 1)]] = 1
KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = 2


@functools.cache
def encoder_of(path: str) -> WordEncoder:
    """One encoder for each file and Python worker; its pieces stay known from task to task."""
    return WordEncoder(path)


class WordEncoder:
    """Token ids of texts under a tokenizer that folds case, drops white space and
    splits letters from punctuation before it merges.

    Such a tokenizer treats every run between white space, and the letters and
    the punctuation of a run, by themselves (an apostrophe may belong to what
    follows, so no cut is made at one). Each distinct piece is encoded once
    and its ids are looked up afterwards."""

    def __init__(self, path: str, cache_entries: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens become these tokens, and nothing else crosses them; pieces between hold none.
        special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = special
        self.special_of = re.compile(b"|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.tokenizer.encode_special_tokens = True
        self.encode_many = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.limit = cache_entries
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.at = np.zeros(1, dtype=np.int64)  # ids of entry i: at[i]:at[i + 1]

    def _numbers(self, runs: list[bytes]) -> np.ndarray:
        if len(self.number) > self.limit:
            self._clear()
        out = list(map(self.number.get, runs))
        missing = [i for i, n in enumerate(out) if n is None]
        if missing:
            new = [runs[i] for i in missing]
            found: list = [None] * len(new)
            tokenize, rest = self.tokenizer.model.tokenize, []
            for i, r in enumerate(new):
                if r.isalpha():  # ASCII letters only: nothing is left to normalize or split
                    found[i] = [t.id for t in tokenize(r.decode())]
                else:
                    rest.append(i)
            for i, e in zip(rest, self.encode_many([new[i].decode() for i in rest], add_special_tokens=False), strict=True):
                found[i] = e.ids
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ends = self.at[-1] + np.cumsum(lengths)
            if ends[-1] > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), ends[-1]), dtype=np.uint32)])
            self.ids[self.at[-1]:ends[-1]] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
            first = len(self.at) - 1
            self.at = np.concatenate([self.at, ends])
            for i, n in enumerate(missing, first):
                out[n] = i
                # Pieces that differ in the gap after them come up twice in a chunk; the later entry stays.
                self.number[runs[n]] = i
        return np.array(out, dtype=np.int64)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        body, offsets = textscan.utf8(texts)
        for i, j in textscan.chunks(offsets, ENCODE_BYTES):
            raw, doc_at = body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            if self.special_of is not None and self.special_of.search(memoryview(raw)):
                yield from self._encode_with_special(raw, doc_at)
            else:
                yield from self._encode_chunk(raw, doc_at)

    def _encode_with_special(self, raw: np.ndarray, doc_at: np.ndarray) -> Iterator[np.ndarray]:
        """A chunk with strings of special tokens: what lies between them is encoded like texts of its own."""
        parts, owners, tokens = [], [], []
        for d in range(len(doc_at) - 1):
            text, at = raw[doc_at[d]:doc_at[d + 1]].tobytes(), 0
            for m in self.special_of.finditer(text):
                parts.append(text[at:m.start()])
                owners.append(d)
                tokens.append([self.special[m.group()]])
                at = m.end()
            parts.append(text[at:])
            owners.append(d)
            tokens.append([])
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        own: list[np.ndarray] = []
        between = self._encode_chunk(np.frombuffer(b"".join(parts), dtype=np.uint8), cuts)
        for ids, after, d, following in zip(between, tokens, owners, [*owners[1:], None], strict=True):
            own += [ids, np.array(after, dtype=np.uint32)]
            if following != d:
                yield np.concatenate(own)
                own = []

    def _encode_chunk(self, raw: np.ndarray, doc_at: np.ndarray) -> Iterator[np.ndarray]:
        n_docs = len(doc_at) - 1
        raw = textscan.FOLD[raw]
        inside, kind = ~GAP[raw], KIND[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | (kind[1:] + kind[:-1] == 3)
        inner = doc_at[1:-1]
        inner = inner[inner < len(raw)]
        begins[inner] = inside[inner]
        start = np.flatnonzero(begins)
        if not len(start):
            yield from (np.zeros(0, np.uint32) for _ in range(n_docs))
            return
        # Cells from one run to the next (with the gap after it) tile the bytes; a document's leading
        # gap would fall to the run before, which changes no ids.
        cells = np.append(start, len(raw))
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(cells.astype(np.int64)), pa.py_buffer(raw)])
        coded = column.dictionary_encode()
        numbers = self._numbers([r.rstrip(b" \t\n\x0b\x0c\r") for r in coded.dictionary.to_pylist()])
        entry = numbers[coded.indices.to_numpy()]
        lengths = self.at[entry + 1] - self.at[entry]
        stops = np.cumsum(lengths)
        source = np.repeat(self.at[entry] - (stops - lengths), lengths) + np.arange(stops[-1])
        ids = self.ids[source]
        cuts = np.concatenate([[0], stops])[np.searchsorted(start, doc_at)]
        for d in range(n_docs):
            yield ids[cuts[d]:cuts[d + 1]]


@dataclass
class Limits:
    """The capacities of a sequence."""
    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4095


class Packer:
    """Packs pieces of (document number, ids, first position, loss-free tokens)."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.sequence = 0
        self.placed: list[tuple] = []   # (document, start, ids, sequence, offset)

    @staticmethod
    def loss(length, free):
        """Loss-bearing tokens of a piece: not its first token, which nothing
        predicts, nor its loss-free (prompt) tokens."""
        return np.maximum(0, length - np.maximum(1, free))

    def _place(self, doc, start, ids, offset) -> None:
        self.placed.append((doc, start, ids, self.sequence, offset))

    def add_long(self, doc: int, ids: np.ndarray, free: int) -> tuple[int, np.ndarray, int]:
        """Cut whole sequences off a long document; returns what is left."""
        start, lim = 0, self.limits
        while len(ids) - start >= lim.tokens:
            if self.loss(lim.tokens, free) > lim.loss_tokens:
                break
            self._place(doc, start, ids[start:start + lim.tokens], 0)
            self.sequence += 1
            start, free = start + lim.tokens, max(0, free - lim.tokens)
        return start, ids[start:], free

    def pack(self, items: list[tuple], last: bool) -> list[tuple]:
        """Fill sequences from ``items`` (document, ids, start, free). Unless
        ``last``, stops when the rest would not fill a sequence and returns it."""
        lim = self.limits
        docs = [i[0] for i in items]
        ids = [i[1] for i in items]
        start = np.array([i[2] for i in items], dtype=np.int64)
        free = np.array([i[3] for i in items], dtype=np.int64)
        length = np.array([len(i) for i in ids], dtype=np.int64)
        left = int(length.sum())
        while left > 0 and (last or left >= lim.tokens):
            goal = lim.tokens if left >= lim.tokens else 1 << (left.bit_length() - 1)
            tokens, segments, loss = goal, lim.segments, lim.loss_tokens
            while tokens and segments:
                alive = np.flatnonzero(length)
                if not len(alive):
                    break
                need, bears = length[alive], self.loss(length[alive], free[alive])
                score = (need * (tokens / lim.tokens**2) + segments / lim.segments**2
                         + bears * (loss / lim.loss_tokens**2))
                fits = (need <= tokens) & (bears <= loss)
                if fits.any():
                    best = int(np.argmax(np.where(fits, score, -1.0)))
                    take = int(need[best])
                else:
                    best = int(np.argmax(score))
                    take = int(min(need[best], tokens, loss + max(1, free[alive[best]])))
                k = int(alive[best])
                self._place(docs[k], int(start[k]), ids[k][:take], goal - tokens)
                loss -= int(self.loss(take, free[k]))
                tokens, segments, left = tokens - take, segments - 1, left - take
                start[k], length[k], ids[k], free[k] = start[k] + take, length[k] - take, ids[k][take:], max(0, free[k] - take)
            self.sequence += 1
        return [(docs[k], ids[k], int(start[k]), int(free[k])) for k in np.flatnonzero(length)]


PIECE = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64())]


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   prompt_col: str | None = None, end_id: int | None = 2, limits: Limits | None = None,
                   group_tokens: int = 1_000_000) -> DataFrame:
    """Tokenize every whole text and pack all of its ids.

    ``tokenizer_path`` names a tokenizer file (present on every node) that drops white
    space. ``end_id`` is put after each document. With ``prompt_col`` (instruction
    data) the prompt's ids come first and bear no loss. ``group_tokens`` bounds
    what a task holds at once, besides one document.

    Returns one row per piece: ``id``, ``start`` (the document's ids before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``. Every sequence keeps all limits; offsets have no gaps.
    Sequences are full (``limits.tokens``) unless the segment or loss limit closes them, but
    for at most one of each smaller power of two per task. The strings of the
    tokenizer's special tokens in a text become those tokens, as the tokenizer does it by default. Null text is empty
    and has only ``end_id``; ids may be null or repeat (each row is packed); a document
    without any id (empty, no ``end_id``) has no piece.
    """
    limits = limits or Limits()
    key = docs.select(F.col(id_col).alias("id")).schema[0]
    cols = [F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")]
    if prompt_col:
        cols.append(F.col(prompt_col).cast("string").alias("prompt"))
    out = StructType([StructField("id", key.dataType), StructField("start", LongType()), StructField("length", LongType()),
                      StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
                      StructField("sequence_id", LongType()), StructField("offset", LongType())])
    tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, packer = encoder_of(tokenizer_path), Packer(limits)
        at = TaskContext.get().partitionId() << 32
        names: dict[int, object] = {}
        sizes: dict[int, int] = {}
        items: list[tuple] = []
        waiting, number, id_type = 0, 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            done, packer.placed = packer.placed, []
            for i in range(0, len(done), 2000):
                part = done[i:i + 2000]
                columns = [pa.array([names[p[0]] for p in part], id_type),
                           pa.array([p[1] for p in part], pa.int64()), pa.array([len(p[2]) for p in part], pa.int64()),
                           pa.array([p[2].astype("<u4").tobytes() for p in part], pa.binary()),
                           pa.array([sizes[p[0]] for p in part], pa.int64()),
                           pa.array([at + p[3] for p in part], pa.int64()), pa.array([p[4] for p in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *[n for n, _ in PIECE]])
            open_docs = {i[0] for i in items}
            for d in [d for d in names if d not in open_docs]:
                del names[d], sizes[d]

        for batch in batches:
            id_type = batch.schema.field("id").type
            keys = batch.column("id").to_pylist()
            prompts = encoder.encode(batch.column("prompt")) if prompt_col else None
            for i, ids in enumerate(encoder.encode(batch.column("text"))):
                free = 0
                if prompts is not None:
                    before = next(prompts)
                    free, ids = len(before), np.concatenate([before, ids])
                ids = np.concatenate([ids, tail])
                if not len(ids):
                    continue
                names[number], sizes[number] = keys[i], len(ids)
                start, ids, free = packer.add_long(number, ids, free)
                if len(ids):
                    items.append((number, ids, start, free))
                    waiting += len(ids)
                number += 1
                if waiting >= group_tokens or len(packer.placed) >= 2000:
                    if waiting >= group_tokens:
                        items = packer.pack(items, last=False)
                        waiting = sum(len(i[1]) for i in items)
                    yield from flush()
        items = packer.pack(items, last=True)
        yield from flush()

    return docs.select(*cols).mapInArrow(run, out)
