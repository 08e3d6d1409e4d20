"""Vector code compression: product codes by slice-and-intersect bitmasks.

A vector is cut into equal parts, and each part is replaced by the index of the nearest of at most 64 codebook
entries. The nearest entry is found without comparing with all of them: along each dimension of a part the entries'
coordinates are sorted, and a prefix mask (uint64, a bit for each entry) says which entries lie before each place. A radius around the
part's own coordinate selects a range of places, so two prefix masks give the entries within it; ANDed over the dimensions
they are the exact candidates, the entries inside the box. The nearest candidate is the nearest entry if it is no
farther than the radius (an entry outside the box is farther); else the radius grows and the part is looked up again.

Codebooks are learned by a few rounds of k-means over all vectors: a task reduces its rows to a count and a sum for each entry,
Spark adds those up, and only the codebooks (parts x 64 entries) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsift.llm.common import written

MAX_ENTRIES = 64
#: Scaled components beyond this are held at it, so that squared distances of any part fit a long.
MAX_COMPONENT = 1 << 23
#: Vectors of a batch that are looked up together.
BLOCK = 4096


class Slices:
    """Sorted coordinates of one part's entries with their prefix masks."""

    def __init__(self, entries: np.ndarray):
        k, self.dims = entries.shape
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        self.prefix = np.zeros((k + 1, self.dims), dtype=np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bits, axis=0)
        gaps = [np.partition(np.abs(entries - e).max(axis=1), 1)[1] for e in entries] if k > 1 else [0]
        #: First radius: half the median distance from an entry to the next.
        self.radius = max(1, int(np.median(gaps)) // 2)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within ``radius`` of each row along every dimension."""
        mask = np.full(len(x), ~np.uint64(0))
        for d in range(self.dims):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            mask &= self.prefix[high, d] & ~self.prefix[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (ties to the lower) and squared distance of the nearest entry to each row."""
        index, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        todo = np.arange(len(x))
        radius = np.full(len(x), self.radius, dtype=np.int64)
        while len(todo):
            own, r = x[todo], radius[todo]
            at, far = self._least(own, self.candidates(own, r))
            sure = (at >= 0) & (far <= r * r)
            index[todo[sure]], best[todo[sure]] = at[sure], far[sure]
            # A candidate bounds the distance; without one, look twice as far.
            wider = np.where(at >= 0, np.ceil(np.sqrt(far.astype(np.float64))).astype(np.int64) + 1, 2 * r)
            radius[todo] = wider
            todo = todo[~sure]
        return index, best

    def _least(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of each row's candidates (-1: none), from the lowest bit up."""
        at, far = np.full(len(x), -1, np.int64), np.full(len(x), np.iinfo(np.int64).max)
        live = np.flatnonzero(mask)
        while len(live):
            m = mask[live]
            lowest = m & (~m + np.uint64(1))
            bit = np.frexp(lowest.astype(np.float64))[1] - 1
            diff = x[live] - self.entries[bit]
            dist = (diff * diff).sum(axis=1)
            closer = dist < far[live]
            at[live[closer]], far[live[closer]] = bit[closer], dist[closer]
            mask[live] = m ^ lowest
            live = live[mask[live] != 0]
        return at, far


@dataclass
class Codebooks:
    """``entries``: (parts, entries, dims) integers."""
    entries: np.ndarray

    def slices(self) -> list[Slices]:
        return [Slices(part) for part in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def scaled(vectors: DataFrame, vector_col: str, parts: int, scale: int) -> DataFrame:
    """``vectors`` with ``row`` (struct of all columns) and ``v`` (``floor(scale * x)``), for vectors
    that are complete: not null, of a positive multiple of ``parts`` components, all of them finite."""
    x = F.col(f"row.`{vector_col}`")
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    bound = float(MAX_COMPONENT)
    return (vectors.select(F.struct("*").alias("row"))
            .filter(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)
                    & F.forall(x, lambda c: F.coalesce(sound(c), F.lit(False))))
            .select("row", F.transform(x, lambda c: F.floor(F.greatest(F.lit(-bound), F.least(
                F.lit(bound), c.cast("double") * scale))).cast("bigint")).alias("v")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(column) else np.zeros((0, width), np.int64)


def first_codebooks(kept: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks | None:
    """The parts of the ``entries`` vectors with the smallest ids (nulls last; equal ids by their components)."""
    first = (kept.select(F.col(f"row.`{id_col}`").alias("id"), "v").orderBy(F.col("id").asc_nulls_last(), "v")
             .limit(entries).select("v").toArrow()["v"].combine_chunks())
    if not len(first):
        return None
    width = len(first[0])
    rows = np.array([v for v in first.to_pylist() if len(v) == width], dtype=np.int64)
    return Codebooks(np.ascontiguousarray(rows.reshape(len(rows), parts, width // parts).transpose(1, 0, 2)))


def next_codebooks(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: assign every part, then replace each entry by its parts' floored mean."""
    parts, k, dims = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, n, total = books.slices(), np.zeros((parts, k), np.int64), np.zeros((parts, k, dims), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), parts * dims)
            for b in range(0, len(x), BLOCK):
                block = x[b:b + BLOCK]
                for p in range(parts):
                    part = block[:, p * dims:(p + 1) * dims]
                    at, _ = slices[p].nearest(part)
                    n[p] += np.bincount(at, minlength=k)
                    np.add.at(total[p], at, part)
        used = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(n[n > 0], pa.int64()),
             pa.array(list(total[n > 0]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    found = (kept.select("v").mapInArrow(sums, "part int, entry int, n bigint, total array<bigint>")
             .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[
                 F.sum(F.col("total")[d].cast("decimal(38,0)")) for d in range(dims)]).alias("total"))
             .select("part", "entry", F.transform("total", lambda t: t.cast("string")).alias("total"), "n").toArrow().to_pylist())
    out = books.entries.copy()
    for r in found:  # at most parts x entries rows
        out[r["part"], r["entry"]] = [int(t) // r["n"] for t in r["total"]]
    return Codebooks(out)


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = 16, entries: int = MAX_ENTRIES, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, Codebooks | None]:
    """Learn codebooks on all vectors and encode them.

    Components become ``floor(scale * x)`` (held within 2**23 either way). Vectors that are null, hold a null or a non-finite component, or
    differ in length from the one with the smallest id (whose length must be a multiple of ``parts``) are left out. Returns the
    coded rows and the codebooks: per row ``row`` (struct of all its columns), ``code`` (0-based entries, two hex digits a part), ``error``
    (squared distances summed over parts) and ``label_error`` (``error`` summed over rows of equal ``label_col``, nulls
    together). Of equal distances the lower entry wins; an entry without parts stays as it was. Null ids
    come last, repeated rows count each. With no vector left the result is empty and the codebooks are None.
    """
    if not 0 < entries <= MAX_ENTRIES:
        raise ValueError(f"entries must be 1 to {MAX_ENTRIES}: a candidate mask has a bit for each")
    kept = scaled(vectors, vector_col, parts, scale)
    books = first_codebooks(kept, id_col, parts, entries)
    if books is None:
        empty = kept.select("row", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error"))
        return empty.limit(0), None
    dims = books.entries.shape[2]
    kept = kept.filter(F.size("v") == parts * dims)
    for _ in range(rounds):
        books = next_codebooks(kept, books)

    @F.arrow_udf("code string, error bigint")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slices = books.slices()
        digits = np.array([f"{i:02x}" for i in range(MAX_ENTRIES)])
        for batch in batches:
            x = matrix(batch, parts * dims)
            index, error = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for b in range(0, len(x), BLOCK):
                for p in range(parts):
                    index[b:b + BLOCK, p], far = slices[p].nearest(x[b:b + BLOCK, p * dims:(p + 1) * dims])
                    error[b:b + BLOCK] += far
            yield pa.StructArray.from_arrays([pa.array(["".join(digits[r]) for r in index], pa.string()),
                                              pa.array(error, pa.int64())], names=["code", "error"])

    label = F.col(f"row.`{label_col}`")
    out = written(kept.select("row", coded("v").alias("c")).select("row", "c.code", "c.error", F.xxhash64(label).alias("l1"),
                                                                   label.isNull().alias("l2"), label.alias("l3")), "vector-codes")
    sums = written(out.groupBy("l1", "l2", "l3").agg(F.try_sum("error").alias("label_error")), "vector-label-errors")
    same = sums.select(*[F.col(c).alias(f"s_{c}") for c in ("l1", "l2", "l3")], "label_error")
    joined = out.join(same, (F.col("l1") == F.col("s_l1")) & (F.col("l2") == F.col("s_l2")) & F.col("l3").eqNullSafe(F.col("s_l3")))
    return joined.select("row", "code", "error", "label_error"), books
