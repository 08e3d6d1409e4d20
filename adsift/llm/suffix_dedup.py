"""Exact substring de-duplication by a distributed sort of sampled suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts
somewhere else. Two equal strings agree in everything inside them, so it is enough to sort one
suffix for each *anchor*: the position with the smallest 16-byte hash among the first ``spread``
positions of a string. An anchor stands for an interval of string starts, about
``spread / 2`` of them, and all strings that it stands for share the suffix's first
``length - spread + 1`` bytes.

1. Prefix filter: anchors are grouped by a hash of those shared bytes, and
   only those met at two places or more go on (as prefix doubling drops suffixes whose
   prefix is already unique). Equal texts are one text with a count throughout.
2. Sorted runs: each task sorts the suffixes of its texts, joins those of equal
   context, cuts the sorted list at common splitters (from a bounded
   sample) and front-codes every part: the length of the prefix shared with the string
   before, and the rest. Splitters are shared-byte prefixes, so they never cut a stretch of
   suffixes that have these bytes in common.
3. Merge: the task of a range merges its runs with a loser tree that carries
   common-prefix lengths, so a comparison starts where the known common
   prefix ends, and yields the merged order with its prefix lengths.
4. Within a stretch, the prefix lengths and the bytes left of the anchors tell
   which strings are equal. A prefix met at more than ``local_records`` places (known
   from step 1) is not sorted but settled by Spark: one row per string, grouped by
   a 128-bit hash, so that no task ever holds an unbounded stretch.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from adsift.llm import textscan
from adsift.llm.common import text_of, written

GRAM = 16
TEXT = ["x1", "x2"]          # a text's 128-bit hash names it
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --- anchors -----------------------------------------------------------------

def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(textscan.BYTE_VALUE[raw] * textscan.powers(max(1, len(raw)))[:len(raw)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    return textscan.mix((prefix[start + size] - prefix[start]) * textscan.powers(len(prefix), True)[start])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` consecutive values (two running minima over blocks)."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def anchors(raw: np.ndarray, doc_at: np.ndarray, length: int, spread: int, prefix: np.ndarray):
    """(anchor, first start, last start) of the documents ``doc_at`` in ``raw``:
    every start of a string of ``length`` bytes lies in one interval."""
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return none, none, none
    grams = range_hash(prefix, np.arange(len(raw) - GRAM + 1), GRAM)
    # Order by 32 bits of the hash, then by position: leftmost of equal grams.
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    best = (sliding_min(ranked, spread) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(doc_at)
    valid = np.repeat(sizes >= length, sizes)
    room = np.repeat(doc_at[1:], sizes) - np.arange(len(raw))
    start = np.flatnonzero(valid & (room >= length))
    if not len(start):
        return none, none, none
    chosen = best[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return chosen[first], start[first], start[last]


def anchor_table(docs: DataFrame, id_col: str, text_col: str, length: int, spread: int) -> DataFrame:
    """Per row: ``id, x1, x2, n_bytes, sha256`` and its anchors' ``at`` and ``prefix`` hashes."""
    text = F.encode(text_of(text_col), "utf-8")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("x1"),
                       F.xxhash64(F.lit("second"), text).alias("x2"), text.alias("text"))
    out = StructType([rows.schema["id"], StructField("x1", LongType()), StructField("x2", LongType()),
                      StructField("n_bytes", LongType()), StructField("sha256", BinaryType()),
                      StructField("at", ArrayType(LongType())), StructField("prefix", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = binary_parts(batch.column("text"))
            for i, j in textscan.chunks(offsets):
                raw, doc_at = body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                sums = prefix_hashes(raw)
                at, _, _ = anchors(raw, doc_at, length, spread, sums)
                hashes = range_hash(sums, at, length - spread + 1).view(np.int64)
                cuts = pa.array(np.searchsorted(at, doc_at), pa.int32())
                local = at - np.repeat(doc_at[:-1], np.diff(np.searchsorted(at, doc_at)))
                sha = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(doc_at[:-1], doc_at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in ("id", "x1", "x2")], pa.array(np.diff(doc_at)),
                     pa.array(sha, pa.binary()), pa.ListArray.from_arrays(cuts, pa.array(local)),
                     pa.ListArray.from_arrays(cuts, pa.array(hashes))], names=out.names)
    return rows.mapInArrow(run, out)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


# --- sorted runs -------------------------------------------------------------

class Suffix:
    """An anchor's context: the bytes from it on that its strings cover, those
    before it, and its place."""
    __slots__ = ("right", "left", "x1", "x2", "at", "fewest", "settled")

    def __init__(self, right, left, x1, x2, at, fewest, settled=False):
        self.right, self.left, self.x1, self.x2, self.at = right, left, x1, x2, at
        self.fewest, self.settled = fewest, settled   # the strings start fewest..len(left) bytes before the anchor


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of ``a`` and ``b``, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def suffixes_of(text: bytes, x1: int, x2: int, wanted: np.ndarray, length: int, spread: int) -> Iterator[Suffix]:
    raw = np.frombuffer(text, dtype=np.uint8)
    at, first, last = anchors(raw, np.array([0, len(raw)]), length, spread, prefix_hashes(raw))
    keep = np.isin(at, wanted)
    for a, lo, hi in zip(at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
        yield Suffix(text[a:hi + length], text[lo:a], x1, x2, a, a - hi)


RUN = StructType([StructField("target", IntegerType()), StructField("x1", LongType()), StructField("x2", LongType()),
                  StructField("start", LongType()), StructField("stop", LongType()),
                  StructField("w1", LongType()), StructField("w2", LongType()),
                  *[StructField(c, BinaryType()) for c in ("numbers", "shared", "rest", "rests", "left")]])


def front_coded(target: int, run: list[Suffix]) -> dict:
    """One run's part for a target: strings as (bytes shared with the one before, rest)."""
    pack = zstandard.ZstdCompressor(level=1).compress
    shared = [0] + [shared_prefix(a.right, b.right, 0) for a, b in zip(run, run[1:], strict=False)]
    rests = [s.right[n:] for s, n in zip(run, shared, strict=True)]
    numbers = np.array([(s.x1, s.x2, s.at, s.fewest, s.settled, len(s.left)) for s in run], dtype=np.int64)
    return {"target": target, "numbers": pack(numbers.tobytes()), "shared": np.array(shared, dtype=np.uint32).tobytes(),
            "rest": np.array([len(r) for r in rests], dtype=np.uint32).tobytes(), "rests": pack(b"".join(rests)),
            "left": pack(b"".join(s.left for s in run))}


def decoded(row: dict) -> Iterator[tuple[Suffix, int]]:
    """The suffixes of a front-coded part, each with its shared prefix length."""
    unpack = zstandard.ZstdDecompressor().decompress
    numbers = np.frombuffer(unpack(row["numbers"]), dtype=np.int64).reshape(-1, 6).tolist()
    shared = np.frombuffer(row["shared"], dtype=np.uint32).tolist()
    sizes = np.frombuffer(row["rest"], dtype=np.uint32).tolist()
    rests, lefts = unpack(row["rests"]), unpack(row["left"])
    before, r, n = b"", 0, 0
    for (x1, x2, at, fewest, settled, n_left), k, size in zip(numbers, shared, sizes, strict=True):
        before = before[:k] + rests[r:r + size]
        yield Suffix(before, lefts[n:n + n_left], x1, x2, at, fewest, bool(settled)), k
        r, n = r + size, n + n_left


def span_row(s: Suffix, length: int, most: int | None = None, fewest: int | None = None) -> dict:
    """The bytes covered by the strings that start ``fewest`` to ``most`` before the anchor."""
    most = len(s.left) if most is None else most
    fewest = s.fewest if fewest is None else fewest
    return {"target": -1, "x1": s.x1, "x2": s.x2, "start": s.at - most, "stop": s.at - fewest + length}


def string_rows(s: Suffix, length: int) -> Iterator[dict]:
    """One row per string of a suffix that is settled by hash."""
    for a in range(s.fewest, len(s.left) + 1):
        whole = xxhash.xxh3_128_digest(s.left[len(s.left) - a:] + s.right[:length - a])
        w1, w2 = np.frombuffer(whole, dtype=np.int64).tolist()
        yield {"target": -2, "x1": s.x1, "x2": s.x2, "start": s.at - a, "stop": s.at - a + length, "w1": w1, "w2": w2}


def make_runs(texts: DataFrame, splitters: list[bytes], subs: int, length: int, spread: int, run_records: int) -> DataFrame:
    """Front-coded runs by target; with target -1 spans already settled (suffixes of equal
    context at different places of one run); with target -2 the strings of heavy prefixes.
    A range of the splitters is ``subs`` targets, by a hash of the shared prefix."""
    prefix = length - spread + 1

    def sorted_run(found: list[Suffix]) -> Iterator[dict]:
        found.sort(key=lambda s: (s.right, s.left, s.fewest))
        kept: list[Suffix] = []
        for s in found:
            if kept and kept[-1].right == s.right and kept[-1].left == s.left and kept[-1].fewest == s.fewest:
                if not kept[-1].settled:
                    yield span_row(kept[-1], length)
                    kept[-1].settled = True
                yield span_row(s, length)
            else:
                kept.append(s)
        keys = [s.right for s in kept]
        cuts = [0, *[bisect.bisect_left(keys, x) for x in splitters], len(kept)]
        for range_no, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            parts: dict[int, list[Suffix]] = {}
            for s in kept[lo:hi]:
                parts.setdefault(xxhash.xxh3_64_intdigest(s.right[:prefix]) % subs if subs > 1 else 0, []).append(s)
            for sub, part in parts.items():
                yield front_coded(range_no * subs + sub, part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("target", pa.int32()), *[(c, pa.int64()) for c in ("x1", "x2", "start", "stop", "w1", "w2")],
                            *[(c, pa.binary()) for c in ("numbers", "shared", "rest", "rests", "left")]])
        found: list[Suffix] = []
        for batch in batches:
            for x1, x2, text, wanted, heavy in zip(
                    *[batch.column(c) for c in ("x1", "x2", "text", "wanted", "heavy")], strict=True):
                place = (text.as_py(), x1.as_py(), x2.as_py())
                found.extend(suffixes_of(*place, wanted.values.to_numpy(), length, spread))
                if len(heavy):
                    for s in suffixes_of(*place, heavy.values.to_numpy(), length, spread):
                        yield pa.RecordBatch.from_pylist(list(string_rows(s, length)), schema=schema)
                if len(found) >= run_records:
                    yield pa.RecordBatch.from_pylist(list(sorted_run(found)), schema=schema)
                    found = []
        if found:
            yield pa.RecordBatch.from_pylist(list(sorted_run(found)), schema=schema)
    return texts.select(*TEXT, "text", "wanted", "heavy").mapInArrow(run, RUN)


def pick_splitters(texts: DataFrame, total: int, ranges: int, length: int, spread: int, per_range: int = 20) -> list[bytes]:
    """Shared-byte prefixes that cut the sorted suffixes into at most ``ranges`` parts, from a
    sample of about ``per_range`` prefixes for each: bounded by these two, however large the corpus."""
    share = min(1.0, ranges * per_range / max(1, total))
    limit, prefix = int(share * 2**32), length - spread + 1
    if ranges == 1:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for x1, text, wanted in zip(*[batch.column(c) for c in ("x1", "text", "wanted")], strict=True):
                at = wanted.values.to_numpy()
                mixed = textscan.mix(at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(x1.as_py() & 2**64 - 1))
                at = at[(mixed >> np.uint64(32)) < limit]
                if len(at):
                    body = text.as_py()
                    keys += [body[a:a + prefix] for a in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])
    sample = texts.select("x1", "text", "wanted").mapInArrow(run, "key binary").toArrow()
    keys = sorted(sample["key"].to_pylist())
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


# --- merge -------------------------------------------------------------------

def loser_tree(runs: list[Iterator[tuple[Suffix, int]]]) -> Iterator[tuple[Suffix, int]]:
    """Merge sorted runs of (suffix, prefix shared with the run's one before) into
    one such run.

    ``known[r]`` is the prefix length that run r's head shares with the last
    string put out. Of two heads, the one that shares more is the smaller, without
    any comparison of bytes; if both share the same, bytes are compared from there on, and the
    loser remembers what it shares with the winner."""
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[Suffix | None] = [None] * size
    known = [0] * size
    for r, run in enumerate(runs):
        first = next(run, None)
        heads[r] = first[0] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        p, q, k = x.right, y.right, known[a]
        n = shared_prefix(p, q, k)
        if n == len(p) or (n < len(q) and p[n] < q[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * size
    winners = [0] * (2 * size)
    winners[size:] = range(size)
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if size > 1 else 0
    common = 0
    while heads[top] is not None:
        yield heads[top], common
        following = next(runs[top], None)
        heads[top], known[top] = following if following else (None, 0)
        node = (top + size) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
        common = known[top]


def settle(group: list[Suffix], shared: list[int], length: int, spread: int) -> Iterator[dict]:
    """The spans of suffixes whose strings equal others', in merged order; several
    stretches at once (``shared`` under the stretch prefix begins one)."""
    n = len(group)
    common = np.array(shared)
    most = np.array([len(s.left) for s in group])
    fewest = np.array([s.fewest for s in group])
    left = np.zeros((spread, n), dtype=np.uint64)      # left[a]: the byte a + 1 before the anchor
    for i, s in enumerate(group):
        left[:len(s.left), i] = np.frombuffer(s.left[::-1], dtype=np.uint8)
    top, low = np.full(n, -1), np.full(n, length)
    hashed = np.zeros(n, dtype=np.uint64)
    for a in range(spread):
        if a:
            hashed = textscan.mix(hashed * textscan.BASE + textscan.BYTE_VALUE[left[a - 1].astype(np.int64)])
        who = np.flatnonzero((fewest <= a) & (a <= most))
        if len(who) < 2:
            continue
        stretch = np.cumsum(common < length - a)[who].astype(np.uint64)
        same = textscan.mix(hashed[who] ^ (stretch * textscan.BASE))
        _, number, count = np.unique(same, return_inverse=True, return_counts=True)
        again = who[count[number] > 1]
        top[again] = a
        low[again] = np.minimum(low[again], a)
    for i in np.flatnonzero(top >= 0).tolist():
        if not group[i].settled:
            yield span_row(group[i], length, int(top[i]), int(low[i]))


FOUND = StructType([StructField(c, LongType()) for c in ("x1", "x2", "start", "stop")])


def merge_runs(runs: DataFrame, length: int, spread: int, local_records: int) -> DataFrame:
    """Spans found by merging the runs of each target (rows sorted by it)."""
    prefix = length - spread + 1
    schema = pa.schema([(c, pa.int64()) for c in FOUND.names])

    def merged(parts: list[dict]) -> Iterator[dict]:
        ready: list[tuple[Suffix, int]] = []     # whole stretches of two suffixes or more
        stretch: list[tuple[Suffix, int]] = []

        def flush() -> Iterator[dict]:
            if ready:
                yield from settle([s for s, _ in ready], [k for _, k in ready], length, spread)
            ready.clear()

        for s, k in loser_tree([decoded(p) for p in parts]):
            if stretch and k < prefix:
                if len(stretch) > 1:
                    ready.extend(stretch)
                stretch = []
                if len(ready) >= local_records:
                    yield from flush()
            stretch.append((s, k if stretch else 0))
        if len(stretch) > 1:
            ready.extend(stretch)
        yield from flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts_by_target():
            target, parts = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    if row["target"] != target:
                        if parts:
                            yield parts
                        target, parts = row["target"], []
                    parts.append(row)
            if parts:
                yield parts

        out = []
        for parts in parts_by_target():
            for row in merged(parts):
                out.append(row)
                if len(out) == 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return runs.mapInArrow(run, FOUND)


# --- the operator ------------------------------------------------------------

CUT = StructType([StructField("x1", LongType()), StructField("x2", LongType()),
                  StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())]))),
                  StructField("kept_sha256", BinaryType())])


def cut_texts(texts: DataFrame) -> DataFrame:
    """``x1, x2, text, found`` (sorted spans) -> maximal spans and the hash of the remaining bytes."""
    schema = pa.schema([("x1", pa.int64()), ("x2", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                        ("kept_sha256", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                spans, kept, at = [], hashlib.sha256(), 0
                for s in row["found"]:
                    if spans and s["start"] <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], s["stop"])
                    else:
                        spans.append(dict(s))
                for s in spans:
                    kept.update(row["text"][at:s["start"]])
                    at = s["stop"]
                kept.update(row["text"][at:])
                rows.append({"x1": row["x1"], "x2": row["x2"], "spans": spans, "kept_sha256": kept.digest()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return texts.select(*TEXT, "text", "found").mapInArrow(run, CUT)


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                        spread: int = 200, run_records: int = 20_000, target_records: int = 60_000,
                        local_records: int = 16_384, max_ranges: int = 2000) -> DataFrame:
    """All bytes covered by strings of ``length`` bytes that occur twice.

    Texts are judged as UTF-8 bytes, each on its own (no string crosses
    documents); null is empty. Occurrences may overlap and may lie in one document; every
    occurrence is reported, the first included. Returns one row per row of
    ``docs``: ``id``, ``n_bytes``, ``spans`` (array of maximal runs ``start, stop`` in bytes),
    ``n_removed`` and ``kept_sha256`` (lowercase hex of the bytes outside the spans, joined).
    Ids may be null or repeat: equal rows are copies of each other. Texts
    shorter than ``length`` have no spans. ``run_records``, ``target_records`` and
    ``local_records`` bound what a task holds at once, ``max_ranges`` the
    splitters and their sample on the driver; none changes the result.
    Needs ``length >= spread + 16``.
    """
    signed = written(anchor_table(docs, id_col, text_col, length, spread), "suffix-rows")
    texts = written(signed.groupBy(*TEXT).agg(
        F.min("id").alias("id"), F.count("*").alias("n_rows"), F.first("n_bytes").alias("n_bytes"),
        F.first("sha256").alias("sha256"), F.first(F.struct("at", "prefix")).alias("anchors")), "suffix-texts")

    places = texts.select(*TEXT, F.explode(F.arrays_zip("anchors.at", "anchors.prefix")).alias("p")) \
        .select(*TEXT, "p.at", "p.prefix")
    place = F.xxhash64("x1", "x2", "at")
    twice = written(places.groupBy("prefix").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n"))
                    .filter("a != b").select("prefix", (F.col("n") > local_records).alias("heavy")), "suffix-prefixes")
    at = lambda cond: F.collect_list(F.when(cond, F.col("at")))
    wanted = (places.join(twice.hint("merge"), "prefix").groupBy(*TEXT)
              .agg(at(~F.col("heavy")).alias("wanted"), at(F.col("heavy")).alias("heavy"))
              .join(texts.select(*TEXT, "id"), TEXT))
    raw = F.encode(text_of(text_col), "utf-8")
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(raw).alias("y1"),
                       F.xxhash64(F.lit("second"), raw).alias("y2"), raw.alias("text"))
    # One row of each text: the id spreads a text that very many rows hold.
    affected = written(
        rows.join(wanted, (F.col("y1") == F.col("x1")) & (F.col("y2") == F.col("x2"))
                  & F.col("row_id").eqNullSafe(F.col("id")))
        .select(*TEXT, "text", "wanted", "heavy").dropDuplicates(TEXT), "suffix-affected")

    total = affected.agg(F.sum(F.size("wanted"))).first()[0] or 0
    targets = max(1, -(-total // target_records), min(200, total // 2000))
    ranges = min(targets, max_ranges)
    subs = -(-targets // ranges)
    splitters = pick_splitters(affected, total, ranges, length, spread)
    runs = written(make_runs(affected, splitters, subs, length, spread, run_records), "suffix-runs")
    # By range, so that no two targets meet in one task while another task has none.
    ordered = (runs.filter("target >= 0").repartitionByRange((len(splitters) + 1) * subs, "target")
               .sortWithinPartitions("target"))
    merged = merge_runs(ordered, length, spread, local_records)

    strings = runs.filter("target = -2")
    place = F.xxhash64("x1", "x2", "start")
    equal = written(strings.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                    .filter("a != b").select("w1", "w2"), "suffix-strings")
    columns = [*TEXT, "start", "stop"]
    spans = (runs.filter("target = -1").select(*columns).unionByName(merged.select(*columns))
             .unionByName(strings.join(equal.hint("merge"), ["w1", "w2"]).select(*columns)))
    found = spans.groupBy(*TEXT).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("found"))
    cut = written(cut_texts(affected.select(*TEXT, "text").join(found, TEXT)), "suffix-cut")

    whole = (F.col("n_rows") > 1) & (F.col("n_bytes") >= length)
    none = F.array().cast(CUT["spans"].dataType)
    per_text = written(texts.select(*TEXT, "n_rows", "n_bytes", "sha256").join(cut, TEXT, "left").select(
        *TEXT, F.when(whole, F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop"))))
        .otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.lit(EMPTY_SHA256)).otherwise(F.lower(F.hex(F.coalesce("kept_sha256", "sha256")))).alias("kept_sha256")),
        "suffix-results")
    out = signed.select("id", *TEXT, "n_bytes").join(per_text.hint("merge"), TEXT)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["stop"] - s["start"])
    return out.select("id", "n_bytes", "spans", removed.alias("n_removed"), "kept_sha256")


def remove_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The remaining bytes of each document as ``id, kept`` (binary: a cut may
    lie within a character), for ids that are unique."""
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text_of(text_col), "utf-8").alias("bytes"))
    both = rows.join(found.select("id", "spans"), "id").select("id", "bytes", "spans", F.octet_length("bytes").alias("n"))
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["stop"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.col("n").cast("bigint")))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")),
                         lambda p: F.substr("bytes", (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    return both.select("id", F.aggregate(pieces, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p)).alias("kept"))
