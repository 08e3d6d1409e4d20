"""Personal data by bootstrapped contextual extraction.

Base rules find the seeds: e-mail and IP addresses, card and phone numbers.
Every seed, and every looser look-alike (a *candidate*: an
address without a full domain, a number that fails its check), is an instance of a kind and
lies in lexical patterns: the words around it. Spark scores the graph of
patterns and instances in rounds: a pattern's confidence is the share of its
instances that are believed (smoothed by its support), a candidate's is the noisy-or of
its patterns', so that newly believed candidates raise further patterns.

Believed patterns of two words (a *frame*: two words before, or one on either side) with enough seeds then search the texts. A
first scan counts what they hold, and only frames in which seeds are the rule go on; in a second scan whatever stands in such a frame is proposed as a further candidate of its kind, whether it looks like one or not. The graph
is scored again with all that the frames hold, so that a frame around many other things is no longer believed. Candidates over
the threshold are reported where they stand.

Only spans, words next to them and hashes of the values leave the scans; the frames reach the second scan as a bit table
of fixed size (an exact join follows). A pattern that very many documents share is reduced before each shuffle and joined against a
written table, so that adaptive execution can split it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from adsift.llm import textscan
from adsift.llm.common import row_key, text_of, written

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE_PHONE = re.compile(r"\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
HAS_DIGIT = re.compile(r"[0-9]")
#: Words as in ``textscan``, so that both scans see the same patterns.
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Code points looked at on either side of a span; a word that reaches over is none.
CONTEXT = 48
FRAME_BITS = 22
FRAME_BASE = np.uint64(0xD1342543DE82EF95)
#: Stripped off a proposed span.
EDGES = ".,;:!?()[]{}<>\"'`"
MAX_FILLER = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ is tried once, with the longest local part
    before it that no earlier match took."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        after = at + 1
        if start < at and (m := DOMAIN.match(text, after)):
            yield start, m.end()
            free = after = m.end()
        at = text.find("@", after)


def ips(text: str, ok) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            for m in IP.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")) == ok:
                    yield m.span()


def cards(text: str, ok) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            good = 14 <= len(digits) <= 19 and luhn(digits)
            if good if ok else (not good and 12 <= len(digits) <= 19):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start, then kind."""
    out = [(a, b, 0) for a, b in emails(text)]
    if HAS_DIGIT.search(text):
        out += [(a, b, 1) for a, b in ips(text, True)]
        out += [(a, b, 2) for a, b in cards(text, True)]
        out += [(a, b, 3) for a, b in phones(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


def loose_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Look-alikes that overlap neither a base span nor each other."""
    found = []
    at = text.find("@")
    while at >= 0:
        a = b = at
        while a > 0 and at - a < 64 and not text[a - 1].isspace() and text[a - 1] != "@":
            a -= 1
        while b + 1 < len(text) and b - at < 255 and not text[b + 1].isspace() and text[b + 1] != "@":
            b += 1
        if a < at < b:
            found.append((a, b + 1, "email"))
        at = text.find("@", at + 1)
    if HAS_DIGIT.search(text):
        found += [(a, b, "ip") for a, b in ips(text, False)]
        found += [(a, b, "card") for a, b in cards(text, False)]
        found += [(*m.span(), "phone") for m in LOOSE_PHONE.finditer(text)]
    if not found:
        return found
    edges = sorted(taken, key=lambda s: s[0])
    out, end, k, reach = [], 0, 0, 0
    for a, b, kind in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]))):
        while k < len(edges) and edges[k][0] < b:
            reach = max(reach, edges[k][1])
            k += 1
        if a >= end and a >= reach:
            out.append((a, b, kind))
            end = b
    return out


def neighbours(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """Up to two words before a span and one after it, A-Z lower-cased."""
    low, high = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    before = [m.group() for m in WORD.finditer(text, low, start) if m.start() > low or low == 0]
    after = next((m for m in WORD.finditer(text, end, high) if m.end() < high or high == len(text)), None)
    return [w.translate(LOWER) for w in before[-2:]], [after.group().translate(LOWER)] if after else []


def _word_hashes(words: list[str]) -> np.ndarray:
    return textscan.scan(*textscan.utf8(pa.array(words))).word_hashes()


def frames_of(first: np.ndarray, second: np.ndarray, form: int) -> np.ndarray:
    """Hashes of two-word frames; form 2: both words before the span, 3: one on either side."""
    return textscan.mix(first * FRAME_BASE + second + np.uint64(form))


def patterns(text: str, start: int, end: int, kind: str) -> list[tuple[str, int]]:
    """The lexical patterns of a span, its neighbouring words, each with the hash of its frame (0: a single word is none)."""
    before, after = neighbours(text, start, end)
    out = []
    frame = lambda a, b, form: int(frames_of(*_word_hashes([a, b])[:, None], form)[0].astype(np.int64))
    if before:
        out.append((f"{kind}: {before[-1]} _", 0))
        if len(before) == 2:
            out.append((f"{kind}: {before[0]} {before[1]} _", frame(*before, 2)))
        if after:
            out.append((f"{kind}: {before[-1]} _ {after[0]}", frame(before[-1], after[0], 3)))
    if after:
        out.append((f"{kind}: _ {after[0]}", 0))
    return out


def instance(text: str, start: int, end: int, kind: str) -> int:
    """A hash of the kind and the value without its separators."""
    value = "".join(c for c in text[start:end].lower() if c.isalnum() or c in "@.")
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}") - 2**63


OCCURRENCE = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
                         StructField("seed", BooleanType()), StructField("instance", LongType()),
                         StructField("patterns", ArrayType(StructType([StructField("pattern", StringType()),
                                                                       StructField("frame", LongType())])))])
CELLS = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.int64()),
                   ("patterns", pa.list_(pa.struct([("pattern", pa.string()), ("frame", pa.int64())])))])


def _cell(text: str, start: int, end: int, kind: str, seed: bool) -> dict:
    return {"kind": kind, "start": start, "end": end, "seed": seed, "instance": instance(text, start, end, kind),
            "patterns": [{"pattern": p, "frame": f} for p, f in patterns(text, start, end, kind)]}


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id, row_hash`` and its ``found`` base spans (``seed``) and candidates."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(text_of(text_col)).alias("row_hash"), text_of(text_col).alias("text"))
    out = StructType([rows.schema["id"], StructField("row_hash", LongType()), StructField("found", ArrayType(OCCURRENCE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for cell in batch.column("text"):
                text = cell.as_py()
                base = base_spans(text)
                spans = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
                found.append([_cell(text, *s) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_hash"),
                                              pa.array(found, pa.list_(CELLS))], names=out.names)
    return rows.mapInArrow(run, out)


def framed_words(s: textscan.Scan, table: np.ndarray) -> np.ndarray:
    """The words of a chunk that stand in a frame whose bit is set."""
    h, doc = s.word_hashes(), s.doc_of_word()
    if len(h) < 3:
        return np.zeros(0, dtype=np.int64)
    one = doc[2:] == doc[:-2]
    mask = np.uint64((1 << FRAME_BITS) - 1)
    hit = [np.flatnonzero(one & table[(frames_of(h[:-2], b, form) & mask).astype(np.int64)]) + place
           for b, form, place in ((h[1:-1], 2, 2), (h[2:], 3, 1))]
    return np.unique(np.concatenate(hit))


def fillers(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without white space around words, without marks at their edges, that overlap no span known by its looks."""
    base = base_spans(text)
    taken = sorted((a, b) for a, b, _ in [*base, *loose_spans(text, base)])
    out: list[tuple[int, int]] = []
    k, reach = 0, 0
    for a, b in places:
        low, high = a, b
        while low > 0 and a - low < MAX_FILLER and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and high - b < MAX_FILLER and not text[high].isspace():
            high += 1
        while low < a and text[low] in EDGES:
            low += 1
        while high > b and text[high - 1] in EDGES:
            high -= 1
        while k < len(taken) and taken[k][0] < high:
            reach = max(reach, taken[k][1])
            k += 1
        if low >= reach and (not out or out[-1][1] <= low):
            out.append((low, high))
    return out


def frame_table(framing: DataFrame) -> np.ndarray:
    """A bit for each frame of ``framing`` (``frame``): 2 ** FRAME_BITS of them, however many frames."""
    bit = F.col("frame").bitwiseAND((1 << FRAME_BITS) - 1) + 1   # Spark counts a bitmap's numbers from 1
    sets = framing.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    table = np.zeros((1 << FRAME_BITS) // 32768, dtype=object)
    for r in sets.toLocalIterator():   # 128 rows of 4 KB at most
        table[r["bucket"] - 1] = bytes(r["bits"])
    blank = bytes(4096)
    return np.unpackbits(np.frombuffer(b"".join(x or blank for x in table), dtype=np.uint8), bitorder="little").astype(bool)


def frame_counts(docs: DataFrame, framing: DataFrame, text_col: str) -> DataFrame:
    """``frame, n``: how often the texts hold a word in each frame that the table of ``framing`` lets pass (single words only, in
    frames with a word on either side). A task adds up the frames of a piece of text before it emits them."""
    table = frame_table(framing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << FRAME_BITS) - 1)
        for batch in batches:
            body, offsets = textscan.utf8(batch.column(0))
            for i, j in textscan.chunks(offsets):
                s = textscan.scan(body, offsets[i:j + 1])
                h, doc = s.word_hashes(), s.doc_of_word()
                if len(h) < 3:
                    continue
                one = doc[2:] == doc[:-2]
                both = [frames_of(h[:-2], b, form)[one] for b, form in ((h[1:-1], 2), (h[2:], 3))]
                passed, n = np.unique(np.concatenate([f[table[(f & mask).astype(np.int64)]] for f in both]), return_counts=True)
                if len(passed):
                    yield pa.RecordBatch.from_arrays([pa.array(passed.view(np.int64)), pa.array(n, pa.int64())], names=["frame", "n"])

    texts = docs.select(text_of(text_col).alias("text"))
    return texts.mapInArrow(run, "frame bigint, n bigint").groupBy("frame").agg(F.sum("n").alias("n"))


def proposals(docs: DataFrame, framing: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row with any: ``id, row_hash`` and in ``found`` what stands in a frame of ``framing``, as a candidate of each kind."""
    table = frame_table(framing)
    rows = docs.select(F.col(id_col).alias("id"), row_key(text_of(text_col)).alias("row_hash"), text_of(text_col).alias("text"))
    out = StructType([rows.schema["id"], StructField("row_hash", LongType()), StructField("found", ArrayType(OCCURRENCE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = textscan.utf8(batch.column("text"))
            which, found = [], []
            for i, j in textscan.chunks(offsets):
                s = textscan.scan(body, offsets[i:j + 1])
                hit = framed_words(s, table)
                if not len(hit):
                    continue
                point = np.concatenate([[0], np.cumsum((s.raw & 0xC0) != 0x80)])
                owner = np.searchsorted(s.first, hit, "right") - 1
                for d in np.unique(owner):
                    own, zero = hit[owner == d], point[s.doc_at[d]]
                    text = batch.column("text")[i + int(d)].as_py()
                    places = [(int(a - zero), int(b - zero)) for a, b in zip(point[s.start[own]], point[s.end[own]], strict=True)]
                    cells = [_cell(text, a, b, kind, False) for a, b in fillers(text, places) for kind in KINDS]
                    if cells:
                        which.append(i + int(d))
                        found.append(cells)
            if which:
                at = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("row_hash").take(at),
                                                  pa.array(found, pa.list_(CELLS))], names=out.names)
    return rows.mapInArrow(run, out)


def score_graph(edges: DataFrame, rounds: int, min_pattern: float, smoothing: float) -> tuple[DataFrame, DataFrame]:
    """``edges``: ``pattern, instance, seed`` (distinct, written). Returns the
    last ``pattern, confidence`` and ``instance, score`` of candidates."""
    scores = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    confidence = None
    for _ in range(rounds):
        scores = written(scores, "pii-scores")
        confidence = written(
            edges.join(scores.hint("merge"), "instance").groupBy("pattern")
            .agg((F.sum("score") / (F.count("*") + F.lit(smoothing))).alias("confidence"))
            .filter(F.col("confidence") >= min_pattern), "pii-patterns")
        believed = (edges.filter("not seed").join(confidence.hint("merge"), "pattern").groupBy("instance")
                    .agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("belief")))
        scores = scores.join(believed, "instance", "left").select(
            "instance", F.greatest("score", F.coalesce("belief", F.lit(0.0))).alias("score"))
    return confidence, scores


def _edges(each: DataFrame, name: str) -> DataFrame:
    return written(each.select(F.explode("patterns").alias("p"), "instance", "seed")
                   .groupBy("p.pattern", "p.frame", "instance").agg(F.max("seed").alias("seed")), name)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
                       min_pattern: float = 0.5, min_score: float = 0.8, smoothing: float = 2.0, min_seeds: int = 3) -> DataFrame:
    """Base and discovered spans of every whole text.

    ``rounds`` of scoring; patterns under ``min_pattern`` do not vote; ``smoothing`` is added to a
    pattern's instance count, so one seen around few instances is not trusted; a frame searches the texts if
    ``min_seeds`` different seeds (or believed candidates) stand in it.
    Returns per row of ``docs``: ``id``, ``base`` and ``spans`` (base and discovered
    ones): arrays of ``kind, start, end`` in code points, end exclusive, by start, then kind as in
    ``KINDS``. Discovered spans overlap no base span. Null text is empty; ids may be null or
    repeat (equal rows get equal results); without seeds nothing is discovered.
    """
    found = written(occurrences(docs, id_col, text_col), "pii-found")
    spans_of = lambda df: df.select("id", "row_hash", F.explode("found").alias("o")).select("id", "row_hash", "o.*")
    each = spans_of(found)
    edges = _edges(each, "pii-edges")
    confidence, scores = score_graph(edges.select("pattern", "instance", "seed"), rounds, min_pattern, smoothing)
    framing = written(
        edges.filter("frame <> 0").join(confidence.hint("merge"), "pattern").join(
            scores.filter(F.col("score") >= min_score).select("instance").hint("merge"), "instance")
        .groupBy("pattern", "frame").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= min_seeds), "pii-frames")
    if not framing.isEmpty():
        # What else stands in a frame: seeds are counted in frames of two words before, and (of several words) not in the others.
        counts = frame_counts(docs, framing, text_col).select(F.col("frame").alias("c_frame"), "n")
        other = F.coalesce("n", F.lit(0))
        held = F.when(F.col("pattern").endswith(" _"), F.greatest(other, "seeds")).otherwise(other + F.col("seeds"))
        framing = written(framing.join(counts, F.col("frame") == F.col("c_frame"), "left")
                          .filter(F.col("seeds") >= min_pattern * (held + smoothing)).select("pattern", "frame"), "pii-frames")
    if not framing.isEmpty():
        known = framing.groupBy("pattern").agg(F.first("frame").alias("known"))
        proposed = written(spans_of(proposals(docs, framing, id_col, text_col)), "pii-proposed")
        # Of what was scanned, only candidates that stand in one of the frames of their own kind.
        framed = (proposed.select("id", "row_hash", "kind", "start", "end", F.explode("patterns.pattern").alias("pattern"))
                  .join(known.hint("merge"), "pattern").select("id", "row_hash", "kind", "start", "end").distinct()
                  .select(F.col("id").alias("f_id"), F.col("row_hash").alias("f_hash"), *[F.col(c).alias(f"f_{c}") for c in ("kind", "start", "end")]))
        proposed = written(proposed.join(framed, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("row_hash") == F.col("f_hash"))
                                         & (F.col("kind") == F.col("f_kind")) & (F.col("start") == F.col("f_start"))
                                         & (F.col("end") == F.col("f_end")), "left_semi"), "pii-framed")
        each = each.unionByName(proposed)
        edges = _edges(each, "pii-edges")
        _, scores = score_graph(edges.select("pattern", "instance", "seed"), rounds, min_pattern, smoothing)
    believed = written(scores.filter(F.col("score") >= min_score).select("instance"), "pii-believed")
    added = (each.filter("not seed").join(believed.hint("merge"), "instance")
             .groupBy(F.col("id").alias("a_id"), F.col("row_hash").alias("a_hash"))
             .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")))
    joined = found.join(added, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("row_hash") == F.col("a_hash")), "left")
    base = F.transform(F.filter("found", lambda o: o["seed"]), lambda o: F.struct(o["kind"], o["start"], o["end"]))
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    every = F.array_sort(F.transform(F.concat("base", F.coalesce("added", F.array().cast(
        "array<struct<kind:string,start:bigint,end:bigint>>"))),
        lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return (joined.select("id", base.alias("base"), "added")
            .select("id", "base", F.transform(every, lambda s: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans")))
