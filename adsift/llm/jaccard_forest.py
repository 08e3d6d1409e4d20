"""Near-duplicate documents: a MinHash LSH forest, then exact verification.

A document is its set of 5-word shingles. Equal sets are joined into one first.
Each of ``trees`` prefix tries holds every set under a signature of ``max_depth`` MinHash values. Two sets are candidates in a
trie if they share a prefix there, and how long a prefix must be is settled node by node: a set stands at its whole signature first, and
its prefix is shortened value by value as long as no more than ``crowd`` sets share the shorter one. At worst a set
finds a partner just at the threshold s with probability ``1 - prod(1 - s**length)`` over its tries; a set that its crowded nodes leave
under ``target_recall`` has prefixes shortened there, too, the least crowded ones first, until it is reached. (A
node that one set shortens is shortened for all its sets, so that both sets of a pair see the same.) No prefix is shorter than a
pair at the threshold needs with every trie alike.

A trie node may hold any number of sets, so no pairs are listed. Its sets are
tied to its smallest set (a star), the stars' connected components are the
candidate groups, and inside a group all similarities are computed exactly
by products of incidence matrices, a block of sets against a block at a time. A task
holds two blocks, bounded in sets and in bytes; it returns, per set, the number of its verified links and
one edge to the component it found. The verified edges' components are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from adsift.llm import textscan
from adsift.llm.common import text_of, written
from adsift.llm.graph import components

SHINGLE = 5
_rng = np.random.Generator(np.random.PCG64(7))
MULTIPLIERS = _rng.integers(1, 2**31, size=4096, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
OFFSETS = _rng.integers(0, 2**32, size=4096, dtype=np.uint32)


def expected_recall(similarity: float, trees: int, depth: int) -> float:
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """The shortest prefix ever needed: the longest that, in every trie, finds a pair at the threshold often enough."""
    depth = max_depth
    while depth > 1 and expected_recall(threshold, trees, depth) < target:
        depth -= 1
    return depth


def document_shingles(s: textscan.Scan, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) pairs, distinct and sorted; a document of fewer
    than ``size`` words has one shingle of all of them."""
    words, n = s.word_hashes(), np.diff(s.first)
    hashes = textscan.shingle_hashes(words, size)
    doc = s.doc_of_word()[:len(hashes)]
    inside = np.arange(len(hashes)) + size <= s.first[1:][doc]
    doc, hashes = doc[inside], hashes[inside]
    for d in np.flatnonzero((n > 0) & (n < size)):
        own = textscan.shingle_hashes(words[s.first[d]:s.first[d + 1]], int(n[d]))
        doc, hashes = np.append(doc, d), np.append(hashes, own)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


#: Values of a signature: 16 bits each, four to a long, so that prefixes are leading bits.
VALUE_BITS, PER_LONG = 16, 4


def signatures(doc: np.ndarray, hashes: np.ndarray, trees: int, depth: int):
    """For documents with shingles: their numbers, set identity (two 64-bit sums over the set), number of shingles, and
    (documents, trees, longs) signatures of ``depth`` values, in order from the highest bits on."""
    longs = -(-depth // PER_LONG)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    if not len(first):
        return first, first.astype(np.uint64), first.astype(np.uint64), first, np.zeros((0, trees, longs), np.uint64)
    a = np.add.reduceat(textscan.mix(hashes ^ np.uint64(11)), first)
    b = np.add.reduceat(textscan.mix(hashes ^ np.uint64(13)), first)
    small = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    labels = np.zeros((len(first), trees, longs), dtype=np.uint64)
    for t in range(trees):
        for d in range(depth):
            k = t * depth + d
            low = np.minimum.reduceat(small * MULTIPLIERS[k] + OFFSETS[k], first).astype(np.uint64)
            at = np.uint64(VALUE_BITS * (PER_LONG - 1 - d % PER_LONG))
            labels[:, t, d // PER_LONG] |= (textscan.mix(low + np.uint64(1)) & np.uint64(0xFFFF)) << at
    return doc[first], a, b, np.diff(np.append(first, len(doc))), labels


def signed_rows(docs: DataFrame, id_col: str, text_col: str, trees: int, depth: int) -> DataFrame:
    """``id, row_hash, a, b, size, labels`` per row; all but the first two are null without words."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("row_hash"),
                       text_of(text_col).alias("text")).filter(F.col("id").isNotNull())
    out = StructType([rows.schema["id"], StructField("row_hash", LongType()), StructField("a", LongType()),
                      StructField("b", LongType()), StructField("size", LongType()), StructField("labels", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = textscan.utf8(batch.column("text"))
            for i, j in textscan.chunks(offsets):
                s = textscan.scan(body, offsets[i:j + 1])
                own, a, b, size, labels = signatures(*document_shingles(s, SHINGLE), trees, depth)
                at = np.full(j - i, -1)
                at[own] = np.arange(len(own))
                pick = pa.array(at, pa.int64(), mask=at < 0)
                cells = pa.FixedSizeListArray.from_arrays(pa.array(labels.ravel().view(np.int64)), labels[0].size if len(own) else 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), batch.column("row_hash").slice(i, j - i),
                     pa.array(a.view(np.int64)).take(pick), pa.array(b.view(np.int64)).take(pick), pa.array(size, pa.int64()).take(pick),
                     cells.cast(pa.list_(pa.int64())).take(pick)], names=out.names)
    return rows.mapInArrow(run, out)


def trie_rows(sets: DataFrame, trees: int, depth: int) -> DataFrame:
    """``sid, tree`` and the signature there, ``v0, v1, ...``."""
    longs = -(-depth // PER_LONG)
    return sets.select("sid", F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), *[F.get("labels", t * longs + i).alias(f"v{i}") for i in range(longs)]))).alias("at")).select("sid", "at.*")


def prefix(depth: int, length: int) -> list[Column]:
    """The first ``length`` of ``depth`` values of a signature, as columns ``p0, p1, ...``."""
    out = []
    for i in range(-(-depth // PER_LONG)):
        cut = VALUE_BITS * max(0, min(PER_LONG, (i + 1) * PER_LONG - length))
        v = F.col(f"v{i}") if not cut else F.shiftrightunsigned(f"v{i}", cut) if cut < 64 else F.lit(0).cast("bigint")
        out.append(v.alias(f"p{i}"))
    return out


def candidate_groups(sets: DataFrame, threshold: float, trees: int, max_depth: int, target_recall: float, crowd: int) -> DataFrame:
    """``sid, component`` of the sets that share a settled prefix with another."""
    shortest = prefix_depth(threshold, trees, max_depth, target_recall)
    at, keys = trie_rows(sets, trees, max_depth), ["tree", *[f"p{i}" for i in range(-(-max_depth // PER_LONG))]]

    def nodes(rows: DataFrame, length: int) -> DataFrame:
        """The tries' nodes at a prefix length, with their smallest set and number of sets."""
        return rows.select("sid", "tree", *prefix(max_depth, length)).groupBy(*keys).agg(
            F.min("sid").alias("hub"), F.count("*").alias("n"))

    def below(rows: DataFrame, length: int, found: DataFrame) -> DataFrame:
        return rows.select(*rows.columns, *prefix(max_depth, length)).join(found.hint("merge"), keys)

    edge = lambda df: df.filter("sid != hub").select(F.col("sid").alias("u"), F.col("hub").alias("v"))
    shared = written(nodes(at, shortest).filter("n > 1"), "forest-nodes")
    stars = edge(below(at, shortest, shared.filter(F.col("n") <= crowd)))
    crowded = shared.filter(F.col("n") > crowd)
    if not crowded.isEmpty():
        # From here on only sets in crowded nodes. Of their longer prefixes, the shortest that few sets share holds.
        base = [F.col(k).alias(f"b_{k}") for k in keys if k != "tree"]
        rest = written(below(at, shortest, crowded).select(
            "sid", "tree", *[c for c in at.columns if c[0] == "v"], *base, F.col("hub").alias("b_hub"), F.col("n").alias("b_n")), "forest-crowded")
        columns, settled = rest.columns, []
        for length in range(shortest + 1, max_depth + 1):
            # The nodes are written first: with an exchange on both sides the join on a hot one can be split.
            sized = written(below(rest, length, written(nodes(rest, length), "forest-longer-nodes")), "forest-longer")
            few = F.col("n") <= crowd if length < max_depth else F.lit(True)
            settled.append(sized.filter(few).select(*columns, "hub", F.lit(length).alias("length")))
            rest = sized.filter(~few).select(*columns)
        kept = settled[0]
        for more in settled[1:]:
            kept = kept.unionByName(more)
        miss = {n: math.log(1 - threshold**n) for n in range(shortest, max_depth + 1)}
        allowed = math.log(1 - target_recall) - trees * miss[shortest]
        loss = F.coalesce(*[F.when(F.col("length") == n, F.lit(miss[n] - miss[shortest])) for n in miss])
        most = Window.partitionBy("sid").orderBy(F.desc("b_n"), "tree").rowsBetween(Window.unboundedPreceding, 0)
        kept = written(kept.withColumn("lost", F.sum(loss).over(most)) if max_depth > shortest else kept.withColumn("lost", F.lit(0.0)), "forest-kept")
        node = ["tree", *[f"b_{k}" for k in keys if k != "tree"]]
        reopened = written(kept.filter(F.col("lost") > allowed).select(*node).distinct(), "forest-reopened")
        stars = (stars.unionByName(edge(kept.join(reopened.hint("merge"), node, "left_anti")))
                 .unionByName(edge(kept.drop("hub").withColumnRenamed("b_hub", "hub").join(reopened.hint("merge"), node, "left_semi"))))
    return components(stars.distinct()).select(F.col("node").alias("sid"), "component")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """Adds ``shingles`` (sorted 64-bit hashes as bytes) in place of ``text``."""
    kept = [f for f in texts.schema.fields if f.name != "text"]
    out = StructType([*kept, StructField("shingles", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = textscan.utf8(batch.column("text"))
            for i, j in textscan.chunks(offsets):
                doc, hashes = document_shingles(textscan.scan(body, offsets[i:j + 1]), SHINGLE)
                cuts = np.searchsorted(doc, np.arange(j - i + 1)) * 8
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), j - i, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(hashes.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name).slice(i, j - i) for f in kept], packed.cast(pa.binary())], names=out.names)
    return texts.mapInArrow(run, out)


def linked(sets: list[np.ndarray], n_left: int, ratio: Fraction, columns: int = 2048) -> np.ndarray:
    """The Boolean matrix of pairs at or over the threshold: among all sets
    (``n_left`` = all), or of the first ``n_left`` against the rest."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1  # a shingle of one set alone adds to no intersection
    owner, number = owner[shared], np.cumsum(np.diff(number[shared], prepend=-1) > 0) - 1
    whole = n_left == len(sets)
    right = slice(0, None) if whole else slice(n_left, None)
    common = np.zeros((n_left, len(sets) if whole else len(sets) - n_left), dtype=np.float32)
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        lo, hi = np.searchsorted(number, [c, c + columns])
        cells = np.zeros((len(sets), min(columns, int(number[-1]) + 1 - c)), dtype=np.float32)
        cells[owner[lo:hi], number[lo:hi] - c] = 1
        common += cells[:n_left] @ cells[right].T
    both = sizes[:n_left, None] + sizes[right][None, :]
    # |x & y| / |x | y| >= p / q, in whole numbers
    out = common.astype(np.int64) * (ratio.numerator + ratio.denominator) >= ratio.numerator * both
    if whole:
        np.fill_diagonal(out, False)
    return out


def group_roots(links: np.ndarray, square: bool) -> np.ndarray:
    """For each set (rows, then columns unless ``square``) the first set of its component."""
    n, m = links.shape
    total = n if square else n + m
    root = np.full(total, -1)
    for k in range(n):
        if root[k] >= 0:
            continue
        rows, seen = np.array([k]), np.zeros(m, dtype=bool)
        root[k] = k
        while len(rows):
            cols = links[rows].any(axis=0) & ~seen
            seen |= cols
            if square:
                rows = np.flatnonzero(cols & (root < 0))
            else:
                root[n + np.flatnonzero(cols)] = k
                rows = np.flatnonzero(links[:, cols].any(axis=1) & (root[:n] < 0))
            root[rows] = k
    root[root < 0] = np.flatnonzero(root < 0)
    return root


VERIFIED = StructType([StructField("sid", LongType()), StructField("n_links", LongType()), StructField("root", LongType())])


def verify(members: DataFrame, threshold: float) -> DataFrame:
    """``members``: ``component, left, right, block, sid, shingles``, sorted by
    the first three within partitions. One row per member and block pair."""
    ratio = Fraction(str(threshold))

    def whole(key: tuple, blocks: list) -> bool:
        """Two sets at least, and of a pair of blocks a set of either (a block may have got none)."""
        return len(blocks) > 1 and (key[1] == key[2] or min(blocks) != max(blocks))

    def finish(sids: list, blocks: list, sets: list) -> pa.RecordBatch:
        order = np.argsort(np.array(blocks), kind="stable")
        sid = np.array(sids, dtype=np.int64)[order]
        own = [np.frombuffer(sets[i], dtype=np.uint64) for i in order]
        ordered = np.array(blocks)[order]
        n_left = int((ordered == ordered[0]).sum())
        links = linked(own, n_left, ratio)
        square = n_left == len(own)
        counts = links.sum(axis=1) if square else np.concatenate([links.sum(axis=1), links.sum(axis=0)])
        return pa.RecordBatch.from_arrays(
            [pa.array(sid), pa.array(counts.astype(np.int64)), pa.array(sid[group_roots(links, square)])],
            names=VERIFIED.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sids, blocks, sets = None, [], [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("component", "left", "right", "block", "sid")]
            shingles = batch.column("shingles")
            for i, (component, left, right, block, sid) in enumerate(zip(*cols, strict=True)):
                if (component, left, right) != key:
                    if key and whole(key, blocks):
                        yield finish(sids, blocks, sets)
                    key, sids, blocks, sets = (component, left, right), [], [], []
                sids.append(sid)
                blocks.append(block)
                sets.append(shingles[i].as_py())
        if key and whole(key, blocks):
            yield finish(sids, blocks, sets)
    return members.mapInArrow(run, VERIFIED)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    trees: int = 24, max_depth: int = 8, target_recall: float = 0.9995, crowd: int = 256,
                    block: int = 256, block_bytes: int = 32_000_000) -> DataFrame:
    """Classes of documents linked by a shingle Jaccard similarity of at least ``threshold``.

    Returns per row of ``docs``: ``id``, ``row_hash``, ``class_id`` (the smallest id
    of its class), ``is_first`` (the row of the smallest id, then hash, of its class), ``n_links`` (other distinct shingle sets that its own is linked
    to) and ``n_copies`` (distinct documents with the same set, itself included). A document of
    under 5 words has one shingle of all its words; one without words is alone.
    Rows with a null id are left out; repeated rows (same id and text) each get the
    same result. ``block`` and ``block_bytes`` (of shingles) bound what a verifying task holds, besides two sets: a group of n sets costs
    (n / block) ** 2 / 2 tasks, so every link is counted however large the group.
    """
    signed = written(signed_rows(docs, id_col, text_col, trees, max_depth), "forest-rows")
    sets = (signed.filter(F.col("a").isNotNull()).groupBy("a", "b")
            .agg(F.min(F.struct("id", "row_hash")).alias("first"), F.first("labels").alias("labels"), F.first("size").alias("size"),
                 F.count_distinct("id", "row_hash").alias("n_copies")))
    sets = written(sets.select("a", "b", "first", "labels", "size", "n_copies", F.monotonically_increasing_id().alias("sid")), "forest-sets")

    groups = written(candidate_groups(sets.select("sid", "labels"), threshold, trees, max_depth, target_recall, crowd), "forest-groups")
    # Number the sets of a group within each of its hash buckets, then cut it into blocks.
    sized = groups.join(sets.select("sid", "size"), "sid").groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("size") * 8 / block_bytes)).cast("int")
    plan = written(groups.join(sized.withColumn("blocks", blocks), "component")
                   .select("sid", "component", "blocks", F.expr("cast(pmod(xxhash64(sid), blocks) as int)").alias("block")),
                   "forest-plan")
    wanted = plan.join(sets.select("sid", "first.id", "first.row_hash"), "sid")
    texts = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("row_hash"), text_of(text_col).alias("text"))
             .join(wanted, ["id", "row_hash"]).select("sid", "component", "blocks", "block", "text"))
    found = written(shingle_sets(texts).dropDuplicates(["sid"]), "forest-shingles")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("block", o).alias("left"), F.greatest("block", o).alias("right")))
    members = (found.select("component", "block", "sid", "shingles", F.explode(others).alias("pair"))
               .select("component", "pair.left", "pair.right", "block", "sid", "shingles")
               .repartition("component", "left", "right").sortWithinPartitions("component", "left", "right"))
    links = written(verify(members, threshold), "forest-links")

    joined = components(links.filter("sid != root").select(F.col("sid").alias("u"), F.col("root").alias("v")))
    counted = links.groupBy("sid").agg(F.sum("n_links").alias("n_links"))
    named = (sets.select("sid", "a", "b", "n_copies", "first")
             .join(joined.withColumnRenamed("node", "sid"), "sid", "left").join(counted, "sid", "left")
             .select("a", "b", "n_copies", "first", F.coalesce("component", "sid").alias("component"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = written(named, "forest-named")
    smallest = named.groupBy("component").agg(F.min("first").alias("class_first"))
    classes = written(named.join(smallest, "component").select("a", "b", "class_first", "n_links", "n_copies"), "forest-classes")
    return (signed.select("id", "row_hash", "a", "b").join(classes.hint("merge"), ["a", "b"], "left")
            .select("id", "row_hash", F.coalesce("class_first.id", "id").alias("class_id"),
                    F.coalesce(F.col("class_first") == F.struct("id", "row_hash"), F.lit(True)).alias("is_first"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies")))
