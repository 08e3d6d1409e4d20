"""LSH forest join against all-pairs brute force."""

import re
from fractions import Fraction

import numpy as np

from adsift.llm import jaccard_forest as jf
from adsift.llm.graph import components
from tests.llm import cases


def shingles(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", t)
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs):
    docs = sorted({(d[0], d[1] or "") for d in docs if d[0] is not None})
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = []
    for i, x in enumerate(sets):
        near = set()
        for j, y in enumerate(sets):
            if i != j and x and y and Fraction(len(x & y), len(x | y)) >= Fraction(4, 5):
                root[find(i)] = find(j)
                if x != y:
                    near.add(y)
        links.append(len(near))
    classes = {}
    for i, (d, _) in enumerate(docs):
        classes[find(i)] = min(d, classes.get(find(i), d))
    return {(d, t): (classes[find(i)], links[i]) for i, (d, t) in enumerate(docs)}


def near_copies(n, seed):
    rnd = np.random.default_rng(seed)
    base = [f"t{i}" for i in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.integers(0, 3)):
            w[rnd.integers(0, 120)] = f"x{rnd.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


def check(spark, texts, **kw):
    df = cases.frame(spark, texts)
    got = jf.near_duplicates(df, **kw).join(
        df.selectExpr("doc_id as id", "coalesce(text, '') as t", "xxhash64(coalesce(text, '')) as row_hash"), ["id", "row_hash"])
    mine = {(r.id, r.t): (r.class_id, r.n_links) for r in got.collect()}
    assert mine == brute(cases.rows(texts))


def test_against_brute_force(spark):
    check(spark, cases.EDGES + cases.random_texts(80, seed=9, words=(40, 200)))


def test_large_group_in_blocks(spark):
    texts = near_copies(60, 4) + ["unrelated text of seven words in all"]
    check(spark, texts, block=8)


def test_empty_table(spark):
    assert jf.near_duplicates(cases.empty(spark)).collect() == []


def test_blocks_are_cut_by_bytes_too(spark):
    check(spark, near_copies(24, 6) + cases.EDGES, block=100, block_bytes=2000)


def clusters(n, seed, shared, own):
    """Documents around a few long passages, so that tries are crowded with pairs under the threshold."""
    rnd = np.random.default_rng(seed)
    word = lambda: f"w{rnd.integers(0, 10**9)}"
    heads = [[word() for _ in range(shared)] for _ in range(3)]
    out = []
    for i in range(n):
        if i % 4 == 3:
            w = out[-1].split(" ")
            w[int(rnd.integers(0, len(w)))] = word()
            out.append(" ".join(w))
        else:
            out.append(" ".join([*heads[i % 3], *[word() for _ in range(own)]]))
    return out


def test_crowded_nodes_keep_longer_prefixes(spark):
    texts = clusters(160, 3, shared=90, own=60)
    check(spark, texts, crowd=4)
    check(spark, texts + near_copies(30, 8), crowd=2, trees=30)


def test_prefixes_are_settled_as_the_rule_says(spark):
    """Every set's tries: the shortest prefix that few share, shortened further until its recall is reached; the stars tie exactly
    the sets of a settled node."""
    rnd = np.random.default_rng(5)
    trees, depth, target, crowd = 12, 8, 0.97, 3
    values = rnd.integers(0, 3, size=(60, trees, depth))
    values[:20] = values[0]
    for i in range(20):
        for t in range(trees):
            values[i, t, rnd.integers(2, depth):] = rnd.integers(0, 9, size=1)
    packed = np.zeros((60, trees, 2), dtype=np.uint64)
    for d in range(depth):
        packed[:, :, d // 4] |= values[:, :, d].astype(np.uint64) << np.uint64(16 * (3 - d % 4))
    rows = [(i, [int(x) for x in packed[i].ravel().view(np.int64)]) for i in range(60)]
    sets = spark.createDataFrame(rows, "sid bigint, labels array<bigint>").repartition(3)
    got = {r.sid: r.component for r in jf.candidate_groups(sets, 0.8, trees, depth, target, crowd).collect()}
    shortest = jf.prefix_depth(0.8, trees, depth, target)
    assert 1 < shortest < depth
    size = lambda i, t, n: int((values[:, t, :n] == values[i, t, :n]).all(axis=1).sum())
    length = {(i, t): next((n for n in range(shortest, depth) if size(i, t, n) <= crowd), depth) for i in range(60) for t in range(trees)}
    opened, miss = set(), lambda n: np.log(1 - 0.8**n)
    for i in range(60):
        lost = 0.0
        for t in sorted(range(trees), key=lambda t: (-size(i, t, shortest), t)):
            if size(i, t, shortest) > crowd:
                lost += miss(length[i, t]) - miss(shortest)
                if lost > np.log(1 - target) - trees * miss(shortest):
                    opened.add((t, tuple(values[i, t, :shortest])))
    root = list(range(60))
    for t in range(trees):
        for i in range(60):
            n = shortest if (t, tuple(values[i, t, :shortest])) in opened else length[i, t]
            same = np.flatnonzero((values[:, t, :n] == values[i, t, :n]).all(axis=1))
            for j in same:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    want = {i: root[i] for i in range(60) if sum(r == root[i] for r in root) > 1}
    assert got == want and opened and any(length[k] > shortest for k in length)


def test_prefix_is_shortened_to_the_target():
    assert jf.prefix_depth(0.8, 24, 8, 0.9995) == 5
    assert jf.prefix_depth(0.8, 20, 8, 0.9995) == 5
    assert jf.expected_recall(0.8, 20, 5) >= 0.9995 > jf.expected_recall(0.8, 20, 6)


def test_components(spark):
    rnd = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rnd.integers(0, 300, size=(170, 2))] + [(i, i + 1) for i in range(400, 440)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
