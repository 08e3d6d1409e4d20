"""Vector codes: the mask search and the whole query against plain versions, edge rows."""

import hashlib
import math

import numpy as np
import pytest

from adsift.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, v string, code int"


@pytest.mark.parametrize("spread", [1, 3, 40, 10_000])
@pytest.mark.parametrize("k", [1, 2, 7, 64])
def test_nearest_is_exact_with_ties_to_the_lower_index(spread, k):
    rng = np.random.default_rng(spread * 100 + k)
    entries = rng.integers(-spread, spread + 1, (k, 4))
    x = np.concatenate([rng.integers(-3 * spread, 3 * spread + 1, (300, 4)), entries])
    index, best = vc.Slices(entries).nearest(x)
    far = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_candidates_are_the_box():
    rng = np.random.default_rng(5)
    entries, x = rng.integers(-50, 51, (64, 3)), rng.integers(-60, 61, (200, 3))
    radius = rng.integers(0, 60, 200)
    masks = vc.Slices(entries).candidates(x, radius)
    inside = (np.abs(x[:, None, :] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert masks.tolist() == [sum(1 << int(j) for j in np.flatnonzero(row)) for row in inside]


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(x * 256) for x in np.array(e, np.float32).astype(float)], lab) for i, e, lab, *_ in rows
            if e is not None and len(e) and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda c: [min((dist(c[p], e), j) for j, e in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        at = [near(c) for c in cut]
        for p in range(parts):
            for j in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, at, strict=True) if a[p][1] == j]
                new = [sum(x[i] for x in own) // len(own) for i in range(d)] if own else None
                at_j = new if own else books[p][j]
                books[p][j] = at_j
    out = [(i, "".join(f"{j:02x}" for _, j in a), sum(f for f, _ in a), lab) for (i, _, lab), a in
           ((r, near(c)) for r, c in zip(kept, cut, strict=True))]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {}
    for _, _, error, lab in out:
        sums[lab] = sums.get(lab, 0) + error
    return sorted((repr((i, code, error, sums[lab])) for i, code, error, lab in out)), digest


def table(n, seed, dims=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dims))
    rows = []
    for i in range(n):
        e = [float(x) for x in np.float32(centres[i % 6] + rng.normal(0, 0.1, dims))]
        rows.append((int(rng.integers(0, 4 * n)), e, None if i % 9 == 0 else int(rng.integers(0, 4)), "clash", "clash", 1))
    rows += [rows[0], rows[1], rows[1], (None, rows[2][1], 2, "", "", 0), (3, None, 1, "", "", 0),
             (4, [None] + rows[3][1][1:], 1, "", "", 0), (5, [float("nan")] + rows[3][1][1:], 1, "", "", 0),
             (6, rows[3][1][:-1] + [float("-inf")], None, "", "", 0), (7, [], 1, "", "", 0)]
    return rows


@pytest.mark.parametrize("n", [5, 300])
def test_query_against_plain_version(spark, n):
    rows = table(n, n)
    want, digest = plain(rows)
    got, books = vc.compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(repr((r.row.vec_id, r.code, r.error, r.label_error)) for r in got.collect()) == want
    assert books.sha256() == digest


def test_edges(spark):
    got, books = vc.compress_vectors(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and books is None and got.columns == ["row", "code", "error", "label_error"]
    rows = [(1, [1e30] * 16, None, "", "", 0), (2, [-1e30] * 16, None, "", "", 0), (3, [0.5] * 32, 1, "", "", 0), (4, [1.0] * 15, 1, "", "", 0)]
    got, books = vc.compress_vectors(spark.createDataFrame(rows, SCHEMA))
    assert [(r.row.vec_id, r.error) for r in got.orderBy("row.vec_id").collect()] == [(1, 0), (2, 0)]
    assert abs(books.entries).max() <= vc.MAX_COMPONENT
    with pytest.raises(ValueError):
        vc.compress_vectors(spark.createDataFrame([], SCHEMA), entries=65)
