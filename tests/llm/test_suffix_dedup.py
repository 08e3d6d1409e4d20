"""Repeated substrings against a brute-force version."""

import hashlib
import random

import pytest

from adsift.llm import suffix_dedup as sd
from tests.llm import cases


def brute(docs, length):
    texts = [(d[0], (d[1] or "").encode()) for d in docs]
    places = {}
    for i, (_, t) in enumerate(texts):
        for s in range(len(t) - length + 1):
            places.setdefault(t[s:s + length], []).append((i, s))
    gone = [bytearray(len(t)) for _, t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i][s:s + length] = b"\1" * length
    out = []
    for (doc_id, t), g in zip(texts, gone, strict=True):
        spans = sum(1 for k, x in enumerate(g) if x and not (k and g[k - 1]))
        kept = bytes(c for c, x in zip(t, g, strict=True) if not x)
        out.append((doc_id, len(t), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(df, **kw):
    got = sd.repeated_substrings(df, **kw)
    return sorted(((r.id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got.collect()), key=repr)


def passages(n, seed):
    """Texts that share passages of all lengths, with edits and periodic stretches."""
    rnd = random.Random(seed)
    letters = lambda k: "".join(rnd.choices("abé ", k=k))
    shared = [letters(rnd.randint(30, 160)) for _ in range(6)] + ["ab" * 70, "x" * 120]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            p = rnd.choice(shared)
            cut = rnd.randint(0, len(p) // 3)
            parts += [letters(rnd.randint(0, 80)), p[cut:] if rnd.random() < 0.5 else p[:len(p) - cut]]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("kw", [
    {}, {"run_records": 7, "target_records": 5}, {"run_records": 50, "target_records": 20, "local_records": 4},
    {"run_records": 30, "target_records": 9, "max_ranges": 3, "local_records": 8}])
def test_against_brute_force(spark, kw):
    texts = [t for t in cases.EDGES if t is None or len(t) < 10_000] + passages(40, 3)
    texts += [texts[-1], (7000, texts[-2]), (7000, texts[-2])]
    df = cases.frame(spark, texts)
    assert run(df, length=60, spread=30, **kw) == brute(cases.rows(texts), 60)


def test_production_parameters(spark):
    rnd = random.Random(8)
    body = "".join(rnd.choices("abcdefgh ", k=2500))
    texts = [body, body[300:1400] + "tail", "head" + body[1000:1398], "head" + body[1000:1400], "z" * 399, "z" * 900, cases.LONG]
    df = cases.frame(spark, texts)
    assert run(df) == brute(cases.rows(texts), 400)


def test_loser_tree_keeps_order_and_prefixes():
    rnd = random.Random(1)
    runs, everything = [], []
    for _ in range(7):
        strings = sorted(bytes(rnd.choices(b"ab", k=rnd.randint(1, 12))) for _ in range(rnd.randint(0, 30)))
        everything += strings
        shared = [0] + [sd.shared_prefix(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)]
        runs.append(iter([(sd.Suffix(s, b"", 0, 0, 0, 0), k) for s, k in zip(strings, shared, strict=True)]))
    got = [(s.right, k) for s, k in sd.loser_tree(runs)]
    assert [s for s, _ in got] == sorted(everything)
    assert [k for _, k in got][1:] == [sd.shared_prefix(a[0], b[0], 0) for a, b in zip(got, got[1:], strict=False)]


def test_kept_bytes(spark):
    texts = ["A" * 30 + "hello world", "x" * 5 + "A" * 30, "other"]
    df = cases.frame(spark, texts)
    found = sd.repeated_substrings(df, length=40, spread=20)
    kept = {r.id: bytes(r.kept) for r in sd.remove_spans(df, found).collect()}
    assert kept == {i: t.encode() for i, t in enumerate(texts)}
    found = sd.repeated_substrings(df, length=30, spread=14)
    kept = {r.id: bytes(r.kept) for r in sd.remove_spans(df, found).collect()}
    assert kept == {0: b"hello world", 1: b"x" * 5, 2: b"other"}


def test_empty_table(spark):
    assert run(cases.empty(spark)) == []
