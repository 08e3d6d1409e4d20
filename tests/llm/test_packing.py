"""Packing: ids against the tokenizer itself, limits, exact round trip."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from adsift.llm import packing
from tests.llm import cases

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def direct(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)   # as it comes: special token strings are special tokens
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


TEXTS = [None, "", "  ", "don't we'll it's 'tis o'clock 'S 's,'re", "a,b;c!?d...e 1234 5.6% x=y <b> ~`^", "é É ñ ǅ ß ﬁ  áb",
         " nbsp em　space", "x≮ y≠", "中文 字 🙂🙂 emoji", "tab\tnew\nline\r\nform\x0cfeed\x0bvt \x1c\x85",
         "<|endoftext|> inside <|startoftext|>x", "<|ENDOFTEXT|> no", "a<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|",
         "it<|endoftext|>'s e<|startoftext|>\u0301 and <|startoftext|>\n<|endoftext|>b", "İstanbul ΣΑΣ", "A" * 9000, "_under_score__ a-b -- ''quoted''", cases.LONG]


def test_ids_are_the_tokenizers():
    got = [list(x) for x in packing.WordEncoder(PATH).encode(pa.array(TEXTS))]
    assert got == direct(TEXTS)
    assert direct(["hello <|endoftext|> x"]) == [[3306, 49407, 343]]
    more = cases.random_texts(200, seed=2)
    small = packing.WordEncoder(PATH, cache_entries=50)
    for part in (more[:100], more[100:]):
        assert [list(x) for x in small.encode(pa.array(part))] == direct(part)


def check(rows, want, limits):
    """Every id in exactly one piece, no gaps, limits kept; returns the sequences' lengths."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length > 0
        docs[(r.id, r.doc_tokens)].append((r.start, ids.tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    joined = []
    for (i, n), pieces in docs.items():
        at, ids = 0, []
        for start, part in sorted(pieces):
            assert start == at
            at, ids = at + len(part), ids + part
        assert at == n
        joined.append((i, ids))
    assert sorted(joined) == sorted(want)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(pieces) <= limits.segments
    return [sum(n for _, n in p) for p in sequences.values()]


@pytest.mark.parametrize("limits,group", [(packing.Limits(), 10**6), (packing.Limits(64, 5, 62), 500), (packing.Limits(100, 3, 40), 300)])
def test_round_trip_and_limits(spark, limits, group):
    texts = TEXTS + cases.random_texts(60, seed=4)
    df = cases.frame(spark, texts).repartition(3)
    rows = packing.pack_documents(df, PATH, limits=limits, group_tokens=group).collect()
    lengths = check(rows, [(i, ids + [2]) for i, ids in enumerate(direct(texts))], limits)
    if limits.segments == 256:
        assert all(n & (n - 1) == 0 for n in lengths)


def test_loss_limit_with_prompts(spark):
    data = [(i, "answer words " * (i % 7 + 1), "a long prompt " * (i % 5)) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string, prompt string").coalesce(1)
    limits = packing.Limits(128, 16, 48)
    rows = packing.pack_documents(df, PATH, prompt_col="prompt", limits=limits).collect()
    free = dict(enumerate(map(len, direct([d[2] for d in data]))))
    loss = defaultdict(int)
    for r in rows:
        loss[r.sequence_id] += max(0, r.length - max(1, free[r.id] - r.start))
    assert max(loss.values()) <= 48
    check(rows, [(i, p + a + [2]) for i, (p, a) in enumerate(
        zip(direct([d[2] for d in data]), direct([d[1] for d in data]), strict=True))], limits)


def test_edge_rows_and_empty_table(spark):
    rows = packing.pack_documents(cases.frame(spark, cases.EDGES), PATH).collect()
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in direct([d[1] for d in cases.rows(cases.EDGES)]))
    assert packing.pack_documents(cases.empty(spark), PATH).collect() == []
