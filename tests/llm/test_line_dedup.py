"""Line dedup against a brute-force version."""

import hashlib

import pytest

from adsift.llm import line_dedup as ld
from adsift.llm.line_dedup import dedup_lines
from tests.llm import cases

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(docs):
    first = {}
    for doc_id, text, *_ in docs:
        for line in (text or "").split("\n"):
            k = key(line)
            if doc_id is not None and len(k) >= 10:
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(key(x)) < 10 or first[key(x)] >= doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(df, **kw):
    got = dedup_lines(df, **kw).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("batches,fan_out", [(1, 2), (4, 2), (7, 3)])
def test_against_brute_force(spark, batches, fan_out):
    texts = cases.EDGES + cases.random_texts(60)
    df = cases.frame(spark, texts)
    assert run(df, batches=batches, fan_out=fan_out) == brute(cases.rows(texts))


def test_empty_table(spark):
    assert run(cases.empty(spark)) == []


def test_digest_of_query_columns(spark):
    df = cases.frame(spark, ["one long line here", "one long line here\nmore"])
    kept = {r.row.doc_id: r.kept_text for r in dedup_lines(df).collect()}
    assert kept == {0: "one long line here", 1: "more"}
    assert hashlib.sha256(kept[1].encode()).hexdigest() == hashlib.sha256(b"more").hexdigest()


def test_hash_of_a_text_is_not_taken_for_each_of_its_lines(spark):
    """The text is no column of what the explode multiplies, and no hash of it stands above the explode."""
    df = ld.line_hashes(cases.frame(spark, ["a\nb"]), "doc_id", "text", 1)
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "Generate posexplode" in x)
    assert not any("xxhash64(coalesce(text" in x for x in lines[:at]) and "text#" not in lines[at]


def test_time_is_linear_in_the_lines_of_a_text(spark):
    import time
    took = []
    for n in (40_000, 40_000, 160_000):   # the first run also compiles
        text = "\n".join(f"line number {i} of the text" for i in range(n))
        began = time.perf_counter()
        row = ld.dedup_lines(cases.frame(spark, [text, text])).agg({"n_dropped": "sum"}).first()
        took.append(time.perf_counter() - began)
        assert row[0] == n
    assert took[2] < 6 * took[1] + 3
