"""Sentence span dedup against a brute-force version."""

import random
import re

import pytest

from adsift.llm.span_dedup import dedup_spans
from tests.llm import cases
from tests.llm.test_line_dedup import key


SPACE = " \t\n\x0b\x0c\r"


def parts(piece, max_words):
    """A sentence, cut behind words of 7 or 14 letters if it is long."""
    if piece.count(" ") + 1 <= max_words:
        return [piece]
    body = piece.rstrip(".!?\n")
    out, part = [], ""
    for token in re.findall(r"[ \t\x0b\x0c\r]*[^ \t\x0b\x0c\r]+|[ \t\x0b\x0c\r]+", body):
        part += token
        if len(token.strip(SPACE)) in (7, 14):
            out.append(part)
            part = ""
    out = [*out, part] if part else out
    return [*out[:-1], (out[-1] if out else "") + piece[len(body):]]


def brute(docs, span=3, long_words=20, max_words=25, min_words=0):
    split = []
    for doc_id, text, *_ in docs:
        pieces = [x for p in re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", text or "") for x in parts(p, max_words)]
        assert "".join(pieces) == (text or "")
        at = [i for i, p in enumerate(pieces) if key(p)]
        words, runs = [key(pieces[i]).count(" ") + 1 for i in at], {}
        for n in range(len(at)):
            size = next((k for k in range(1, span) if n + k <= len(at) and sum(words[n:n + k]) >= long_words), span)
            if n + size <= len(at) and doc_id is not None:
                runs[n] = tuple(key(pieces[i]) for i in at[n:n + size])
        split.append((doc_id, text, pieces, at, words, runs))
    first = {}
    for doc_id, text, _, _, _, runs in split:
        for n, run in runs.items():
            first.setdefault(run, set()).add((doc_id, n, text or ""))
    out = []
    for doc_id, _, pieces, at, words, runs in split:
        covered = sorted({n + k for n, run in runs.items() if min(p[:2] for p in first[run]) != (doc_id, n) for k in range(len(run))})
        gone, stretch = set(), []
        for n in [*covered, None]:
            if stretch and (n is None or n != stretch[-1] + 1):
                gone |= set(stretch) if sum(words[k] for k in stretch) >= min_words else set()
                stretch = []
            stretch.append(n)
        kept = [p for i, p in enumerate(pieces) if i not in {at[n] for n in gone}]
        out.append((doc_id, len(at), len(gone), "".join(kept)))
    return sorted(out, key=repr)


def run(spark, texts, **kw):
    got = dedup_spans(cases.frame(spark, texts), **kw)
    return sorted((tuple(r) for r in got.select("row.doc_id", "n_sentences", "n_removed", "kept_text").collect()), key=repr)


@pytest.mark.parametrize("kw", [{"span": 2}, {}, {"min_words": 9}, {"span": 1, "long_words": 4}, {"long_words": 8, "max_words": 6, "min_words": 12},
                                {"span": 4, "max_words": 5}])
def test_against_brute_force(spark, kw):
    texts = cases.EDGES + cases.random_texts(60, seed=5, vocabulary=12)
    assert run(spark, texts, **kw) == brute(cases.rows(texts), **kw)


def test_runs_of_short_sentences_count(spark):
    listing = "\n".join(f"w{i}" for i in range(155))
    texts = [listing, "Before it. " + listing + "\nAfter it.", "Yes. No. So. More of it here.", "Yes. No. So. Other words."]
    got = run(spark, texts)
    assert got == brute(cases.rows(texts))
    assert [r[2] for r in got] == [0, 155, 0, 3]
    # With min_words the long listing goes, the three short sentences that stand alone stay.
    assert [r[2] for r in run(spark, texts, min_words=20)] == [0, 155, 0, 0]


def test_passages_of_few_sentences_or_none(spark):
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(n))
    two = f"{words(26)}. {words(27)}."
    plain = words(55)       # no mark at all
    inner = f"{words(14)}, {words(13)}. {words(12)} and {words(13)}"   # its ends run into the text around
    texts = []
    for passage in (two, plain, inner):
        texts += [f"{words(30)} {passage} {words(8)}. {words(12)}.", f"{words(9)}. {words(5)}. {words(4)} {passage} {words(31)}."]
    got = run(spark, texts, min_words=20)
    assert got == brute(cases.rows(texts), min_words=20)
    assert [r[2] > 0 for r in got] == [False, True] * 3
    for (_, _, _, kept), text, passage in zip(got[1::2], texts[1::2], (two, plain, inner), strict=True):
        assert len(text.split()) - len(kept.split()) >= 20 and len(kept.split()) >= len(text.split()) - len(passage.split())


def test_empty_table(spark):
    assert dedup_spans(cases.empty(spark)).collect() == []


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("min_words", [0, 9])
def test_later_runs_are_exchanged_once(spark, min_words):
    texts = cases.random_texts(40, seed=8, vocabulary=6)
    rows = cases.rows(texts) * 2
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dedup_spans(spark.createDataFrame(rows, cases.SCHEMA), min_words=min_words)
        # Both sides of the join of runs, the later runs by document, the texts.
        assert exchanges(found) == 4
        got = sorted((tuple(r) for r in found.select("row.doc_id", "n_sentences", "n_removed", "kept_text").collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == brute(rows, min_words=min_words) and any(r[2] for r in got)
