"""License rules: base places against brute force, detections against a plain scan."""

import re

from adsift.llm import license_scan as ls
from tests.llm import cases


def words(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def base(text):
    w = words(text)
    at, labels = [], set()
    for phrase, label in ls.BASE_PHRASES:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def plain_detections(text):
    s = " " + " ".join(words(text)) + " "
    if not any(a in s for a in ls.ANCHORS):
        return []
    spans = []
    for rule, label, keyword, regex, priority, confidence in ls.build_rules():
        if keyword in s:
            for m in re.finditer(regex, s):
                spans.append((s[:m.start()].count(" ") - 1, s[:m.end()].count(" "), priority, rule, label))
    out = []
    for x in spans:
        if not any(y[2] <= x[2] and y[0] <= x[0] and y[1] >= x[1] and y != x and
                   ((y[0], y[1]) != (x[0], x[1]) or (y[2], y[3]) < (x[2], x[3])) for y in spans):
            out.append(x)
    return sorted((a, b, label) for a, b, _, _, label in out)


LICENSED = [
    "Released under the MIT License.", "MIT LICENSE mit-license mit license apache license",
    "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-3.0-or-later",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "general public license general public license", "apache mit license license", "license", "Unlicense",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this", "All rights reserved. Copyright 2020",
    "GNU Lesser General Public License v2.1 and BSD 3-Clause license; Creative Commons Attribution 4.0 license",
    "summit license", "mit  license", "the mit\nlicense " * 300,
]


def test_hundreds_of_rules():
    rules = ls.build_rules()
    assert len(rules) >= 200 and len({r[3] for r in rules}) == len(rules)
    for _, _, keyword, regex, _, _ in rules:
        re.compile(regex)


def test_base_places_and_detections(spark):
    texts = cases.EDGES + LICENSED
    got = ls.scan_licenses(cases.frame(spark, texts)).collect()
    mine = sorted(((r.row.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr)
    assert mine == sorted(((d[0], *base(d[1])) for d in cases.rows(texts)), key=repr)
    for r in got:
        want = plain_detections(r.row.text)
        assert r.spans == ",".join(f"{label}:{a}:{b}" for a, b, label in want)
        labels = set(r.labels.split(",")) - {""}
        assert labels == ({x[2] for x in want} | set(r.base_labels.split(","))) - {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def ungated(text):
    """The plain scan without anchors and keywords."""
    s = " " + " ".join(words(text)) + " "
    spans = [(s[:m.start()].count(" ") - 1, s[:m.end()].count(" "), priority, rule, label)
             for rule, label, _, regex, priority, _ in ls.build_rules() for m in re.finditer(regex, s)]
    return sorted((x[0], x[1], x[4]) for x in spans if not any(
        y[2] <= x[2] and y[0] <= x[0] and y[1] >= x[1] and y != x and
        ((y[0], y[1]) != (x[0], x[1]) or (y[2], y[3]) < (x[2], x[3])) for y in spans))


def test_gates_lose_nothing(spark):
    names = sorted({re.sub(r"[()?]|\\[cs\\]", " ", re.sub(r"\([^()]*\)\?", "", alternative)).strip()
                    for _, _, name, _ in ls.FAMILIES
                    for alternative in (name, *re.findall(r"[a-z0-9][a-z0-9 ]+", name))})
    texts = [f"{grant} {link}\n{the}{name}." for i, name in enumerate(names)
             for grant, link, the in [(ls.GRANT_WORDS[i % 8], ls.GRANT_LINKS[i % 3], ["", "the terms of the "][i % 2]),
                                      ("Available", "under", "")]]
    texts += [f"{name} license" for name in names]
    grants = ["Released under the MIT.", "It is available under CC BY 4.0", "distributed, under: Apache 2.0 (or so)",
              "Offered by Creative Commons Attribution 4.0", "PSF license", "covered according to the PSF",
              "published under Creative Commons Attribution-ShareAlike 3.0"]
    want = {t: ",".join(f"{label}:{a}:{b}" for a, b, label in ungated(t)) for t in texts + grants}
    assert all(want[t] for t in grants)
    assert len({label for w in want.values() for label in re.findall(r"[^,:]+(?=:\d+:)", w)}) > 60
    for r in ls.scan_licenses(cases.frame(spark, texts + grants)).collect():
        assert r.spans == want[r.row.text], r.row.text


def test_long_texts_behind_every_rule(spark):
    """What each rule may begin with, and 100,000 words after it: no match runs into the matcher's stack."""
    rest = " word" * 100_000
    starts = ["licensed under creative commons attribution", "licensed under the mit", "released under", "license is gpl 2 0 only or",
              "redistribution and use in source and binary forms with", "permission is hereby granted free of charge to any",
              "spdx license identifier cc by", "licensed under the gnu general public license version", "copyright c", "dedicated to the public",
              "available according to the terms and conditions of the open data commons database"]
    texts = [s + rest for s in starts] + ["licensed under creative commons attribution" + " share" * 100_000 + " license"]
    got = {r.row.doc_id: r for r in ls.scan_licenses(cases.frame(spark, texts)).collect()}
    assert len(got) == len(texts) and all(got[i].n_words >= 100_000 for i in range(len(texts)))
    last = len(texts) - 1
    assert f"cc-by:2:{2 + 3 + 100_000 + 1}" in got[last].spans.split(",")
    assert "cc-by" not in got[0].labels


def test_no_rule_repeats_a_group():
    for _, _, _, regex, _, _ in ls.build_rules():
        assert not re.search(r"\)[*+{]", regex), regex


def test_rules_are_broadcast_and_words_are_not_exchanged(spark):
    plan = ls.detections(cases.frame(spark, LICENSED))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for line in plan.split("\n"):
        if "Exchange hashpartitioning" in line:
            assert "keyword" not in line


def test_empty_table(spark):
    assert ls.scan_licenses(cases.empty(spark)).collect() == []
