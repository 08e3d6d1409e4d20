"""Personal data: base rules against the plain regexes, and discovery by context."""

import random
import re

from adsift.llm import pii
from tests.llm import cases


def brute(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(pii.KINDS[k], a, b) for a, k, b in sorted(out)]


def noise(n, seed):
    rnd = random.Random(seed)
    pool = ["a", "Z", "@", ".", "-", "+", "1", "4", "0", "9", " ", "é", "(", ")", "example.com", "25", "192.168.0.1",
            "4111 1111 1111 1111", "+1 (555) 123-4567", "_", "%", "@@", "..", "5555-5555-5555-4444"]
    return ["".join(rnd.choices(pool, k=rnd.randint(1, 60))) for _ in range(n)]


def test_base_spans_are_the_plain_regexes():
    for text in [*cases.EDGES, *noise(4000, 1)]:
        text = text[1] if isinstance(text, tuple) else text
        assert [(k, a, b) for a, b, k in pii.base_spans(text or "")] == brute(text), text


def test_operator_over_rows(spark):
    texts = cases.EDGES + noise(150, 2)
    got = pii.find_personal_data(cases.frame(spark, texts)).collect()
    assert sorted([(r.id, [tuple(s) for s in r.base]) for r in got], key=repr) == \
        sorted([(d[0], brute(d[1])) for d in cases.rows(texts)], key=repr)
    for r in got:
        base, spans = [tuple(s) for s in r.base], [tuple(s) for s in r.spans]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
        extra = set(spans) - set(base)
        assert all(e[2] <= b[1] or e[1] >= b[2] for e in extra for b in base)


def test_context_discovers_unseen_identifiers(spark):
    rnd = random.Random(5)
    seeds = [f"please call me on +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)} after work" for _ in range(30)]
    hidden = "please call me on (415) 555-0199 after work"
    other = [f"the score was {rnd.randint(100, 999)} 200 {rnd.randint(1000, 9999)} points" for _ in range(30)]
    got = {r.id: r.spans for r in pii.find_personal_data(cases.frame(spark, [*seeds, hidden, *other])).collect()}
    assert [(s.kind, hidden[s.start:s.end]) for s in got[30]] == [("phone", "(415) 555-0199")]
    assert all(got[i] == [] for i in range(31, 61))


def test_believed_frames_propose_what_stands_in_them(spark):
    """Names without any mark of an address, where addresses stand; not in frames that hold other things, too."""
    rnd = random.Random(6)
    name = lambda: "".join(rnd.choices("abcdefgh", k=8))
    seeds = [f"For help contact mail {name()}@{name()}.com now, or write." for _ in range(20)]
    loose = [f"{name()} {name()} the {name()}@{name()}.org of {name()}" for _ in range(4)]
    common = [f"{name()} {name()} the {name()} of {name()}" for _ in range(60)]
    hidden = ["Please contact mail carolsmith now.", "é 🙂 contact mail (dave.jones), now", "contact mail carol@home now"]
    texts = [*hidden, *seeds, *loose, *common, *hidden[:1]]
    got = {}
    for r in pii.find_personal_data(cases.frame(spark, texts).repartition(4)).collect():
        got[r.id] = [(s.kind, texts[r.id][s.start:s.end]) for s in r.spans if tuple(s) not in [tuple(b) for b in r.base]]
    assert [got[i] for i in range(3)] == [[("email", "carolsmith")], [("email", "dave.jones")], [("email", "carol@home")]]
    assert got[len(texts) - 1] == [("email", "carolsmith")]
    assert all(got[i] == [] for i in range(3, len(texts) - 1))


def test_both_scans_see_the_same_frames():
    rnd = random.Random(7)
    for text in [*noise(300, 3), "Contact Mail é.ü X now, ok", "a b c", "İ ẞ 中文 x y"]:
        raw, at = pii.textscan.utf8(pii.pa.array([text]))
        s = pii.textscan.scan(raw, at)
        if len(s.start) < 3:
            continue
        k = rnd.randrange(len(s.start))
        start, end = len(raw[:s.start[k]].tobytes().decode()), len(raw[:s.end[k]].tobytes().decode())
        frames = [f for _, f in pii.patterns(text, start, end, "ip") if f]
        table = pii.np.zeros(1 << pii.FRAME_BITS, dtype=bool)
        table[[f & ((1 << pii.FRAME_BITS) - 1) for f in frames]] = True
        near = (k < 2 or s.start[k] - s.start[k - 2] < 30) and (k + 1 >= len(s.start) or s.end[k + 1] - s.end[k] < 12)
        if frames and near:
            assert k in pii.framed_words(s, table), (text, k)


def test_long_digit_runs_are_linear():
    assert pii.base_spans("1" * 300_000 + "." + "2" * 300_000) == []
    assert pii.base_spans("a" * 300_000 + "@" + "b" * 300_000) == []


def test_empty_table(spark):
    assert pii.find_personal_data(cases.empty(spark)).collect() == []
