"""The funnel against a brute-force Python model on random small feeds."""

import collections
import datetime as dt
import random

from adsift.operators.funnel import funnel
from tests.helpers import feed
from tests.test_properties import java_split_model

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def tag(tags, key):
    val = ""
    for t in tags or []:
        p = java_split_model(t, ":") or []
        if len(p) == 2 and p[0] == key:
            val = p[1]
    return val


def dim(m, k):
    v = (m or {}).get(k)
    return "" if v is None else v


def model(rows):
    """rows: (kind, ts, row_id, bid, dims, tags, charge) -> {(mcc,vendor,nsv,av,attributed): counters}"""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[1].date(), r[1].hour, r[3])].append(r)
    out = collections.Counter()
    for rs in groups.values():
        pvs = [r for r in rs if r[0] == "pv"]
        if pvs:
            last = max(pvs, key=lambda r: (r[1], r[2]))
            key = (dim(last[4], "mcc"), tag(last[5], "vendor"), dim(last[4], "nsv"), dim(last[4], "av"), True)
        else:
            key = (None, None, None, None, False)
        for r in rs:
            for i, kind in enumerate(("pv", "bid", "impr", "click")):
                out[key + (i,)] += r[0] == kind
            out[key + (4,)] += r[6] if r[0] == "click" else 0
    res = {}
    for k, v in out.items():
        res.setdefault(k[:5], [0] * 5)[k[5]] += v
    return {k: tuple(v) for k, v in res.items()}


def test_funnel_matches_model(spark):
    rnd = random.Random(7)
    for case in range(3):
        rows = []
        for i in range(120):
            kind = rnd.choice(["pv", "pv", "bid", "impr", "click"])
            ts = T0 + dt.timedelta(minutes=rnd.choice([0, 5, 59, 61, 125, 125]), seconds=rnd.randint(0, 2))
            bid = rnd.choice(["a", "b", "c", None])
            dims = rnd.choice([None, {}, {"mcc": "1"}, {"mcc": "2", "av": "9"}, {"nsv": None, "av": "3"}])
            tags = rnd.choice([None, [], ["vendor:x"], ["vendor:y", "vendor:z:"], ["vendor:", "abtest:1"]])
            rows.append((kind, ts, i, bid, dims, tags, rnd.randint(0, 5)))
        f = {k: [] for k in ("pv", "bid", "impr", "click")}
        for kind, ts, rid, bid, dims, tags, charge in rows:
            r = {"ts": ts, "row_id": rid, "bid_id": bid, "slot_id": "s"}
            if kind == "pv":
                r.update(dims=dims, tags=tags)
            if kind == "click":
                r.update(charge=charge)
            f[kind].append(r)
        frames = [feed(spark, k, f[k]).repartition(3) for k in ("pv", "bid", "impr", "click")]
        got = {(r.mcc, r.vendor, r.nsv, r.av, r.attributed): (r.pv, r.bid, r.impr, r.click, r.charge)
               for r in funnel(*frames).collect()}
        assert got == model(rows), f"case {case}"
