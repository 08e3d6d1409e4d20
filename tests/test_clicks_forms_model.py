"""Click device sets and form quality against brute-force models."""

import collections
import datetime as dt
import random

from adsift.operators import clicks
from adsift.operators import landing as la
from tests.helpers import feed
from tests.test_properties import java_split_model

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def test_click_sets_match_model(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(200):
        ts = T0 + dt.timedelta(days=rnd.randint(0, 2), milliseconds=rnd.choice([0, 1, 999, 1000, 5000]),
                               microseconds=rnd.randint(0, 999))
        rows.append({"ts": ts, "row_id": i, "bid_id": "b", "slot_id": "s", "sponsor_id": rnd.choice([1, 2]),
                     "device_id": rnd.choice(["d1", "d2", None]), "charge": 1})
    df = feed(spark, "click", rows).repartition(3)

    def key(r):
        ms = (r["ts"] - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)   # truncated epoch millis
        return f"{ms} {r['device_id'] if r['device_id'] is not None else 'null'}"

    got = {r.dt: (r.n_clicks, r.n_device_times) for r in clicks.click_device_times(df).collect()}
    per_day = collections.defaultdict(list)
    for r in rows:
        per_day[r["ts"].date()].append(key(r))
    assert got == {d: (len(v), len(set(v))) for d, v in per_day.items()}
    got = {r.value for r in clicks.sponsor_click_devices(df, sponsor_id=2).collect()}
    assert got == {key(r) for r in rows if r["sponsor_id"] == 2}


def test_form_counts_and_quality_match_model(spark):
    rnd = random.Random(8)
    forms = ["a=1&school=x", "a=&school=x", "school=", "school=x", "zzz", "b=2&school=y&c=", "school=school=", ""]
    slots = ["780dc", "dc", "c", "", "zz", None]
    rows = []
    for i in range(200):
        ext = {} if rnd.random() < 0.2 else {"fd": rnd.choice(forms)}
        rows.append({"ts": T0 + dt.timedelta(days=rnd.randint(0, 1)), "sponsor_id": 1, "slot_id": rnd.choice(slots),
                     "ht": 0, "lt": 0, "pt": 0, "ext": ext})
    df = feed(spark, "land_page", rows).repartition(3)
    match = lambda s: s is not None and "780dc".endswith(s)

    counts = collections.Counter((r["ts"].date(), r["ext"].get("fd", "null")) for r in rows if match(r["slot_id"]))
    got = {(r.dt, r.fd): r.n_rows for r in la.landing_form_counts(df, slot="780dc").collect()}
    assert got == dict(counts)

    buckets = collections.defaultdict(set)
    for r in rows:
        buckets[r["ts"].date()].add(r["ext"].get("fd", "null_fd") if match(r["slot_id"]) else "else")

    def complete(b):
        p = java_split_model(b, "school=")
        return len(p) > 1 and "=&" not in p[0]
    got = {r.dt: r.n_complete for r in la.landing_form_quality(df, slot="780dc").collect()}
    assert got == {d: sum(complete(b) for b in bs) for d, bs in buckets.items()}
