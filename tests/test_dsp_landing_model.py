"""New-ids-per-hour and landing group averages against brute-force models."""

import collections
import datetime as dt
import random

from adsift.operators import cohort as co
from adsift.operators import landing as la
from tests.helpers import feed

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def test_new_by_hour_matches_model(spark):
    rnd = random.Random(3)
    members = {"i1", "i2", "i3", "d1", "d2"}
    rows = []
    for i in range(200):
        ext = {}
        if rnd.random() < 0.8:
            ext["IDFA"] = rnd.choice(["i1", "i2", "i3", "i9", ""])
        if rnd.random() < 0.8:
            ext["DEVICEID"] = rnd.choice(["d1", "d2", "d9"])
        rows.append({"ts": T0 + dt.timedelta(days=rnd.randint(0, 1), hours=rnd.randint(0, 23)),
                     "row_id": i, "synd_id": rnd.choice([112, 112, 7]), "ext": ext})
    out = co.dsp_new_by_hour(feed(spark, "pv_dsp", rows).repartition(3),
                             spark.createDataFrame([(m,) for m in members], "id string"), max_hour=5).collect()
    got = {(r.dt, r.hour): (r.n_new, r.n_total) for r in out}

    first = {}
    for r in rows:
        if r["synd_id"] != 112 or r["ts"].hour > 5:
            continue
        m = next((c for c in (r["ext"].get("IDFA"), r["ext"].get("DEVICEID")) if c and c in members), None)
        if m:
            k = (r["ts"].date(), m)
            first[k] = min(first.get(k, 99), r["ts"].hour)
    new = collections.Counter((d, h) for (d, _), h in first.items())
    want = {}
    for d in {r["ts"].date() for r in rows}:
        tot = 0
        for h in range(6):
            tot += new[(d, h)]
            want[(d, h)] = (new[(d, h)], tot)
    assert got == want


def test_landing_group_matches_model(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(300):
        ext = rnd.choice([{}, {"fd": "x"}, {"fd": ""}, {"fd": "null"}, {"fd": "None"}, {"fd": None}, {"other": "1"}])
        rows.append({"ts": T0 + dt.timedelta(days=rnd.randint(0, 2), hours=rnd.randint(0, 23)),
                     "sponsor_id": rnd.choice([1, 2]), "slot_id": rnd.choice(["a", "b"]),
                     "ht": rnd.randint(0, 100), "lt": rnd.randint(0, 9), "pt": rnd.randint(0, 50), "ext": ext})
    df = feed(spark, "land_page", rows).repartition(4)
    for strict in (False, True):
        got = {(r.dt, r.sponsor_id, r.slot_id): (r.ht_sum, r.lt_sum, r.pt_sum, r.fd_count, r.ht_avg, r.pt_avg)
               for r in la.landing_group_avg(df, strict=strict).collect()}
        acc = collections.defaultdict(lambda: [0, 0, 0, 0])
        for r in rows:
            a = acc[(r["ts"].date(), r["sponsor_id"], r["slot_id"])]
            ok = "fd" in r["ext"] and (not strict or r["ext"]["fd"] not in (None, "", "null", "None"))
            if ok:
                a[0] += r["ht"]
                a[1] += r["lt"]
                a[2] += r["pt"]
                a[3] += 1
        want = {k: (a[0], a[1], a[2], a[3], a[0] / a[3] if a[3] else None, a[2] / a[3] if a[3] else None)
                for k, a in acc.items()}
        assert got == want, f"strict={strict}"
