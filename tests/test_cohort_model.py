"""Cohort matching against a brute-force Python model on random rows."""

import collections
import datetime as dt
import random

from pyspark.sql import functions as F

from adsift.operators import cohort as co
from tests.helpers import feed

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def first_member(cands, members):
    for c in cands:
        if c not in (None, "") and c in members:
            return c
    return None


def test_cohort_matching_matches_model(spark):
    rnd = random.Random(11)
    ids = ["d1", "d2", "d3", "u1", "u2", "a1", "a2", "", None]
    for case in range(3):
        members = set(rnd.sample(["d1", "d2", "u1", "u2", "a1", "x"], 3))
        rows = []
        for i in range(150):
            ext = {}
            for k in ("udid", "auid"):
                v = rnd.choice(ids)
                if v is not None or rnd.random() < 0.5:
                    ext[k] = v
            rows.append({"ts": T0 + dt.timedelta(hours=rnd.randint(0, 3)), "row_id": i, "bid_id": "b",
                         "slot_id": rnd.choice(["s1", "s2"]), "app_id": rnd.choice(["252", "7"]),
                         "device_id": rnd.choice(ids), "ext": ext})
        pv = feed(spark, "pv", rows).repartition(4)
        cohort_df = spark.createDataFrame([(m,) for m in members] + [(None,), ("",)], "id string")

        def cands(r, n=3):
            return [r["device_id"], r["ext"].get("udid") or "", r["ext"].get("auid") or ""][:n]

        want_ids = {first_member(cands(r), members) for r in rows} - {None}
        got_ids = {r.id for r in co.cohort_ids(pv, cohort_df).collect()}
        assert got_ids == want_ids, f"case {case}"

        want_pairs = {(r["slot_id"], first_member(cands(r), members)) for r in rows
                      if first_member(cands(r), members)}
        got_pairs = {(r.slot_id, r.device) for r in co.slot_device_pairs(pv, cohort_df).collect()}
        assert got_pairs == want_pairs, f"case {case}"

        flags = {}
        for r in rows:
            f = flags.setdefault(r["app_id"] in ("252",), (set(), set()))
            m1 = first_member(cands(r, 2), members)
            if m1:
                f[0].add(m1)
        got = {r.in_app: r.n_cohort1 for r in
               co.cohort_by_app_flag(pv, cohort_df, cohort_df.filter(F.lit(False)), app_ids=["252"]).collect()}
        assert got == {k: len(v[0]) for k, v in flags.items()}, f"case {case}"


def test_slot_reach_with_total_matches_model(spark):
    rnd = random.Random(13)
    members = {"d1", "u1", "U2", "a1"}
    rows = []
    for i in range(150):
        ext = {}
        if rnd.random() < 0.7:
            ext["udid"] = rnd.choice(["ifa:u1", "ifa:xU2", "U2", "u1", "ifa:", "ab"])
        if rnd.random() < 0.5:
            ext["auid"] = rnd.choice(["a1", "a2", ""])
        rows.append({"ts": T0, "row_id": i, "bid_id": "b", "slot_id": rnd.choice(["s1", "s2", "s3"]),
                     "app_id": "1", "device_id": rnd.choice(["d1", "d9", None, ""]), "ext": ext})
    pv = feed(spark, "pv", rows).repartition(3)
    cohort_df = spark.createDataFrame([(m,) for m in members], "id string")

    def strip(u):
        return u[4:] if u is not None and "ifa:" in u else u

    pairs = set()
    for r in rows:
        m = first_member([r["device_id"], strip(r["ext"].get("udid") or ""), r["ext"].get("auid") or ""], members)
        if m:
            pairs.add((r["slot_id"], m))
    want = collections.Counter(s for s, _ in pairs)
    want = {(s, False): n for s, n in want.items()}
    want[(None, True)] = len({m for _, m in pairs})
    got = {(r.slot_id, r.is_total): r.n_devices for r in co.slot_cohort_reach(pv, cohort_df).collect()}
    assert got == want
