"""Enrichment against a brute-force Python model on random feeds."""

import datetime as dt
import random

from adsift.operators.enrich import enrich_events
from tests.helpers import feed

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def test_enrich_matches_model(spark):
    rnd = random.Random(5)
    for case in range(3):
        pvs, imps = [], []
        for i in range(80):
            ext = {}
            if rnd.random() < 0.6:
                ext["auid"] = rnd.choice(["A1", "ifa:A2", "x:", None])
            if rnd.random() < 0.6:
                ext["udid"] = rnd.choice(["ifa:U1", "U2", "ab:"])
            pvs.append({"ts": T0 + dt.timedelta(seconds=rnd.randint(0, 5)), "row_id": i,
                        "bid_id": rnd.choice(["a", "b", "c", None]), "app_id": rnd.choice(["252", "9"]),
                        "device_name": rnd.choice(["n1", "n2", None]), "ext": ext})
        for i in range(60):
            imps.append({"ts": T0 + dt.timedelta(milliseconds=rnd.randint(0, 10**6)), "row_id": 1000 + i,
                         "bid_id": rnd.choice(["a", "b", "c", "d", None]), "sponsor_id": rnd.choice([1, 2]),
                         "ip": str(i), "slot_id": "s", "app_id": "252"})
        got = sorted((r.ip, r.device_id, r.device_name) for r in
                     enrich_events(feed(spark, "impr", imps).repartition(3), feed(spark, "pv", pvs).repartition(2),
                                   sponsor_id=1, app_ids=["252"]).collect())

        def expected(imp):
            cands = [p for p in pvs if p["bid_id"] is not None and p["bid_id"] == imp["bid_id"]
                     and p["app_id"] == "252"]
            if not cands:
                return ("", "")
            p = min(cands, key=lambda p: (p["ts"], p["row_id"]))
            did = p["ext"].get("auid")
            if did is None:
                did = p["ext"].get("udid")
            if did is not None and ":" in did:
                did = did[4:]
            return (did, p["device_name"])
        want = sorted((m["ip"], *expected(m)) for m in imps if m["sponsor_id"] == 1)
        assert got == want, f"case {case}"
