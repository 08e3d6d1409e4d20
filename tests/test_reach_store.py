"""Bitmap store of cumulative reach: a set model, hours that come late or twice, what is read and written."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from adsift.operators.reach_store import ReachStore
from adsift.session import scratch_path

DAYS = [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(5)]   # over the end of a month
SCHEMA = "dt date, hour int, id string"


def random_hits(seed, n=600):
    rnd = random.Random(seed)
    ids = [f"id{int(rnd.paretovariate(0.6))}" for _ in range(200)]
    rows = [(rnd.choice(DAYS), rnd.randrange(24), rnd.choice(ids)) for _ in range(n)]
    return rows + [(d, h, None) for d in DAYS for h in range(24)]


def model(rows, start=None):
    seen, out = set(), []
    hours = {}
    for d, h, i in rows:
        hours.setdefault((d, h), set()).update([i] if i is not None else [])
    for (d, h), ids in sorted(hours.items()):
        new = ids - seen
        seen |= ids
        if start is None or d >= start:
            out.append((d, h, len(ids), len(new), len(seen)))
    return out


def totals(store, start=None):
    return sorted(map(tuple, store.totals(start=start).select("dt", "hour", "n_ids", "n_new", "n_total").collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_store_against_sets_with_late_and_repeated_hours(spark, seed):
    rows = random_hits(seed)
    rnd = random.Random(seed + 100)
    late = {(d, h) for d in DAYS for h in range(24) if rnd.random() < 0.3}
    store = ReachStore(spark, scratch_path(spark, "rs"))
    store.add_hours(frame(spark, [r for r in rows if r[:2] not in late]))
    assert totals(store) == model([r for r in rows if r[:2] not in late])
    store.add_hours(frame(spark, [r for r in rows if r[:2] in late]).repartition(5))
    store.add_hours(frame(spark, rows[:50] + [r for r in rows if r[:2] in {x[:2] for x in rows[:50]}]))   # again
    assert totals(store) == model(rows)
    assert totals(store, DAYS[3]) == model(rows, DAYS[3])


def test_an_hour_sent_again_replaces_its_set(spark):
    day = DAYS[0]
    store = ReachStore(spark, scratch_path(spark, "rs"))
    store.add_hours(frame(spark, [(day, 1, "a"), (day, 1, "b"), (day, 2, "b"), (day, 2, "c")]))
    store.add_hours(frame(spark, [(day, 1, "a"), (day, 1, "z")]))
    assert totals(store) == [(day, 1, 2, 2, 2), (day, 2, 2, 2, 4)]


def test_numbers_are_dense_and_kept(spark):
    store = ReachStore(spark, scratch_path(spark, "rs"))
    ids = lambda a, b: spark.range(a, b).select(F.lit(DAYS[0]).alias("dt"), F.lit(1).alias("hour"), F.col("id").cast("string").alias("id"))
    store.add_hours(ids(0, 3000).repartition(7))
    first = {r.id: r.num for r in store.table("ids").collect()}
    assert sorted(first.values()) == list(range(1, 3001))
    store.add_hours(ids(2000, 70_000).repartition(3))
    both = {r.id: r.num for r in store.table("ids").collect()}
    assert sorted(both.values()) == list(range(1, 70_001)) and first.items() <= both.items()
    assert totals(store) == [(DAYS[0], 1, 68_000, 68_000, 68_000)]


def test_a_new_hour_writes_its_own_partitions_only(spark):
    root = scratch_path(spark, "rs")
    store = ReachStore(spark, root)
    store.add_hours(frame(spark, [(d, h, f"{h}") for d in DAYS for h in (1, 2)]))
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root)
                     for f in names if f.startswith("part-") and "/ids" not in d}
    before = files()
    store.add_hours(frame(spark, [(DAYS[1], 3, "new")]))
    changed = {p for p in files().items()} ^ set(before.items())
    assert changed
    for path, _ in changed:
        assert any(part in path for part in (f"hours/dt={DAYS[1]}/hour=3", f"days/dt={DAYS[1]}", "months/month=2024-01-01")), path
    # The report of a later day reads sets of its hours, and months and days before it.
    hours = next(x for x in store.totals(start=DAYS[4])._jdf.queryExecution().executedPlan().toString().split("\n") if "/hours" in x)
    assert "PartitionFilters: [isnotnull(dt" in hours


def test_empty_store_and_empty_hours(spark):
    store = ReachStore(spark, scratch_path(spark, "rs"))
    assert totals(store) == []
    store.add_hours(frame(spark, []))
    assert totals(store) == []
    store.add_hours(frame(spark, [(DAYS[0], 4, None)]))
    assert totals(store) == [(DAYS[0], 4, 0, 0, 0)]
