"""Stateful streams: stops, failures and replays in mid-stream; hourly directories are read once."""

import collections
import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from adsift.operators import cohort as co
from adsift.plans import queries
from adsift.session import scratch_path
from adsift.sinks import write_table
from adsift.sources import testdata as td
from adsift.streaming import (
    first_seen_stream, for_each_batch, hourly_stream, ingest_hours, read_batches, read_first_seen, read_running_totals, run_to_end,
    running_totals_stream,
)
from adsift.streaming.state import member_hits

SF = "/root/testdata/sf0.001"
DSP = "ts timestamp, row_id bigint, synd_id bigint, ext map<string,string>, dt date, hour int"
NOW = {"availableNow": True}


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def dsp_rows(seed, n=300):
    rnd = random.Random(seed)
    day = dt.date(2024, 1, 1)
    some = lambda: rnd.choice([None, "", *(f"d{i}" for i in range(25))])
    return [(dt.datetime(2024, 1, 1), i, rnd.choice([112, 112, 7]), {"IDFA": some(), "DEVICEID": some()},
             day + dt.timedelta(days=rnd.randrange(3)), rnd.randrange(24)) for i in range(n)]


def first_by_model(rows, ids):
    out = {}
    for _, _, synd, ext, day, hour in rows:
        hit = next((ext[k] for k in ("IDFA", "DEVICEID") if ext[k] in ids), None)
        if synd == 112 and hit:
            out[hit] = min(out.get(hit, (day, hour)), (day, hour))
    return {(i, d, h) for i, (d, h) in out.items()}


def stream_of(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def test_member_hits_are_the_batch_matches(spark):
    rows, ids = dsp_rows(4), [f"d{i}" for i in range(0, 25, 3)]
    df, cohort = spark.createDataFrame(rows, DSP), spark.createDataFrame([(i,) for i in ids], "id string")
    got = member_hits(df, co.dsp_candidates(), cohort).distinct()
    want = co.distinct_matches(df, ["dt", "hour"], co.dsp_candidates(), cohort)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_first_seen_survives_a_failure_in_mid_stream(spark, monkeypatch):
    rows, ids = dsp_rows(5), {f"d{i}" for i in range(0, 25, 2)}
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    write_table(spark.createDataFrame(rows, DSP), inbox, num_files=5)
    cohort = spark.createDataFrame([(i,) for i in ids], "id string")
    from pyspark.sql.readwriter import DataFrameWriter
    plain, written = DataFrameWriter.parquet, []

    def failing(self, path, *a, **k):
        if "batch_id=" in path:
            written.append(path)
            if len(written) == 3:   # after the write, before the commit
                plain(self, path, *a, **k)
                raise RuntimeError("the job is lost here")
        return plain(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(StreamingQueryException):
        run_to_end(first_seen_stream(stream_of(spark, inbox, DSP), cohort, out, ckpt, trigger=NOW))
    run_to_end(first_seen_stream(stream_of(spark, inbox, DSP), cohort, out, ckpt, trigger=NOW))
    assert written[2] == written[3] and len(written) == 6   # batch 2 was given again, the others once
    assert set(map(tuple, read_first_seen(spark, out).collect())) == first_by_model(rows, ids)


def test_first_seen_moves_back_for_hours_that_come_late(spark):
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    day, row = dt.date(2024, 1, 1), lambda h, i: (dt.datetime(2024, 1, 1), h, 112, {"IDFA": i}, dt.date(2024, 1, 1), h)
    cohort = spark.createDataFrame([("a",), ("b",)], "id string")
    for rows in ([row(9, "a"), row(9, "x")], [row(4, "a"), row(11, "b")], [row(20, "a"), row(20, "b")]):
        write_table(spark.createDataFrame(rows, DSP), inbox, mode="append", num_files=1)
        run_to_end(first_seen_stream(stream_of(spark, inbox, DSP), cohort, out, ckpt, trigger=NOW))
    assert set(map(tuple, read_first_seen(spark, out).collect())) == {("a", day, 4), ("b", day, 11)}


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_running_totals_over_a_restart_and_a_replayed_batch(spark, mode):
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    texts = ["a b a", "b c", "", "a  c", "d"]
    for i, part in enumerate((texts[:2], texts[2:])):
        write_table(spark.createDataFrame([(t,) for t in part], "value string"), inbox, mode="append", num_files=len(part))
        run_to_end(running_totals_stream(stream_of(spark, inbox, "value string"), out, ckpt, mode, trigger=NOW))
        so_far = texts[:2] if i == 0 else texts
        want = collections.Counter(w for t in so_far for w in (t.rstrip(" ").split(" ") if t else [""]))
        assert {r.word: r.n for r in read_running_totals(spark, out).collect()} == want
    # The last batch written once more, as after a failure, changes nothing.
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    again = spark.read.parquet(f"{out}/batch_id={last}").collect()
    if again:
        spark.createDataFrame(again).write.mode("overwrite").parquet(f"{out}/batch_id={last}")
    assert {r.word: r.n for r in read_running_totals(spark, out).collect()} == want
    with pytest.raises(ValueError):
        running_totals_stream(stream_of(spark, inbox, "value string"), out, ckpt, "append")


def inbox_sizes(spark, monkeypatch, query, sf):
    """The query's rows, and the rows of every file that its stream took in."""
    paths = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, n: paths.append(scratch_path(s, n)) or paths[-1])
    got = query(spark, sf).collect()
    return got, [r["count"] for r in spark.read.parquet(paths[0]).groupBy(F.input_file_name()).count().collect()]


@pytest.mark.parametrize("per_file, files", [(50_000, 6), (5, 20)])
def test_running_totals_files_grow_in_number_with_the_documents(spark, monkeypatch, per_file, files):
    monkeypatch.setattr(td, "DOCS_PER_FILE", per_file)
    sf = scratch_path(spark, "docs")
    texts = [f"a w{i}\n\nb  a" if i else None for i in range(100)]
    write_table(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), f"{sf}/documents.parquet")
    got, sizes = inbox_sizes(spark, monkeypatch, queries.stream_running_totals, sf)
    assert dict(map(tuple, got)) == {"a": 198, "b": 99, "": 198, **{f"w{i}": 1 for i in range(1, 100)}}
    # 297 lines, dealt evenly in either half.
    assert len(sizes) == files and sum(sizes) == 297 and max(sizes) <= 1.1 * 297 / files


def test_first_seen_files_grow_in_number_with_the_feed(spark, monkeypatch):
    n = td.pv_dsp(spark, SF).count()
    want = sorted(map(tuple, queries.stream_first_seen(spark, SF).collect()))
    monkeypatch.setattr(queries, "ROWS_PER_FILE", n // 20)
    got, sizes = inbox_sizes(spark, monkeypatch, queries.stream_first_seen, SF)
    assert sorted(map(tuple, got)) == want and want
    assert len(sizes) == 20 and sum(sizes) == n and max(sizes) <= 1.2 * n / 20


def test_hourly_directories_are_read_once(spark):
    root, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    bids = td.bid(spark, SF).filter("hour < 6 and dt < '2024-01-09'")
    parts = [bids.filter("dt < '2024-01-05'"), bids.filter("dt >= '2024-01-05'")]
    late = parts[0].filter("row_id % 5 = 0")
    sizes, read = [parts[0].filter("row_id % 5 <> 0"), parts[1].unionByName(late), parts[0].limit(0)], []
    for new in sizes:
        if new.count():
            td.hourly_layout(new, root, "bid")
        query = ingest_hours(hourly_stream(spark, root, "bid", fmt="parquet"), out, ckpt, num_files=1)
        run_to_end(query)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read == [s.count() for s in sizes] and read[0] and read[1] and not read[2]
    got = read_batches(spark, out)
    assert sorted(map(tuple, got.select("row_id", "dt", "hour").collect())) == \
        sorted(map(tuple, bids.select("row_id", "dt", "hour").collect()))


def test_new_hours_refresh_the_funnel_store(spark):
    """Discovery, changed hours and partials together: the stream names the hours, the store computes them from whole feeds."""
    from adsift.operators.funnel import funnel
    from adsift.operators.funnel_store import FunnelStore, changed_hours

    root, ckpt = scratch_path(spark, "in"), scratch_path(spark, "ckpt")
    store = FunnelStore(spark, scratch_path(spark, "store"))
    small = [f(spark, SF).filter("dt < '2024-01-04'") for f in (td.pv, td.bid, td.impr, td.click)]
    late, taken = small[1].filter("hour = 3"), []

    def take(feeds):
        def run(batch, batch_id):
            taken.append(changed_hours(batch))
            store.refresh(*feeds, hours=taken[-1])
        return run

    early = [small[0], small[1].filter("hour <> 3"), small[2], small[3]]
    store.refresh(*early)
    td.hourly_layout(early[1], root, "bid")
    run_to_end(for_each_batch(hourly_stream(spark, root, "bid", fmt="parquet"), take(early), ckpt))
    td.hourly_layout(late, root, "bid")
    run_to_end(for_each_batch(hourly_stream(spark, root, "bid", fmt="parquet"), take(small), ckpt))
    assert {h for _, h in taken[-1]} == {3}
    key = lambda r: (r.mcc or "", r.vendor or "", r.nsv or "", r.av or "", r.attributed)
    want = funnel(*small)
    assert sorted(store.report().select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)
