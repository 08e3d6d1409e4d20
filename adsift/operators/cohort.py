"""Device-cohort reach: which cohort ids a feed reaches, through a priority
list of candidate ids per row (device id, then udid, then auid; or IDFA, then
DEVICEID).

Rows first collapse to distinct candidate tuples (partial aggregation), so a
device seen a million times is joined once. Every tuple's candidates are then stacked as
``(priority, id)`` rows and meet the cohort in ONE join on the id; the tuple's
first member is read off one flag per priority. NULL and empty candidates
never enter the join. A semi join drops non-members at once and cannot multiply rows, so
the id list needs no ``distinct``, both sides come straight from an exchange, and AQE
can split an id that very many tuples share. Spark sizes the cohort at run time: a small
list becomes a broadcast hash join, a large one a sort-merge join. Every result is a DataFrame;
there is no driver-side set, accumulator or per-partition state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsift import fixed
from adsift.functions import map_value, strip_id_prefix, to_text
from adsift.operators import membership, skew
from adsift.session import cut_lineage
from adsift.sources.feeds import time_range

OWN_APP_IDS = fixed.OWN_APP_IDS
DSP_SYND_ID = fixed.DSP_SYND_ID


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ids(cohort: DataFrame) -> DataFrame:
    return cohort.select(F.col("id").cast("string").alias("_id")).filter(F.col("_id") != "")


def _stacked(tuples: DataFrame, cands: list[str], outer: bool = False) -> DataFrame:
    """Each tuple's non-empty candidates as rows with ``_rank`` and ``_id``;
    with ``outer`` a tuple without any keeps one row (NULL ``_id``)."""
    listed = F.filter(F.array(*[F.struct(F.lit(i).alias("_rank"), F.col(c).alias("_id"))
                                for i, c in enumerate(cands)]), lambda x: x["_id"] != "")
    explode = F.inline_outer if outer else F.inline
    return tuples.select("*", explode(listed))


def _first_hit(cands: list[str], flags: list[str]) -> Column:
    """The first candidate whose flag is set."""
    return F.coalesce(*[F.when(F.col(f), F.col(c)) for c, f in zip(cands, flags, strict=True)])


def _hits(cands: list[str], name: str = "_hit", cond: Column | None = None) -> list[Column]:
    cond = F.lit(True) if cond is None else cond
    return [F.coalesce(F.bool_or(cond & (F.col("_rank") == i)), F.lit(False)).alias(f"{name}{i}")
            for i in range(len(cands))]


def _joined(stacked: DataFrame, cohort: DataFrame, hot_share: float | None) -> DataFrame:
    """``stacked`` left-joined to ``cohort`` (with ``_id`` and what marks a member). With ``hot_share``, ids that
    more than that share of the stacked rows have are salted, and the list's rows repeated for those alone."""
    cohort = cohort.withColumnRenamed("_id", "_member_id")
    if hot_share is None:
        return stacked.join(cohort, F.col("_id") == F.col("_member_id"), "left")
    stacked = cut_lineage(stacked)   # read twice: by the sketch and by the join
    return skew.join_salted(stacked, cohort, "_id", "_member_id", "left", skew.heavy_hitters(stacked, "_id", hot_share))


def first_members(tuples: DataFrame, cands: list[str], cohort: DataFrame, out: str = "id", bloom: bool = False) -> DataFrame:
    """The distinct ``tuples`` that have a member among their candidate columns,
    with ``out``: the first candidate (in order) that is in ``cohort``.

    ``cohort`` has one column ``id`` and may repeat ids. Empty or NULL
    candidates never match. ``bloom`` drops most non-members before the shuffle, by a Bloom filter of the
    list: for long lists that few rows are in."""
    stacked = _stacked(tuples, cands)
    if bloom:
        stacked = membership.prefilter(stacked, "_id", _ids(cohort), "_id")
    members = stacked.join(_ids(cohort), "_id", "left_semi")
    flags = [f"_hit{i}" for i in range(len(cands))]
    return (members.groupBy(*tuples.columns).agg(*_hits(cands))
            .select(*tuples.columns, _first_hit(cands, flags).alias(out)))


def match_cohort(df: DataFrame, candidates: list, cohort: DataFrame,
                 out: str = "matched_id") -> DataFrame:
    """Add ``out`` to every row: the first candidate id (in order) that is in
    ``cohort``, NULL without one. Rows keep their identity and are never multiplied."""
    cands = [f"_c{i}" for i in range(len(candidates))]
    rows = df.select(*df.columns, *[_c(c).cast("string").alias(n) for c, n in zip(candidates, cands, strict=True)])
    found = first_members(rows.select(*cands).distinct(), cands, cohort, out="_found")
    found = found.select(*[F.col(c).alias(f"_m{c}") for c in cands], "_found")
    same = F.lit(True)
    for c in cands:
        same = same & F.col(c).eqNullSafe(F.col(f"_m{c}"))
    return rows.join(found, same, "left").select(*df.columns, F.col("_found").alias(out))


def distinct_matches(df: DataFrame, keep: list[str], candidates: list, cohort: DataFrame,
                     out: str = "id", bloom: bool = False) -> DataFrame:
    """Distinct ``(*keep, out)`` over rows whose first member candidate is ``out``."""
    cands = [f"_c{i}" for i in range(len(candidates))]
    tuples = df.select(*keep, *[_c(c).cast("string").alias(n) for c, n in zip(candidates, cands, strict=True)]).distinct()
    return first_members(tuples, cands, cohort, out=out, bloom=bloom).select(*keep, out).distinct()


def pv_candidates(strip_udid: bool = False) -> list[Column]:
    """Page-view id priority: device id, udid, auid. ``strip_udid`` drops an
    ``ifa:`` scheme prefix from the udid first."""
    udid = map_value("ext", fixed.EXT_UDID)
    if strip_udid:
        udid = strip_id_prefix(udid, fixed.IFA_MARKER, fixed.ID_PREFIX_LEN)
    return [F.col("device_id"), udid, map_value("ext", fixed.EXT_AUID)]


def dsp_candidates() -> list[Column]:
    return [map_value("ext", fixed.DSP_IDFA), map_value("ext", fixed.DSP_DEVICEID)]


def cohort_size(cohort: DataFrame) -> DataFrame:
    """One row: ``n_ids`` = distinct non-empty ids of a device list."""
    return (cohort.select(F.col("id").cast("string").alias("id"))
            .filter(F.col("id").isNotNull() & (F.col("id") != "")).distinct()
            .agg(F.count("*").alias("n_ids")))


def cohort_ids(pv: DataFrame, cohort: DataFrame, start=None, end=None, bloom: bool = False) -> DataFrame:
    """Distinct cohort ids reached by page views (``id``); ``bloom`` as in ``first_members``."""
    return distinct_matches(time_range(pv, start, end), [], pv_candidates(), cohort, out="id", bloom=bloom)


def cohort_reach(pv: DataFrame, cohort: DataFrame, start=None, end=None) -> DataFrame:
    """One row: ``n_ids`` = number of distinct cohort ids reached."""
    return cohort_ids(pv, cohort, start, end).agg(F.count("*").alias("n_ids"))


def slot_device_pairs(pv: DataFrame, cohort: DataFrame, strip_udid: bool = False,
                      start=None, end=None) -> DataFrame:
    """Distinct ``(slot_id, device)`` pairs, ``device`` the matched cohort id;
    a NULL slot is the text ``null``."""
    pv = time_range(pv, start, end).withColumn("slot_id", to_text("slot_id"))
    return distinct_matches(pv, ["slot_id"], pv_candidates(strip_udid), cohort, out="device")


def slot_cohort_reach(pv: DataFrame, cohort: DataFrame, start=None, end=None) -> DataFrame:
    """Distinct cohort devices per slot plus the overall distinct count.

    Rows: ``(slot_id, is_total, n_devices)``; the ``is_total`` row has NULL
    ``slot_id``. Udids lose an ``ifa:`` prefix before matching.
    """
    pairs = slot_device_pairs(pv, cohort, strip_udid=True, start=start, end=end)
    return (pairs.rollup("slot_id")
            .agg(F.count_distinct("device").alias("n_devices"),
                 (F.grouping("slot_id") == 1).alias("is_total"))
            .select("slot_id", "is_total", "n_devices"))


def slot_device_counts(pv: DataFrame, cohort: DataFrame, min_devices: int | None = fixed.SLOT_MIN_DEVICES,
                       start=None, end=None) -> DataFrame:
    """Per slot: number of distinct cohort devices, kept when ``> min_devices``."""
    counts = (slot_device_pairs(pv, cohort, start=start, end=end)
              .groupBy("slot_id").agg(F.count("*").alias("n_devices")))
    return counts if min_devices is None else counts.filter(F.col("n_devices") > min_devices)


def cohort_by_app_flag(pv: DataFrame, cohort1: DataFrame, cohort2: DataFrame,
                       app_ids=OWN_APP_IDS, start=None, end=None, hot_share: float | None = None) -> DataFrame:
    """Reach of two cohorts split by whether the page view is in one of
    ``app_ids``: ``(in_app, n_cohort1, n_cohort2)`` distinct ids (device id
    first, then udid). ``hot_share`` salts ids that so large a share of the rows have."""
    flag = F.coalesce(F.col("app_id").isin(list(app_ids)), F.lit(False))
    cands = ["_c0", "_c1"]
    tuples = (time_range(pv, start, end)
              .select(flag.alias("in_app"), *[c.alias(n) for c, n in zip(pv_candidates()[:2], cands, strict=True)])
              .distinct())
    both = (_ids(cohort1).withColumn("_label", F.lit(1))
            .unionByName(_ids(cohort2).withColumn("_label", F.lit(2))))
    # An outer join: a flag without any member still has its row.
    joined = _joined(_stacked(tuples, cands, outer=True), both, hot_share)
    hits = joined.groupBy("in_app", *cands).agg(
        *_hits(cands, "_one", F.col("_label") == 1), *_hits(cands, "_two", F.col("_label") == 2))
    return (hits.groupBy("in_app")
            .agg(F.count_distinct(_first_hit(cands, ["_one0", "_one1"])).alias("n_cohort1"),
                 F.count_distinct(_first_hit(cands, ["_two0", "_two1"])).alias("n_cohort2")))


def dsp_new_by_hour(pv_dsp: DataFrame, cohort: DataFrame, synd_id: int = DSP_SYND_ID,
                    max_hour: int = fixed.MAX_REPORT_HOUR, start=None, end=None, hot_share: float | None = None) -> DataFrame:
    """Per day and hour ``0..max_hour``: cohort ids first seen in that hour
    (``n_new``) and the running distinct total (``n_total``).

    First-seen is ``min(hour)`` per ``(dt, id)``, pre-aggregated per candidate
    tuple before the join. Rows of other partners or later hours only mark their day (no
    candidates), so the feed is read once and every day read has its rows. A day's new ids are
    counted in ``max_hour + 1`` columns, which become its rows; the running
    total is a window over at most that many rows per day. ``hot_share`` salts ids that so large a share of the
    tuples have, for joins that adaptive execution cannot split. The list may repeat ids.
    """
    cands = ["_c0", "_c1"]
    counts = F.coalesce((F.col("hour") <= max_hour) & (F.col("synd_id") == synd_id), F.lit(False))
    tuples = (time_range(pv_dsp, start, end)
              .select("dt", F.when(counts, F.col("hour")).alias("hour"),
                      *[F.when(counts, c).alias(n) for c, n in zip(dsp_candidates(), cands, strict=True)])
              .groupBy("dt", *cands).agg(F.min("hour").alias("hour")))
    joined = _joined(_stacked(tuples, cands, outer=True), _ids(cohort).withColumn("_member", F.lit(True)), hot_share)
    hits = joined.groupBy("dt", *cands).agg(F.min("hour").alias("hour"), *_hits(cands, cond=F.col("_member")))
    first_seen = (hits.select("dt", "hour", _first_hit(cands, ["_hit0", "_hit1"]).alias("id"))
                  .groupBy("dt", "id").agg(F.min("hour").alias("hour")))
    hours = range(max_hour + 1)
    per_day = first_seen.groupBy("dt").agg(
        *[F.count_if(F.col("id").isNotNull() & (F.col("hour") == h)).alias(f"_h{h}") for h in hours])
    rows = per_day.select("dt", F.inline(F.array(*[F.struct(F.lit(h).alias("hour"), F.col(f"_h{h}").alias("n_new"))
                                                   for h in hours])))
    w = Window.partitionBy("dt").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("dt", "hour", "n_new", F.sum("n_new").over(w).cast("bigint").alias("n_total"))
