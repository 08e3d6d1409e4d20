"""Landing-page metrics: dwell-time averages and form-field quality.

``fd`` is the form text in ``ext``. By default a row counts when the ``fd``
key is present; ``strict=True`` also rejects NULL, ``''``, ``'null'`` and
``'None'``. Failing rows still form their groups (count 0, averages NULL);
averages divide bigint sums once, in double, with ``try_divide``. A NULL metric
counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsift import fixed
from adsift.functions import form_complete, map_get_or_else, to_text
from adsift.sources.feeds import time_range

DEFAULT_SLOT = fixed.LANDING_SLOT

_METRICS = ("ht", "lt", "pt")


def fd_present(strict: bool = False) -> Column:
    has = F.coalesce(F.map_contains_key(F.col("ext"), F.lit(fixed.FD_KEY)), F.lit(False))
    if not strict:
        return has
    v = F.try_element_at("ext", F.lit(fixed.FD_KEY))
    return has & v.isNotNull() & ~v.isin(*fixed.FD_REJECTED)


def _sums(ok: Column) -> list[Column]:
    aggs = [F.sum(F.when(ok, F.coalesce(m, F.lit(0))).otherwise(F.lit(0))).cast("bigint").alias(f"{m}_sum")
            for m in _METRICS]
    return aggs + [F.count_if(ok).alias("fd_count")]


def _avgs() -> list[Column]:
    return [F.try_divide(F.col(f"{m}_sum").cast("double"), F.col("fd_count")).alias(f"{m}_avg")
            for m in _METRICS]


def landing_daily_avg(land: DataFrame, strict: bool = False, start=None, end=None) -> DataFrame:
    """Per day: averages of ht, lt, pt and the count of rows with ``fd``."""
    t = time_range(land, start, end).groupBy("dt").agg(*_sums(fd_present(strict)))
    return t.select("dt", *_avgs(), "fd_count")


def landing_daily_of_groups(groups: DataFrame) -> DataFrame:
    """``landing_daily_avg`` from the rows of ``landing_group_avg``: sums and
    counts add up, so the feed need not be read again."""
    t = groups.groupBy("dt").agg(*[F.sum(c).cast("bigint").alias(c)
                                   for c in (*[f"{m}_sum" for m in _METRICS], "fd_count")])
    return t.select("dt", *_avgs(), "fd_count")


def landing_group_avg(land: DataFrame, strict: bool = False, start=None, end=None) -> DataFrame:
    """Per ``(dt, sponsor_id, slot_id)``: sums, count and averages."""
    t = (time_range(land, start, end).groupBy("dt", "sponsor_id", "slot_id")
         .agg(*_sums(fd_present(strict))))
    return t.select("dt", "sponsor_id", "slot_id", *[f"{m}_sum" for m in _METRICS],
                    "fd_count", *_avgs())


def slot_matches(constant: str) -> Column:
    """The constant slot id ends with the row's slot id (``''`` matches)."""
    return F.endswith(F.lit(constant), F.col("slot_id"))


def landing_form_counts(land: DataFrame, slot: str = DEFAULT_SLOT, start=None, end=None) -> DataFrame:
    """Per day, rows per ``fd`` value among rows of ``slot`` (``fd`` absent
    counts as ``'null'``): ``(dt, fd, n_rows)``."""
    rows = time_range(land, start, end).filter(F.coalesce(slot_matches(slot), F.lit(False)))
    return (rows.select("dt", map_get_or_else("ext", fixed.FD_KEY, fixed.FD_ABSENT).alias("fd"))
            .groupBy("dt", "fd").agg(F.count("*").alias("n_rows")))


def landing_form_dups(land: DataFrame, slot: str = DEFAULT_SLOT, min_rows: int = 1,
                      start=None, end=None) -> DataFrame:
    """``fd`` values seen more than ``min_rows`` times in a day."""
    return landing_form_counts(land, slot, start, end).filter(F.col("n_rows") > min_rows)


def landing_form_buckets(land: DataFrame, slot: str = DEFAULT_SLOT, start=None, end=None) -> DataFrame:
    """Per day, rows per bucket: the ``fd`` text for rows of ``slot``
    (``'null_fd'`` when absent), ``'else'`` for every other row."""
    bucket = F.when(F.coalesce(slot_matches(slot), F.lit(False)),
                    map_get_or_else("ext", fixed.FD_KEY, fixed.FD_ABSENT_BUCKET)).otherwise(F.lit(fixed.OTHER_BUCKET))
    return (time_range(land, start, end).select("dt", bucket.alias("bucket"))
            .groupBy("dt", "bucket").agg(F.count("*").alias("n_rows")))


def landing_form_quality(land: DataFrame, slot: str = DEFAULT_SLOT, marker: str = fixed.FORM_MARKER,
                         start=None, end=None) -> DataFrame:
    """Per day: number of distinct buckets whose form text is complete."""
    b = landing_form_buckets(land, slot, start, end)
    return b.groupBy("dt").agg(F.count_if(form_complete("bucket", marker)).alias("n_complete"))


def slot_form_values(land: DataFrame, slot: str = DEFAULT_SLOT, day=None, hour=None) -> DataFrame:
    """Distinct ``(dt, hour, fd)`` of one slot (``fd`` ``'null'`` when absent);
    ``day``/``hour`` narrow it to one partition."""
    rows = time_range(land, day, day, None if hour is None else [hour])
    return (rows.filter(F.col("slot_id") == slot)
            .select("dt", "hour", map_get_or_else("ext", fixed.FD_KEY, fixed.FD_ABSENT).alias("fd")).distinct())


def _fmt_avg(c: str) -> Column:
    """``%f`` text: six decimals rounded half-up from the shortest decimal form
    (a decimal cast, code-generated; ``format_string`` only for values beyond
    decimal(38,6)). A group without counted rows prints NaN, like a float 0/0."""
    x = F.coalesce(F.col(c), F.lit(0.0))
    text = F.coalesce(x.try_cast("decimal(38,6)").cast("string"), F.format_string("%f", x))
    return F.when(F.col("fd_count") == 0, F.lit("NaN")).otherwise(text)


def _labelled(labels: dict[str, str], render) -> list[Column]:
    return [F.concat(F.lit(label), render(c)) for c, label in labels.items()]


def landing_daily_text(daily: DataFrame) -> DataFrame:
    """``YYYY-MM-DD: ht_avg:%f,lt_avg:%f,pt_avg:%f,fd_count:%d`` lines."""
    line = F.concat(to_text(F.date_format("dt", "yyyy-MM-dd")), *_labelled(fixed.DAILY_AVG_LABELS, _fmt_avg),
                    *_labelled(fixed.DAILY_COUNT_LABELS, to_text))
    return daily.select(line.alias("value"))


def landing_group_text(groups: DataFrame) -> DataFrame:
    """``yyyy/MM/dd,sponsor,slot,ht_sum:%d,...,count:%d,ht_avg:%f,...`` lines."""
    line = F.concat(to_text(F.date_format("dt", "yyyy/MM/dd")), F.lit(","), to_text("sponsor_id"),
                    F.lit(","), to_text("slot_id"), *_labelled(fixed.GROUP_SUM_LABELS, to_text),
                    *_labelled(fixed.GROUP_AVG_LABELS, _fmt_avg))
    return groups.select(line.alias("value"))
