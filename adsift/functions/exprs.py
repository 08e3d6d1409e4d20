"""Scalar expressions of the ad-log jobs, written with built-in Spark functions.

Each helper returns a ``Column`` so it fuses into whole-stage codegen with the
rest of the projection; none of them needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adsift import fixed

_REGEX_META = set("\\^$.|?*+()[]{}")


def _lit_regex(text: str) -> str:
    """Regex matching ``text`` literally (for split / regexp_replace)."""
    if not text:
        raise ValueError("delimiter must be non-empty")
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(s, delim: str) -> Column:
    """Split like ``java.lang.String.split(delim)`` with a literal delimiter.

    Leading empty parts are kept, trailing empty parts are dropped, ``''``
    gives ``['']`` and a text made only of delimiters gives ``[]``. Spark's own
    ``split`` keeps trailing empties, hence the anchored strip first.
    """
    s = _col(s)
    pat = _lit_regex(delim)
    if len(delim) == 1:
        # A one-character delimiter: trailing runs are a plain right trim.
        stripped = F.rtrim(s, F.lit(delim))
    else:
        stripped = F.regexp_replace(s, f"(?:{pat})+$", "")
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pat, -1))
    )


def map_value(m, key: str, default: str = "") -> Column:
    """``map.get(key).fold(default)(_.toString)``: missing key, NULL value or
    NULL map all give ``default``."""
    return F.coalesce(F.try_element_at(_col(m), F.lit(key)), F.lit(default))


def map_get_or_else(m, key: str, default: str) -> Column:
    """``map.getOrElse(key, default)``: default only when the key is absent
    (a present key with a NULL value stays NULL)."""
    m = _col(m)
    return F.when(F.coalesce(F.map_contains_key(m, F.lit(key)), F.lit(False)),
                  F.try_element_at(m, F.lit(key))).otherwise(F.lit(default))


def tag_value(tags, key: str, sep: str = ":") -> Column:
    """Value of the **last** ``key:value`` tag that splits into exactly two
    parts; ``''`` when none does (or the array is NULL)."""
    if len(sep) == 1:
        # Java's split gives exactly [key, v] iff the tag is key, sep, a
        # non-empty run without sep, then only (dropped) trailing seps.
        k, d = _lit_regex(key), _lit_regex(sep)
        hits = F.filter(_col(tags), lambda t: t.rlike(f"^{k}{d}[^{d}]+{d}*\\z"))
        last = F.try_element_at(hits, F.lit(-1))
        return F.coalesce(F.regexp_extract(last, f"^{k}{d}([^{d}]+)", 1), F.lit(""))
    parts = F.transform(_col(tags), lambda t: java_split(t, sep))
    hits = F.filter(parts, lambda p: (F.size(p) == 2) & (F.try_element_at(p, F.lit(1)) == key))
    return F.coalesce(F.try_element_at(F.try_element_at(hits, F.lit(-1)), F.lit(2)), F.lit(""))


def strip_id_prefix(c, marker: str, n: int = 4) -> Column:
    """Drop the first ``n`` characters of ids that contain ``marker`` (an id
    scheme such as ``ifa:``). Ids shorter than ``n`` become ``''``."""
    c = _col(c)
    return F.when(c.contains(marker), c.substr(n + 1, 2147483647)).otherwise(c)


def form_complete(fd, marker: str = fixed.FORM_MARKER) -> Column:
    """A form text is complete when something non-empty follows ``marker`` and
    the part before it has no empty field (``=&``)."""
    parts = java_split(fd, marker)
    ok = (F.size(parts) > 1) & ~F.try_element_at(parts, F.lit(1)).contains(fixed.FORM_EMPTY_FIELD)
    return F.coalesce(ok, F.lit(False))


def iso_millis(ts, tz: str | None = None) -> Column:
    """ISO-8601 text with milliseconds and offset, e.g.
    ``2024-01-01T00:03:52.824Z``: in the session time zone by default, or in
    UTC when ``tz="UTC"``."""
    if tz is None:
        return F.date_format(_col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    if tz.upper() not in ("UTC", "Z", "GMT"):
        raise ValueError("tz must be None (session zone) or 'UTC'")
    from adsift.sources.feeds import wall_clock
    return F.concat(F.date_format(wall_clock(_col(ts), "UTC"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def is_one_of(c, values: list) -> Column:
    """Whether ``c`` is one of ``values``; NULL is not, and nothing is in an empty list."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False)) if values else F.lit(False)


def to_text(c) -> Column:
    """``String.valueOf``: NULL renders as the text ``null``; for sinks only."""
    return F.coalesce(_col(c).cast("string"), F.lit("null"))
