"""DuckDB SQL for every registered query, over the raw test tables.

The feed adapters are repeated here as CTEs (map entries become plain
columns; a missing key is NULL), and each job is written independently in
SQL so the two engines check each other. Column names and types match the
Spark results.
"""

from __future__ import annotations

from adsift import fixed

K = "json_extract_string(props, '$.k')"


def _but(n: int, value: str, key: str = "event_id") -> str:
    """The adapters' NULL in every n-th row."""
    return f"CASE WHEN {key} % {n} <> 0 THEN {value} END"


# ---- feed adapters -------------------------------------------------------
PV = f"""pv AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, event_id AS row_id, {_but(101, "CAST(user_id AS VARCHAR)")} AS bid_id,
         {K} AS app_id, {_but(103, "CAST(user_id % 4 AS VARCHAR)")} AS slot_id,
         {_but(107, "CAST(user_id AS VARCHAR)")} AS device_id,
         'device-' || CAST(event_id % 7 AS VARCHAR) AS device_name,
         CASE WHEN event_id % 11 = 0 THEN '8' ELSE CAST(user_id % 3 AS VARCHAR) END AS vendor_tag,
         CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(user_id % 2 AS VARCHAR) END AS abtest_tag,
         'ifa:' || {K} AS udid, CASE WHEN event_id % 2 = 0 THEN {K} END AS auid,
         CAST(user_id % 5 AS VARCHAR) AS mcc, CAST(NULL AS VARCHAR) AS nsv, {K} AS av,
         CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour
  FROM events WHERE event_type = 'view')"""


def _simple_feed(name: str, event_type: str, extra: str = "") -> str:
    return f"""{name} AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, event_id AS row_id, {_but(101, "CAST(user_id AS VARCHAR)")} AS bid_id,
         {_but(103, "CAST(user_id % 4 AS VARCHAR)")} AS slot_id, {_but(109, "user_id % 3")} AS sponsor_id, {K} AS app_id,
         CAST(event_id AS VARCHAR) AS ip, {_but(107, "CAST(user_id AS VARCHAR)")} AS device_id,
         CAST(round(value * 100) AS INTEGER) AS charge,
         CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour
  FROM events WHERE event_type = '{event_type}')"""


BID = _simple_feed("bid", "signup")
IMPR = _simple_feed("impr", "click")
CLICK = _simple_feed("click", "purchase")

COHORT1 = "cohort1 AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_mktsegment = 'BUILDING')"
COHORT2 = "cohort2 AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_mktsegment = 'MACHINERY')"
COHORT = f"{COHORT1}, {COHORT2}, cohort AS (SELECT id FROM cohort1 UNION SELECT id FROM cohort2)"

LAND = f"""land AS (
  SELECT CAST(l_shipdate AS DATE) AS dt, {_but(17, "l_suppkey", "l_orderkey")} AS sponsor_id,
         {_but(19, "l_linestatus", "l_orderkey")} AS slot_id,
         CAST(trunc(l_extendedprice) AS BIGINT) AS ht,
         {_but(23, "CAST(l_linenumber AS BIGINT)", "l_orderkey")} AS lt,
         l_partkey AS pt, l_returnflag <> 'N' AS has_fd,
         CASE WHEN l_returnflag <> 'N' THEN CASE l_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN 'null'
              WHEN 2 THEN 'None' WHEN 3 THEN NULL ELSE l_returnflag END END AS fd
  FROM lineitem)"""

FORM = f"""form AS (
  SELECT CAST(TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id % 48) AS DATE) AS dt,
         CAST(page_id % 48 % 24 AS INTEGER) AS hour,
         CASE page_id % 3 WHEN 0 THEN '{fixed.LANDING_SLOT}' WHEN 1 THEN '{fixed.LANDING_SLOT[-4:]}'
              ELSE 'another-landing-slot' END AS slot_id,
         page_id % 7 <> 0 AS has_fd,
         CASE WHEN page_id % 4 = 0 THEN replace(url, 'page=2', 'page=') ELSE url END AS fd
  FROM pages)"""

RECORDS = "records AS (SELECT CAST(p_partkey AS INTEGER) AS key, 'val_' || CAST(p_partkey AS VARCHAR) AS value FROM part)"


def java_split(s: str, delim: str) -> str:
    """SQL for Java's String.split with a literal delimiter."""
    pat = "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in delim)
    stripped = f"regexp_replace({s}, '({pat})+$', '')"
    return (f"(CASE WHEN {s} = '' THEN [''] WHEN {stripped} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split({stripped}, '{delim}') END)")


# ---- funnel --------------------------------------------------------------
def _funnel(dims: dict[str, str], grain: str = "hour", per_day: bool = False, where: str = "true") -> str:
    g = "dt, hour" if grain == "hour" else "dt"
    dnames = ", ".join(dims)
    dsel = ", ".join(f"{e} AS {n}" for n, e in dims.items())
    dnull = ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in dims)
    rest = "\n      ".join(
        f"UNION ALL SELECT {g}, bid_id, ts, row_id, 0, {int(k == 'bid')}, {int(k == 'impr')}, "
        f"{int(k == 'click')}, {'charge' if k == 'click' else 0}, {dnull} FROM {k} WHERE {where}"
        for k in ("bid", "impr", "click"))
    day = "l.dt, " if per_day else ""
    day_src = "c.dt AS dt, " if per_day else ""
    return f"""WITH {PV}, {BID}, {IMPR}, {CLICK},
    u AS (
      SELECT {g}, bid_id, ts, row_id, 1 AS pv, 0 AS bid, 0 AS impr, 0 AS click, 0 AS charge, {dsel} FROM pv WHERE {where}
      {rest}),
    per_bid AS (SELECT {g}, bid_id, sum(pv) AS pv, sum(bid) AS bid, sum(impr) AS impr,
                       sum(click) AS click, sum(charge) AS charge FROM u GROUP BY {g}, bid_id),
    latest AS (SELECT {g}, bid_id, {dnames}, true AS has_pv FROM u WHERE pv = 1
               QUALIFY row_number() OVER (PARTITION BY {g}, bid_id ORDER BY ts DESC, row_id DESC) = 1),
    j AS (SELECT {day_src}{", ".join("l." + n + " AS " + n for n in dims)},
                 coalesce(l.has_pv, false) AS attributed, c.pv, c.bid, c.impr, c.click, c.charge
          FROM per_bid c LEFT JOIN latest l
            ON c.bid_id IS NOT DISTINCT FROM l.bid_id AND {" AND ".join("c." + x + " = l." + x for x in g.split(", "))})
    SELECT {day.replace("l.", "")}{dnames}, attributed,
           CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(bid) AS BIGINT) AS bid, CAST(sum(impr) AS BIGINT) AS impr,
           CAST(sum(click) AS BIGINT) AS click, CAST(sum(charge) AS BIGINT) AS charge
    FROM j GROUP BY ALL"""


DEFAULT_DIMS = {"mcc": "coalesce(mcc, '')", "vendor": "vendor_tag",
                "nsv": "coalesce(nsv, '')", "av": "coalesce(av, '')"}
ABTEST_DIMS = {"abtest": "abtest_tag"}
VERSION_DIMS = {"av": "coalesce(av, '')"}

FUNNEL_LINE = ("'(' || {key} || ',(' || pv || ',' || bid || ',' || impr || ',' || click || ',' || charge || '))'")


def _funnel_text() -> str:
    key = "CASE WHEN attributed THEN concat_ws(',', mcc, vendor, nsv, av) ELSE '' END"
    return f"SELECT {FUNNEL_LINE.format(key=key)} AS value FROM ({_funnel(DEFAULT_DIMS)})"


def _funnel_abtest_text() -> str:
    key = "CASE WHEN attributed THEN abtest || ',,,' ELSE '' END"
    return f"SELECT {FUNNEL_LINE.format(key=key)} AS value, dt FROM ({_funnel(ABTEST_DIMS, per_day=True)})"


def _funnel_version_text() -> str:
    key = "CASE WHEN attributed THEN strftime(dt, '%Y%m%d') || ',,,' || av ELSE '' END"
    return f"SELECT {FUNNEL_LINE.format(key=key)} AS value, dt FROM ({_funnel(VERSION_DIMS, per_day=True)})"


# ---- enrichment ----------------------------------------------------------
def _enrich(left: str, pv_where: str = "true", where: str = "true") -> str:
    return f"""WITH {PV}, {IMPR}, {CLICK},
    firstpv AS (SELECT bid_id, coalesce(auid, udid) AS did, device_name AS dn FROM pv WHERE {pv_where}
                QUALIFY row_number() OVER (PARTITION BY bid_id ORDER BY ts, row_id) = 1)
    SELECT strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts_iso,
           CASE WHEN f.bid_id IS NULL THEN '' WHEN f.did LIKE '%:%' THEN substr(f.did, 5) ELSE f.did END AS device_id,
           CASE WHEN f.bid_id IS NULL THEN '' ELSE f.dn END AS device_name,
           e.ip, e.slot_id, e.app_id
    FROM (SELECT * FROM {left} WHERE {where}) e LEFT JOIN firstpv f ON e.bid_id = f.bid_id"""


DAYS = "dt BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'"
APPS = ", ".join(f"'{i}'" for i in range(50))


def _enrich_sponsor(left: str) -> str:
    return _enrich(left, f"{DAYS} AND app_id IN ({APPS})", f"{DAYS} AND sponsor_id = 1")


def _enrich_text(left: str = "impr") -> str:
    cols = ["ts_iso", "device_id", "device_name", "ip", "slot_id", "app_id"]
    body = " || ';' || ".join(f"coalesce({c}, 'null')" for c in cols)
    return f"SELECT {body} || ';' AS value FROM ({_enrich(left)})"


# ---- cohorts -------------------------------------------------------------
def _pick(cands: list[str], cohort: str = "cohort") -> str:
    whens = " ".join(f"WHEN {c} IN (SELECT id FROM {cohort}) THEN {c}" for c in cands)
    return f"CASE {whens} END"


PV_CANDS = ["device_id", "udid", "auid"]
PV_CANDS_STRIPPED = ["device_id", "CASE WHEN udid LIKE '%ifa:%' THEN substr(udid, 5) ELSE udid END", "auid"]


def _pairs(cands) -> str:
    return f"""WITH {PV}, {COHORT},
    m AS (SELECT coalesce(slot_id, 'null') AS slot_id, {_pick(cands)} AS device FROM pv)
    SELECT DISTINCT slot_id, device FROM m WHERE device IS NOT NULL"""


SLOT_COHORT_REACH = f"""SELECT slot_id, GROUPING(slot_id) = 1 AS is_total, count(DISTINCT device) AS n_devices
FROM ({_pairs(PV_CANDS_STRIPPED)}) GROUP BY ROLLUP (slot_id)"""

COHORT_SIZE = f"WITH {COHORT} SELECT count(*) AS n_ids FROM cohort"

COHORT_IDS = f"""WITH {PV}, {COHORT}
SELECT DISTINCT {_pick(PV_CANDS)} AS id FROM pv WHERE {_pick(PV_CANDS)} IS NOT NULL"""

COHORT_REACH = f"SELECT count(*) AS n_ids FROM ({COHORT_IDS})"

SLOT_DEVICE_COUNTS = f"""SELECT slot_id, count(*) AS n_devices FROM ({_pairs(PV_CANDS)})
GROUP BY slot_id HAVING count(*) > 10"""

COHORT_BY_APP_FLAG = f"""WITH {PV}, {COHORT}
SELECT coalesce(app_id IN ('25', '46'), false) AS in_app,
       count(DISTINCT {_pick(PV_CANDS[:2], 'cohort1')}) AS n_cohort1,
       count(DISTINCT {_pick(PV_CANDS[:2], 'cohort2')}) AS n_cohort2
FROM pv GROUP BY ALL"""

DSP_NEW_BY_HOUR = f"""WITH {COHORT},
dsp AS (SELECT CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour,
               CASE WHEN user_id % 5 = 0 THEN 0 ELSE 112 END AS synd_id,
               CAST(user_id AS VARCHAR) AS idfa, {K} AS deviceid FROM events),
feed AS (SELECT * FROM dsp),
m AS (SELECT dt, hour, {_pick(["idfa", "deviceid"])} AS id FROM feed WHERE synd_id = 112),
firstseen AS (SELECT dt, id, min(hour) AS hour FROM m WHERE id IS NOT NULL GROUP BY dt, id),
new AS (SELECT dt, hour, count(*) AS n FROM firstseen GROUP BY dt, hour),
spine AS (SELECT d.dt, CAST(h.range AS INTEGER) AS hour FROM (SELECT DISTINCT dt FROM dsp) d, range(0, 24) h)
SELECT s.dt, s.hour, CAST(coalesce(n.n, 0) AS BIGINT) AS n_new,
       CAST(sum(coalesce(n.n, 0)) OVER (PARTITION BY s.dt ORDER BY s.hour) AS BIGINT) AS n_total
FROM spine s LEFT JOIN new n ON s.dt = n.dt AND s.hour = n.hour"""

#: Cohort ids reached by the partner's page views, and the hours of the feed.
_DSP_MEMBERS = DSP_NEW_BY_HOUR[:DSP_NEW_BY_HOUR.index("firstseen AS")]
FIRST_SEEN = f"""{_DSP_MEMBERS}firstseen AS (SELECT id, min({{'dt': dt, 'hour': hour}}) AS first FROM m WHERE id IS NOT NULL GROUP BY id)
SELECT id, first.dt AS dt, first.hour AS hour FROM firstseen"""
REACH_CUMULATIVE = f"""{_DSP_MEMBERS}hrs AS (SELECT DISTINCT dt, hour FROM dsp),
ids AS (SELECT dt, hour, count(DISTINCT id) AS n FROM m WHERE id IS NOT NULL GROUP BY dt, hour),
new AS (SELECT dt, hour, count(*) AS n FROM ({FIRST_SEEN}) GROUP BY dt, hour)
SELECT h.dt, h.hour, coalesce(i.n, 0)::BIGINT AS n_ids, coalesce(w.n, 0)::BIGINT AS n_new,
       CAST(sum(coalesce(w.n, 0)) OVER (ORDER BY h.dt, h.hour) AS BIGINT) AS n_total
FROM hrs h LEFT JOIN ids i ON i.dt = h.dt AND i.hour = h.hour LEFT JOIN new w ON w.dt = h.dt AND w.hour = h.hour"""

# ---- clicks --------------------------------------------------------------
CLICK_KEY = "coalesce(CAST(epoch_us(ts) // 1000 AS VARCHAR), 'null') || ' ' || coalesce(device_id, 'null')"
CLICK_DEVICE_TIMES = f"""WITH {CLICK}
SELECT dt, count(*) AS n_clicks, count(DISTINCT {CLICK_KEY}) AS n_device_times FROM click GROUP BY dt"""
SPONSOR_CLICK_DEVICES = f"WITH {CLICK} SELECT DISTINCT {CLICK_KEY} AS value FROM click"
ONE_SPONSOR_CLICK_DEVICES = f"{SPONSOR_CLICK_DEVICES} WHERE sponsor_id = 1 AND {DAYS}"

# ---- landing -------------------------------------------------------------
_SUMS = """CAST(sum(CASE WHEN has_fd THEN ht ELSE 0 END) AS BIGINT) AS ht_sum,
           CAST(sum(CASE WHEN has_fd THEN coalesce(lt, 0) ELSE 0 END) AS BIGINT) AS lt_sum,
           CAST(sum(CASE WHEN has_fd THEN pt ELSE 0 END) AS BIGINT) AS pt_sum,
           count(*) FILTER (WHERE has_fd) AS fd_count"""
_AVGS = ", ".join(f"CASE WHEN fd_count = 0 THEN NULL ELSE CAST({m}_sum AS DOUBLE) / fd_count END AS {m}_avg"
                  for m in ("ht", "lt", "pt"))

LANDING_DAILY_AVG = f"""WITH {LAND}
SELECT dt, {_AVGS}, fd_count FROM (SELECT dt, {_SUMS} FROM land GROUP BY dt)"""

LANDING_GROUP_AVG = f"""WITH {LAND}
SELECT dt, sponsor_id, slot_id, ht_sum, lt_sum, pt_sum, fd_count, {_AVGS}
FROM (SELECT dt, sponsor_id, slot_id, {_SUMS} FROM land GROUP BY dt, sponsor_id, slot_id)"""

LANDING_DAILY_STRICT = LANDING_DAILY_AVG.replace(
    "l_returnflag <> 'N' AS has_fd", "l_returnflag <> 'N' AND l_orderkey % 13 > 3 AS has_fd")


def _f(c: str) -> str:
    """Java ``%f``: six decimals rounded half-up (C ``printf`` rounds ties to even)."""
    six = f"CAST(round(CAST({c} AS DECIMAL(38,10)), 6) AS DECIMAL(38,6))"
    return f"CASE WHEN {c} IS NULL THEN 'NaN' ELSE CAST({six} AS VARCHAR) END"


LANDING_DAILY_TEXT = f"""SELECT strftime(dt, '%Y-%m-%d') || ': ht_avg:' || {_f('ht_avg')} || ',lt_avg:' || {_f('lt_avg')}
    || ',pt_avg:' || {_f('pt_avg')} || ',fd_count:' || fd_count AS value FROM ({LANDING_DAILY_AVG})"""

LANDING_GROUP_TEXT = f"""SELECT strftime(dt, '%Y/%m/%d') || ',' || coalesce(CAST(sponsor_id AS VARCHAR), 'null') || ',' || coalesce(slot_id, 'null')
    || ',ht_sum:' || ht_sum || ',lt_sum:' || lt_sum || ',pt_sum:' || pt_sum || ',count:' || fd_count
    || ',ht_avg:' || {_f('ht_avg')} || ',lt_avg:' || {_f('lt_avg')} || ',pt_avg:' || {_f('pt_avg')} AS value
    FROM ({LANDING_GROUP_AVG})"""

LANDING_FORM_COUNTS = f"""WITH {LAND}
SELECT dt, CASE WHEN has_fd THEN fd ELSE 'null' END AS fd, count(*) AS n_rows
FROM land WHERE slot_id IN ('F', '') GROUP BY ALL"""
LANDING_FORM_DUPS = f"SELECT * FROM ({LANDING_FORM_COUNTS}) WHERE n_rows > 1"

_BUCKETS = f"""WITH {FORM}
SELECT dt, CASE WHEN slot_id = 'another-landing-slot' THEN 'else' WHEN has_fd THEN fd ELSE 'null_fd' END AS bucket,
       count(*) AS n_rows FROM form GROUP BY ALL"""
LANDING_FORM_BUCKETS = _BUCKETS
_PARTS = java_split("bucket", "ref=")
LANDING_FORM_QUALITY = f"""SELECT dt, count(*) FILTER (WHERE len({_PARTS}) > 1 AND NOT contains({_PARTS}[1], '=&')) AS n_complete
FROM ({_BUCKETS}) GROUP BY dt"""
SLOT_FORM_VALUES = f"""WITH {FORM}
SELECT DISTINCT dt, hour, CASE WHEN has_fd THEN fd ELSE 'null' END AS fd
FROM form WHERE slot_id = '{fixed.LANDING_SLOT}'"""

# ---- relation / copies ---------------------------------------------------
RELATION_SELECT_ALL = f"WITH {RECORDS} SELECT key, value FROM records"
RELATION_COUNT = f"WITH {RECORDS} SELECT count(*) AS n FROM records"
RELATION_KEY_LINES = f"WITH {RECORDS} SELECT 'Key: ' || key || ', Value: ' || value AS line FROM records WHERE key < 10"
RELATION_KEY_LOOKUP = f"WITH {RECORDS} SELECT key FROM records WHERE key = 1"
PARQUET_VALUE_ALIAS = f"WITH {RECORDS} SELECT value AS a FROM records WHERE key = 1"
EPISODES = "SELECT p_partkey, p_name, p_brand, p_size AS doctor FROM part"

# ---- stream --------------------------------------------------------------
STREAM_WORD_COUNT = f"""SELECT part, CAST(1 AS BIGINT) AS parts_in_batch, word, count(*) AS n FROM (
  SELECT part, unnest({java_split("line", " ")}) AS word
  FROM (SELECT CAST(doc_id % (SELECT greatest(6, count(*) // 50000) FROM documents) AS INTEGER) AS part, unnest(string_split(text, chr(10))) AS line FROM documents))
GROUP BY part, word"""

STREAM_WORDS = f"""SELECT word, count(*) AS n FROM (SELECT unnest({java_split("line", " ")}) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word"""

# ---- hourly directories --------------------------------------------------
HOURLY_INGEST = f"""WITH {BID}
SELECT CASE WHEN dt > DATE '2024-01-20' OR row_id % 10 = 0 THEN 2 ELSE 1 END AS run, dt, hour,
       count(*) AS n_rows, count(DISTINCT row_id) AS n_ids FROM bid GROUP BY ALL"""
HOURLY_RANGE = f"""WITH {BID} SELECT dt, hour, slot_id, count(*) AS n_rows FROM bid WHERE {DAYS} AND hour BETWEEN 6 AND 17 GROUP BY ALL"""
YESTERDAY_CLICKS = f"""WITH {CLICK} SELECT 0 AS days_back, slot_id, count(*) AS n_rows FROM click
WHERE dt = (SELECT max(dt) FROM click) GROUP BY slot_id"""

ORACLE: dict[str, str] = {
    "funnel_by_dims": _funnel(DEFAULT_DIMS),
    "funnel_day_grain": _funnel(DEFAULT_DIMS, grain="day"),
    "funnel_abtest_daily": _funnel(ABTEST_DIMS, per_day=True),
    "funnel_version_daily": _funnel(VERSION_DIMS, per_day=True),
    "funnel_slot_range": _funnel(DEFAULT_DIMS, where=f"slot_id = '1' AND {DAYS} AND hour BETWEEN 6 AND 17"),
    "funnel_text": _funnel_text(),
    "funnel_abtest_daily_text": _funnel_abtest_text(),
    "funnel_version_daily_text": _funnel_version_text(),
    "impression_enrich": _enrich("impr"),
    "click_enrich": _enrich("click"),
    "impression_enrich_sponsor": _enrich_sponsor("impr"),
    "click_enrich_sponsor": _enrich_sponsor("click"),
    "impression_enrich_text": _enrich_text("impr"),
    "click_enrich_text": _enrich_text("click"),
    "slot_cohort_reach": SLOT_COHORT_REACH,
    "cohort_size": COHORT_SIZE,
    "click_device_times": CLICK_DEVICE_TIMES,
    "sponsor_click_devices": SPONSOR_CLICK_DEVICES,
    "one_sponsor_click_devices": ONE_SPONSOR_CLICK_DEVICES,
    "cohort_reach": COHORT_REACH,
    "cohort_reach_ids": COHORT_IDS,
    "cohort_reach_ids_text": f"SELECT id AS value FROM ({COHORT_IDS})",
    "dsp_new_by_hour": DSP_NEW_BY_HOUR,
    "reach_cumulative_hours": REACH_CUMULATIVE,
    "reach_cumulative_late": f"SELECT * FROM ({REACH_CUMULATIVE}) WHERE dt >= DATE '2024-01-20'",
    "cohort_by_app_flag": COHORT_BY_APP_FLAG,
    "cohort_reach_bloom": COHORT_IDS,
    "dsp_new_by_hour_salted": DSP_NEW_BY_HOUR,
    "cohort_by_app_flag_salted": COHORT_BY_APP_FLAG,
    "funnel_incremental": _funnel(DEFAULT_DIMS),
    "enrich_bucketed": f"SELECT *, 'impr' AS feed FROM ({_enrich('impr')}) UNION ALL SELECT *, 'click' FROM ({_enrich('click')})",
    "slot_device_pairs": _pairs(PV_CANDS),
    "slot_device_counts": SLOT_DEVICE_COUNTS,
    "landing_daily_avg": LANDING_DAILY_AVG,
    "landing_group_avg": LANDING_GROUP_AVG,
    "landing_daily_strict": LANDING_DAILY_STRICT,
    "landing_daily_text": LANDING_DAILY_TEXT,
    "landing_group_text": LANDING_GROUP_TEXT,
    "landing_form_counts": LANDING_FORM_COUNTS,
    "landing_form_dups": LANDING_FORM_DUPS,
    "landing_form_buckets": LANDING_FORM_BUCKETS,
    "landing_form_quality": LANDING_FORM_QUALITY,
    "slot_form_values": SLOT_FORM_VALUES,
    "relation_select_all": RELATION_SELECT_ALL,
    "relation_count": RELATION_COUNT,
    "relation_key_lines": RELATION_KEY_LINES,
    "relation_key_lookup": RELATION_KEY_LOOKUP,
    "parquet_roundtrip": RELATION_SELECT_ALL,
    "parquet_value_alias": PARQUET_VALUE_ALIAS,
    "episodes_count": "SELECT count(*) AS n FROM part",
    "episodes_filter_copy": f"{EPISODES} WHERE p_size > 5",
    "episodes_take": f"{EPISODES} WHERE p_size > 5 ORDER BY p_partkey LIMIT 10",
    "stream_word_count": STREAM_WORD_COUNT,
    "stream_word_count_timed": f"SELECT part, word, n FROM ({STREAM_WORD_COUNT})",
    "stream_running_totals": STREAM_WORDS,
    "stream_first_seen": FIRST_SEEN,
    "hourly_ingest": HOURLY_INGEST,
    "hourly_layout_range": HOURLY_RANGE,
    "yesterday_clicks": YESTERDAY_CLICKS,
}
