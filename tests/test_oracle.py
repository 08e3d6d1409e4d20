"""Every registered query against its DuckDB oracle (sf0.001, order-insensitive)."""

import collections
import datetime
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adsift.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert bag(rows, df.columns) == bag(orows, ocols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["mcc", "vendor", "nsv", "av"]


TZ_SENSITIVE = ["impression_enrich", "click_enrich_text", "sponsor_click_devices", "landing_form_quality",
                "slot_form_values", "funnel_by_dims", "dsp_new_by_hour", "landing_daily_avg"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = con.execute(oracle_sql()[name])
    assert bag(rows, df.columns) == bag(cur.fetchall(), [d[0] for d in cur.description])
