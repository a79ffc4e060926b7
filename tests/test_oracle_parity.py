"""Registered queries against their DuckDB oracle on sf0.001 (exact)."""
import collections
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

from conftest import SF_SMALL

SAMPLE = ["clean_flows", "validate_flow", "dim_attack", "fact_network_event", "summary_attack_hourly",
          "summary_top_sources", "q1_s", "q3_s", "q4_f", "q5_d", "q7_s", "q7_f", "q7_d", "q8_f",
          "q9_s", "q11_d", "q12_s", "q2_g", "q10_g", "kpis", "day_of_week_heatmap", "heatmap_pivot"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", SAMPLE)
def test_parity(spark, con, name):
    st = E.queries()[name](spark, SF_SMALL).toArrow()
    ot = con.sql(E.oracle_sql()[name]).to_arrow_table()
    sc, sr = rows_of(st)
    oc, orr = rows_of(ot)
    assert sc == oc
    assert collections.Counter(sr) == collections.Counter(orr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["attack_category", "total_events"]
    assert df.count() > 0
