"""Registered queries against DuckDB on the given tables, and the entry points."""

import os

import duckdb
import pytest

from opspulse.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
SOME = ["clean_report", "rollups", "kpi_status", "flag_anomalies", "regularize", "expand_shifts", "upsert", "backtest", "stream_upsert", "holiday_flags"]
SOME += ["read_report_files", "read_csv_coerced", "read_many_files", "read_shift_json", "replace_partitions", "stream_report_files", "stream_corrections"]
SOME += ["stream_busy_blocks", "stream_inflow_daily", "stream_alerts", "score_by_cutoff", "compare_models", "user_model", "latest_alerts", "regressor_sweep"]
SOME += ["lag_sums", "ar_one_lag", "stream_oncall_blocks"]
SOME += ["trend_gram", "season_cells", "cells_as_of", "stream_alert_changes", "staffing_counts", "staffing_steps", "orders_on_hebrew_holidays"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(str(float(r[i])) if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) else str(r[i]) for i in order) for r in rows])


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in duck.description]
    assert plain(got.collect(), got.columns) == plain(duck.fetchall(), names)


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_every_oracle_is_sql():
    import __spark_entry__ as e

    assert all(isinstance(sql, str) for sql in e.oracle_sql().values())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
