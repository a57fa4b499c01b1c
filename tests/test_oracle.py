"""Registered queries against their SQL statements on the smallest tables.

FULL_ORACLE=1 runs all of them; by default one query per family.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, compare
from tests.conftest import SMALL

FAMILIES = [
    "exec_revenue_summary", "fct_mrr_movements", "agg_segment_rollup", "top_expanding_per_month", "mrr_rollforward", "cohort_base",
    "fct_customer_cohorts", "usage_flags", "ticket_burden", "fct_account_monthly_health", "fct_sales_conversion",
    "mart_customer_success_summary", "report_waterfall", "report_account_movements", "silver_latest_per_key", "join_theta_spine",
    "request_log_rollup", "dq_sql_checks", "stripe_events_normalize", "incremental_lookback", "stream_webhook_upsert",
    "stream_dedupe_events", "stream_usage_counts", "full_refresh",
]
# text-corpus queries have tests of their own against brute force
CORPUS, CORPUS_SQL = entry.corpus()
QUERIES = {k: v for k, v in entry.queries().items() if k not in CORPUS}
SQL = {k: v for k, v in entry.oracle_sql().items() if k not in CORPUS_SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def test_every_query_has_a_statement():
    assert set(SQL) == set(QUERIES) and set(CORPUS_SQL) <= set(CORPUS)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("FULL_ORACLE") else FAMILIES)
def test_same_rows(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], SQL[name], SMALL)
    assert result.startswith("ok"), result
