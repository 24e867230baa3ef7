"""Every bound query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from oracle_check import connect, differences
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


# the queries with a window or a fan-out join, once more as for large tables:
# no broadcast by size, and every key with more than a few rows split
SPLIT = [
    "salary_distribution",
    "salary_distribution_fan_out",
    "review_trend",
    "performance_trends",
    "top_performers",
    "attrition_risk",
    "risk_factors",
    "below_company_average",
    "pay_by_title",
    "close_history",
    "uniquify",
    "surrogate_keys",
    "key_lookup",
    "fact_snapshot",
    "fact_snapshot_avg_rating",
    "fct_employee_snapshot",
    "monthly_snapshot",
    "warehouse_build",
]


@pytest.fixture
def split_keys(spark):
    settings = {
        "spark.tenura.maxGroupRows": "7",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", SPLIT)
def test_split_query_matches_sql(spark, connection, split_keys, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_every_bound_query():
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_staff_report_is_not_written_by_one_task(spark, monkeypatch):
    from tenura.sources import writers

    asked, export = [], writers.export_csv
    monkeypatch.setattr(writers, "export_csv", lambda df, path, one_file=False: asked.append(one_file) or export(df, path, one_file))
    assert QUERIES["report_csv"](spark, "/root/testdata/sf0.001").count() and asked == [False]
