"""Physical plans: what reaches the scan, what is shuffled, and what must never appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from people import company
from tenura.operators.joins import lookup_rows
from tenura.operators.keys import group_leaders
from tenura.plans import analytics, extract, facts
from tenura.sources.writers import save_as_table
from workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan_of(df)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    tables = {}
    for name, df in company(spark).items():
        df.write.parquet(str(folder / name))
        tables[name] = spark.read.parquet(str(folder / name))
    return tables


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python_in_any_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "MapInArrow", "MapPartitions", "Collect"):
        assert node not in plan.replace("CollectLimit", ""), node


def test_open_salaries_filter_and_columns_reach_the_scan(stored):
    plan = plan_of(analytics.salary_distribution(stored["employees"], stored["salaries"], stored["departments"]))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "amount" in line)
    assert "IsNull(end_date)" in scan
    assert "salary_id" not in scan and "currency" not in scan


def test_active_filter_reaches_the_scan(stored):
    staff = analytics.enrich_employees(stored["employees"], "2024-01-01")
    risk = analytics.attrition_risk(staff, stored["salaries"], stored["performance_reviews"], stored["leave_requests"])
    assert "EqualTo(status,active)" in plan_of(risk) and "EqualTo(status,approved)" in plan_of(risk)


def test_measures_share_the_partitioning_of_the_employee(no_broadcast, stored):
    staff = analytics.enrich_employees(stored["employees"], "2024-01-01")
    risk = analytics.attrition_risk(
        staff, stored["salaries"], stored["performance_reviews"], stored["leave_requests"], ordered=False
    )
    plan = plan_of(risk)
    # employees, ratings, leaves and salaries are each shuffled once on employee_id, and joined without another shuffle
    assert len(re.findall(r"Exchange hashpartitioning\(employee_id", plan)) == 4
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4


def test_review_summary_aggregates_on_the_window_partitioning(no_broadcast, stored):
    plan = plan_of(analytics.review_summary(stored["performance_reviews"]))
    assert len(re.findall("Exchange", plan)) == 1 and "rank(" not in plan


def test_aggregates_are_partial_before_the_shuffle(stored):
    plan = plan_of(facts.latest_rating(stored["performance_reviews"]))
    assert "partial_max_by" in plan
    plan = plan_of(facts.project_count(stored["employee_projects"]))
    assert "partial_count" in plan


def test_group_members_are_cut_before_the_shuffle(stored):
    _, reporting = group_leaders(stored["employees"].drop("manager_id"), "department_id", "employee_id", "manager_id", first_n=20)
    assert plan_of(reporting).count("WindowGroupLimit") == 2


def test_small_into_large_lookup_filters_the_large_side_where_it_is_scanned(stored):
    found = lookup_rows(stored["departments"], stored["employees"], "manager_id", "employee_id")
    plan = final_plan(found)
    assert "LeftSemi, BuildRight" in plan
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]


def test_extracts_do_not_sort_unless_asked(stored):
    extracts = extract.extract_all({**stored})
    assert all("Sort " not in plan_of(df) for df in extracts.values())


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast, stored, tmp_path):
    people = save_as_table(stored["employees"], "bucketed_people", str(tmp_path / "p"), "employee_id", 4)
    pay = save_as_table(stored["salaries"], "bucketed_pay", str(tmp_path / "s"), "employee_id", 4)
    joined = people.select("employee_id", "department_id").join(pay.select("employee_id", "amount"), "employee_id", "left")
    assert "Exchange" not in plan_of(joined)
    assert joined.agg(F.count("amount")).first()[0] == 6


def test_company_average_reuses_the_salary_shuffle(spark):
    plan = final_plan(QUERIES["attrition_risk"](spark, SF_DIR))
    assert "ReusedExchange" in plan
