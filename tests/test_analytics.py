"""Reports on the small company, and the invariants every result has to keep."""

from __future__ import annotations

import statistics

import pytest

from people import company
from tenura.plans import analytics
from tenura.plans.dimensions import dim_leave_type
from tenura.settings import Limits

AS_OF = "2024-01-01"
MODES = pytest.mark.parametrize("limits", [Limits(), Limits(0)], ids=["plain", "split"])


@pytest.fixture(scope="module")
def t(spark):
    tables = company(spark)
    return {**tables, "staff": analytics.enrich_employees(tables["employees"], AS_OF).cache()}


@MODES
def test_salary_distribution(t, limits):
    rows = analytics.salary_distribution(t["employees"], t["salaries"], t["departments"], limits).collect()
    found = {r["department_name"]: r for r in rows}
    engineering = found["Engineering"]
    paid = [120.0, 200.0, 210.0]
    assert engineering["headcount"] == 3  # two open salaries of one employee count twice
    assert float(engineering["avg_salary"]) == round(statistics.mean(paid), 2)
    assert engineering["salary_stddev"] == round(statistics.stdev(paid), 2)
    assert (float(engineering["min_salary"]), float(engineering["max_salary"])) == (120.0, 210.0)
    assert found["Analytics"]["salary_stddev"] is None
    assert found[None]["headcount"] == 2  # no department and an unknown one
    averages = [float(r["avg_salary"]) for r in rows if r["avg_salary"] is not None]
    assert averages == sorted(averages, reverse=True)


@MODES
def test_review_trend(t, limits):
    rows = {r["review_id"]: r for r in analytics.review_trend(t["performance_reviews"], limits).collect()}
    assert [rows[i]["previous_rating"] for i in range(1, 8)] == [None, 2, 5, None, 3, None, None]
    assert [rows[i]["rating_change"] for i in range(1, 8)] == [None, 3, None, None, 1, None, None]
    assert [rows[i]["review_rank"] for i in range(1, 8)] == [1, 2, 3, 1, 1, 1, 1]


@MODES
def test_performance_trends(t, limits):
    rows = analytics.performance_trends(t["staff"], t["performance_reviews"], limits=limits).collect()
    found = {r["employee_id"]: r for r in rows}
    assert len(rows) == 5
    assert (found[1]["avg_rating"], found[1]["avg_improvement"], found[1]["total_reviews"]) == (3.5, 3.0, 3)
    assert (found[4]["avg_rating"], found[4]["avg_improvement"]) == (4.0, None)  # a single review
    assert found[3]["avg_rating"] is None and found[3]["total_reviews"] == 1
    assert found[5]["total_reviews"] is None
    assert [r["employee_id"] for r in rows][:3] == [4, 1, 2]
    best = analytics.top_performers(t["staff"], t["performance_reviews"], 2, limits).collect()
    assert [r["employee_id"] for r in best] == [4, 1]


@MODES
def test_attrition_risk(t, limits):
    result = analytics.attrition_risk(
        t["staff"], t["salaries"], t["performance_reviews"], t["leave_requests"], limits=limits
    )
    rows = [(r["employee_id"], r["risk_score"], r["risk_level"]) for r in result.collect()]
    # company average over all open salaries, also of terminated staff: (120+200+210+50+0)/5 = 116
    # 1: leave 25 days; 2: tenure, twice; 4: paid 0 < 92.8
    assert sorted(rows) == [(1, 1, "LOW"), (2, 1, "LOW"), (2, 1, "LOW"), (4, 2, "MEDIUM")]
    scores = [r[1] for r in rows]
    assert scores == sorted(scores, reverse=True)
    levels = {r["risk_level"]: r["count"] for r in analytics.risk_summary(result).collect()}
    assert levels == {"LOW": 3, "MEDIUM": 1}
    assert analytics.high_risk(result).count() == 0
    factors = analytics.risk_factors(
        t["staff"], t["salaries"], t["performance_reviews"], t["leave_requests"], limits
    ).first()
    assert tuple(factors) == (0, 1, 1, 2)


def test_level_ladder_of_scores(t):
    result = analytics.attrition_risk(t["staff"], t["salaries"], t["performance_reviews"], t["leave_requests"])
    for r in result.collect():
        expected = "HIGH" if r["risk_score"] >= 4 else "MEDIUM" if r["risk_score"] >= 2 else "LOW"
        assert r["risk_level"] == expected and 0 <= r["risk_score"] <= 6


def test_overview_and_breakdowns(t):
    one = analytics.overview(t["employees"], t["salaries"], t["performance_reviews"]).first()
    assert (one["total_employees"], float(one["avg_salary"]), one["avg_rating"]) == (5, 116.0, 3.6)
    heads = analytics.headcount_by_department(t["employees"], t["departments"]).collect()
    assert sum(r["headcount"] for r in heads) == 5
    titles = {r["job_title"]: r["headcount"] for r in analytics.pay_by_title(t["employees"], t["salaries"]).collect()}
    assert titles[None] == 2 and titles["VP"] == 1
    top = analytics.top_earners(t["staff"], t["salaries"], 3).collect()
    assert sorted(float(r["amount"]) for r in top) == [120.0, 200.0, 210.0]
    ratings = {r["rating"]: r["review_count"] for r in analytics.rating_distribution(t["performance_reviews"]).collect()}
    assert ratings == {None: 2, 2: 1, 3: 1, 4: 2, 5: 1}
    rated = {
        r["department_name"]: (r["avg_rating"], r["rated_reviews"])
        for r in analytics.rating_by_department(t["employees"], t["performance_reviews"], t["departments"]).collect()
    }
    assert rated == {"Engineering": (3.5, 4), "Analytics": (None, 0), None: (4.0, 1)}
    below = analytics.below_company_average(t["employees"], t["salaries"]).collect()
    assert {(r["employee_id"], r["below_by"]) for r in below} == {(3, 66.0), (4, 116.0)}


def test_leave_patterns(spark, t):
    rows = analytics.leave_patterns(t["leave_requests"], t["employees"], t["departments"], dim_leave_type(spark))
    found = {r["leave_type"]: (r["requests"], r["total_leave_days"], r["is_paid"]) for r in rows.collect()}
    assert found == {"annual": (1, 10, True), "sick": (2, 45, True), "unpaid": (1, 2, False)}
