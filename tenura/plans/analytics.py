"""Workforce reports: pay, review trends, attrition risk, leave, overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.dates import as_of_date, tenure_years
from tenura.functions.names import full_name
from tenura.functions.rules import level_of, points, rule_score
from tenura.operators.aggregates import amount_stats, average_rating, leave_days, top_n
from tenura.operators.history import current_rows
from tenura.operators.joins import fan_out_left, lookup_rows
from tenura.operators.ordered import Neighbour, Rank, over_groups
from tenura.settings import Limits

RISK_STEPS = [(4, "HIGH"), (2, "MEDIUM")]
LOWEST_RISK = "LOW"


def enrich_employees(employees: DataFrame, as_of=None) -> DataFrame:
    """Add full_name and tenure_years."""
    return employees.withColumns(
        {"full_name": full_name(), "tenure_years": tenure_years(F.col("hire_date"), as_of_date(as_of))}
    )


def open_salaries(salaries: DataFrame) -> DataFrame:
    return current_rows(salaries).select("employee_id", "amount")


def staff_pay(
    employees: DataFrame,
    salaries: DataFrame,
    departments: DataFrame,
    *columns: str,
    limits: Limits | None = None,
) -> DataFrame:
    """Every employee with their open salaries and department name, plus ``columns`` of employees."""
    staff = employees.select("employee_id", "department_id", *columns)
    names = departments.select("department_id", "department_name")
    paid = fan_out_left(staff, open_salaries(salaries), ["employee_id"], limits)
    return paid.join(names, "department_id", "left")


def salary_distribution(
    employees: DataFrame, salaries: DataFrame, departments: DataFrame, limits: Limits | None = None
) -> DataFrame:
    """Headcount and current-salary statistics per department, best paid first."""
    stats = (
        staff_pay(employees, salaries, departments, limits=limits)
        .groupBy("department_name")
        .agg(F.count("employee_id").alias("headcount"), *amount_stats("amount"))
    )
    return stats.orderBy(F.desc_nulls_last("avg_salary"), "department_name")


def review_trend(reviews: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Each review with the previous rating, the change from it, and its rank by date."""
    with_history = over_groups(
        reviews,
        ["employee_id"],
        ["review_date", "review_id"],
        [Neighbour("rating", "previous_rating", -1), Rank("review_rank", ("review_date",))],
        limits,
    )
    return with_history.withColumn("rating_change", F.col("rating") - F.col("previous_rating"))


def review_summary(reviews: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Average rating, average change and number of reviews per employee.

    Only the change is needed here, so no rank is computed.
    """
    narrow = reviews.select("employee_id", "review_date", "review_id", "rating")
    changes = over_groups(
        narrow,
        ["employee_id"],
        ["review_date", "review_id"],
        [Neighbour("rating", "previous_rating", -1)],
        limits,
    )
    return changes.groupBy("employee_id").agg(
        F.round(F.avg("rating"), 1).alias("avg_rating"),
        F.round(F.avg(F.col("rating") - F.col("previous_rating")), 2).alias("avg_improvement"),
        F.count("review_id").alias("total_reviews"),
    )


def performance_trends(
    employees: DataFrame, reviews: DataFrame, ordered: bool = True, limits: Limits | None = None
) -> DataFrame:
    """Review summary of every employee, best rated first; ``employees`` carry full_name."""
    result = (
        employees.select("employee_id", "full_name", "job_title")
        .join(review_summary(reviews, limits), "employee_id", "left")
        .select("employee_id", "full_name", "job_title", "avg_rating", "avg_improvement", "total_reviews")
    )
    return result.orderBy(F.desc_nulls_last("avg_rating"), "employee_id") if ordered else result


def top_performers(
    employees: DataFrame, reviews: DataFrame, n: int = 10, limits: Limits | None = None
) -> DataFrame:
    trends = performance_trends(employees, reviews, ordered=False, limits=limits)
    return top_n(trends, n, F.desc_nulls_last("avg_rating"), "employee_id")


def company_average(salaries: DataFrame) -> DataFrame:
    """One row: the average of all open salaries, whatever the status of their employee."""
    return open_salaries(salaries).agg(F.avg("amount").cast("double").alias("company_avg_salary"))


def risk_rules(average_pay: Column) -> list[tuple[str, Column, int]]:
    """(name, condition, points); unknown measures score nothing."""
    return [
        ("low_rating", F.col("avg_rating") < 3, 2),
        ("low_pay", F.col("amount").cast("double") < average_pay * 0.8, 2),
        ("high_leave", F.col("total_leave_days") > 20, 1),
        ("long_tenure", F.col("tenure_years") > 5, 1),
    ]


def _active_with_measures(employees, salaries, reviews, leaves, limits):
    """Active employees with rating, leave days and open salary, and the company average."""
    active = employees.filter(F.col("status") == "active").select(
        "employee_id", "full_name", "job_title", "tenure_years"
    )
    measured = active.join(average_rating(reviews), "employee_id", "left").join(
        leave_days(leaves), "employee_id", "left"
    )
    paid = fan_out_left(measured, open_salaries(salaries), ["employee_id"], limits)
    return paid, company_average(salaries).scalar()


def attrition_risk(
    employees: DataFrame,
    salaries: DataFrame,
    reviews: DataFrame,
    leaves: DataFrame,
    ordered: bool = True,
    limits: Limits | None = None,
) -> DataFrame:
    """Risk score and level of every active employee, highest first.

    ``employees`` carry full_name and tenure_years. The company average is a
    scalar subquery: nothing is collected and the plan stays one query.
    """
    staff, average_pay = _active_with_measures(employees, salaries, reviews, leaves, limits)
    score = rule_score([(condition, score) for _, condition, score in risk_rules(average_pay)])
    result = staff.withColumn("risk_score", score).select(
        "employee_id",
        "full_name",
        "job_title",
        "avg_rating",
        "amount",
        "tenure_years",
        "risk_score",
        level_of(F.col("risk_score"), RISK_STEPS, LOWEST_RISK).alias("risk_level"),
    )
    return result.orderBy(F.desc("risk_score"), "employee_id") if ordered else result


def risk_summary(risk: DataFrame) -> DataFrame:
    """Number of employees per level, in level order."""
    return risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count")).orderBy("risk_level")


def high_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest scores among the HIGH level."""
    return top_n(risk.filter(F.col("risk_level") == "HIGH"), n, F.desc("risk_score"), "employee_id")


def risk_factors(
    employees: DataFrame,
    salaries: DataFrame,
    reviews: DataFrame,
    leaves: DataFrame,
    limits: Limits | None = None,
) -> DataFrame:
    """How many active employees each rule applies to: one row, one column per rule."""
    staff, average_pay = _active_with_measures(employees, salaries, reviews, leaves, limits)
    return staff.agg(*[F.sum(points(condition, 1)).alias(name) for name, condition, _ in risk_rules(average_pay)])


def below_company_average(employees: DataFrame, salaries: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Employees with an open salary under the company average, and the gap to it."""
    average_pay = company_average(salaries).scalar()
    paid = fan_out_left(employees.select("employee_id"), open_salaries(salaries), ["employee_id"], limits)
    amount = F.col("amount").cast("double")
    return paid.filter(amount < average_pay).select(
        "employee_id", "amount", F.round(average_pay - amount, 2).alias("below_by")
    )


def overview(employees: DataFrame, salaries: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: employees, average open salary, average rating."""
    pay = open_salaries(salaries).agg(F.round(F.avg("amount"), 2).alias("avg_salary"))
    rating = reviews.agg(F.round(F.avg("rating"), 1).alias("avg_rating"))
    return employees.agg(F.count("employee_id").alias("total_employees")).select(
        "total_employees", pay.scalar().alias("avg_salary"), rating.scalar().alias("avg_rating")
    )


def headcount_by_department(employees: DataFrame, departments: DataFrame) -> DataFrame:
    counts = employees.groupBy("department_id").agg(F.count("employee_id").alias("headcount"))
    named = counts.join(departments.select("department_id", "department_name"), "department_id", "left")
    return named.select("department_id", "department_name", "headcount")


def pay_by_department(
    employees: DataFrame, salaries: DataFrame, departments: DataFrame, limits: Limits | None = None
) -> DataFrame:
    paid = staff_pay(employees, salaries, departments, limits=limits)
    return paid.groupBy("department_name").agg(F.round(F.avg("amount"), 2).alias("avg_salary"))


def pay_by_title(employees: DataFrame, salaries: DataFrame, limits: Limits | None = None) -> DataFrame:
    staff = employees.select("employee_id", "job_title")
    paid = fan_out_left(staff, open_salaries(salaries), ["employee_id"], limits)
    return paid.groupBy("job_title").agg(
        F.count("employee_id").alias("headcount"), F.round(F.avg("amount"), 2).alias("avg_salary")
    )


def top_earners(
    employees: DataFrame, salaries: DataFrame, n: int = 10, limits: Limits | None = None
) -> DataFrame:
    """The ``n`` best paid with their names.

    The top-n comes first and its ids filter the employees where they are
    scanned, so neither table is shuffled for ``n`` rows.
    """
    best = top_n(open_salaries(salaries), n, F.desc("amount"), "employee_id")
    named = lookup_rows(best, employees.select("employee_id", "full_name", "job_title"), "employee_id", "employee_id")
    # a join of few rows does not keep their order
    sorted_rows = best.join(named, "employee_id", "left").orderBy(F.desc("amount"), "employee_id")
    return sorted_rows.select("employee_id", "full_name", "job_title", "amount")


def rating_by_department(employees: DataFrame, reviews: DataFrame, departments: DataFrame) -> DataFrame:
    """Average rating of all reviews per department.

    Reviews are summed per employee first, so an employee with very many
    reviews is one row in the joins.
    """
    per_employee = reviews.groupBy("employee_id").agg(
        F.sum("rating").alias("_sum"), F.count("rating").alias("_rated")
    )
    joined = (
        employees.select("employee_id", "department_id")
        .join(per_employee, "employee_id")
        .join(departments.select("department_id", "department_name"), "department_id", "left")
    )
    average = F.round(F.sum("_sum") / F.nullif(F.sum("_rated"), F.lit(0)), 1)
    return joined.groupBy("department_name").agg(average.alias("avg_rating"), F.sum("_rated").alias("rated_reviews"))


def rating_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("review_count"))


def leave_patterns(
    leaves: DataFrame, employees: DataFrame, departments: DataFrame, leave_types: DataFrame
) -> DataFrame:
    """Requests and days by department and leave type, with the attributes of the type.

    Requests are summed per employee and type before the joins.
    """
    per_employee = leaves.groupBy("employee_id", "leave_type").agg(
        F.count(F.lit(1)).alias("_requests"), F.sum(F.datediff("end_date", "start_date")).alias("_days")
    )
    placed = per_employee.join(employees.select("employee_id", "department_id"), "employee_id", "left")
    grouped = placed.groupBy("department_id", "leave_type").agg(
        F.sum("_requests").alias("requests"), F.sum("_days").alias("total_leave_days")
    )
    return (
        grouped.join(departments.select("department_id", "department_name"), "department_id", "left")
        .join(leave_types.select("leave_type", "category", "is_paid"), "leave_type", "left")
        .select("department_name", "leave_type", "category", "is_paid", "requests", "total_leave_days")
    )
