"""Source extracts. Sorting is optional: later plans do not need it and skip its shuffle.

Each sort ends in the row id, so a hot employee is spread over range partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.names import full_name
from tenura.operators.joins import lookup_rows
from tenura.sources.readers import profile_tables


def _department_names(departments: DataFrame, *columns: str) -> DataFrame:
    return departments.select("department_id", *columns)


def _maybe_sorted(df: DataFrame, ordered: bool, *columns: str) -> DataFrame:
    return df.orderBy(*columns) if ordered else df


def employees(employees: DataFrame, departments: DataFrame, ordered: bool = False) -> DataFrame:
    """Employees with the name and location of their department."""
    names = _department_names(departments, "department_name", "location")
    joined = employees.join(names, "department_id", "left").select(
        "employee_id", "first_name", "last_name", "email", "hire_date", "job_title",
        "status", "department_id", "manager_id", "created_at", "department_name", "location",
    )
    return _maybe_sorted(joined, ordered, "employee_id")


def departments(departments: DataFrame, employees: DataFrame, ordered: bool = False) -> DataFrame:
    """Departments with the full name of their manager; NULL without a manager."""
    people = employees.select("employee_id", "first_name", "last_name")
    managers = lookup_rows(departments, people, "manager_id", "employee_id").select(
        F.col("employee_id").alias("manager_id"), full_name(nulls="empty").alias("manager_name")
    )
    joined = departments.join(managers, "manager_id", "left").select(
        "department_id", "department_name", "location", "manager_id", "manager_name", "created_at"
    )
    return _maybe_sorted(joined, ordered, "department_id")


def salaries(salaries: DataFrame, ordered: bool = False) -> DataFrame:
    rows = salaries.select(
        "salary_id", "employee_id", "amount", "currency", "effective_date", "end_date", "created_at"
    )
    return _maybe_sorted(rows, ordered, "employee_id", "effective_date", "salary_id")


def reviews(reviews: DataFrame, ordered: bool = False) -> DataFrame:
    rows = reviews.select(
        "review_id", "employee_id", "reviewer_id", "rating", "review_date", "comments", "created_at"
    )
    return _maybe_sorted(rows, ordered, "employee_id", "review_date", "review_id")


def projects(projects: DataFrame, departments: DataFrame, ordered: bool = False) -> DataFrame:
    """Projects with the name of their department."""
    joined = projects.join(_department_names(departments, "department_name"), "department_id", "left").select(
        "project_id", "project_name", "department_id", "department_name",
        "start_date", "end_date", "status", "budget", "created_at",
    )
    return _maybe_sorted(joined, ordered, "project_id")


def assignments(employee_projects: DataFrame, ordered: bool = False) -> DataFrame:
    rows = employee_projects.select("emp_project_id", "employee_id", "project_id", "role", "assigned_date")
    return _maybe_sorted(rows, ordered, "employee_id", "emp_project_id")


def approved_leaves(leaves: DataFrame, ordered: bool = False) -> DataFrame:
    """Approved leave requests with their length in days."""
    rows = leaves.filter(F.col("status") == "approved").select(
        "leave_id", "employee_id", "leave_type", "start_date", "end_date", "status",
        F.datediff("end_date", "start_date").alias("leave_days"), "created_at",
    )
    return _maybe_sorted(rows, ordered, "employee_id", "start_date", "leave_id")


def extract_all(source: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All extracts by name, lazily."""
    return {
        "employees": employees(source["employees"], source["departments"]),
        "departments": departments(source["departments"], source["employees"]),
        "salaries": salaries(source["salaries"]),
        "reviews": reviews(source["performance_reviews"]),
        "projects": projects(source["projects"], source["departments"]),
        "emp_projects": assignments(source["employee_projects"]),
        "leaves": approved_leaves(source["leave_requests"]),
    }


def extract_profile(extracts: dict[str, DataFrame]) -> DataFrame:
    return profile_tables(extracts)
