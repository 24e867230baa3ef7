"""Staging views: cleaned source rows, nothing aggregated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.dates import as_of_date, tenure_years
from tenura.functions.names import full_name, or_default


def stg_employees(employees: DataFrame, as_of=None) -> DataFrame:
    """Employees with an id and an e-mail; lower-case e-mail, full name and tenure added."""
    kept = employees.filter(F.col("employee_id").isNotNull() & F.col("email").isNotNull())
    return kept.select(
        "employee_id",
        "first_name",
        "last_name",
        full_name(nulls="empty").alias("full_name"),
        F.lower("email").alias("email"),
        "hire_date",
        "job_title",
        "department_id",
        "manager_id",
        "status",
        "created_at",
        "updated_at",
        tenure_years(F.col("hire_date"), as_of_date(as_of)).alias("tenure_years"),
    )


def stg_salaries(salaries: DataFrame) -> DataFrame:
    """Salary rows with an employee and a positive amount, flagged current if open."""
    kept = salaries.filter(F.col("employee_id").isNotNull() & (F.col("amount") > 0))
    return kept.select(
        "salary_id",
        "employee_id",
        F.col("amount").alias("salary_amount"),
        "currency",
        "effective_date",
        "end_date",
        F.col("end_date").isNull().alias("is_current"),
        "created_at",
    )


def stg_departments(departments: DataFrame) -> DataFrame:
    return departments.filter(F.col("department_id").isNotNull()).select(
        "department_id", "department_name", or_default("location", "Unknown"), "manager_id", "created_at"
    )
