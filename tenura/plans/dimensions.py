"""Dimension tables in the two layouts: star schema and staged models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.dates import as_of_date, date_key, days_between, iso_weekday, quarter_label, tenure_years
from tenura.functions.names import full_name, or_default
from tenura.operators.history import scd2_columns
from tenura.operators.joins import lookup_rows
from tenura.schemas import LEAVE_TYPES

NO_MANAGER = "Not Assigned"
UNKNOWN = "Unknown"


def dates_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def date_attributes(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The date dimension for the dates in ``days``."""
    d = F.col(day)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        quarter_label(d).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def dim_date(spark: SparkSession, start_year: int = 2015, end_year: int = 2026) -> DataFrame:
    return date_attributes(dates_between(spark, f"{start_year}-01-01", f"{end_year}-12-31"))


def dim_department(departments: DataFrame, effective="2015-01-01") -> DataFrame:
    """From extracted departments, which carry the manager name."""
    cleaned = departments.select(
        "department_id", "department_name", or_default("location", UNKNOWN), or_default("manager_name", NO_MANAGER)
    )
    return scd2_columns(cleaned, as_of_date(effective))


def dim_employee(employees: DataFrame, as_of=None, effective="2015-01-01") -> DataFrame:
    """From extracted employees, which carry the department name."""
    hired = F.col("hire_date").cast("date")
    cleaned = employees.select(
        "employee_id",
        "first_name",
        "last_name",
        full_name(nulls="any").alias("full_name"),
        "email",
        or_default("job_title", UNKNOWN),
        or_default("department_name", UNKNOWN),
        hired.alias("hire_date"),
        "status",
        tenure_years(hired, as_of_date(as_of), half_even=True).alias("tenure_years"),
    )
    return scd2_columns(cleaned, as_of_date(effective))


def dim_project(projects: DataFrame) -> DataFrame:
    """From extracted projects, with the planned duration in days."""
    start, end = F.col("start_date").cast("date"), F.col("end_date").cast("date")
    return projects.select(
        "project_id",
        "project_name",
        or_default("department_name", UNKNOWN),
        "status",
        start.alias("start_date"),
        end.alias("end_date"),
        "budget",
        days_between(start, end).alias("duration_days"),
    )


def dim_leave_type(spark: SparkSession) -> DataFrame:
    """The five leave types, keyed 1..5 in declared order."""
    rows = [(n, *row) for n, row in enumerate(LEAVE_TYPES, start=1)]
    return spark.createDataFrame(rows, "leave_type_key bigint, leave_type string, category string, is_paid boolean")


def dim_employees(stg_employees: DataFrame, stg_departments: DataFrame, as_of=None) -> DataFrame:
    """Staged employees with department name and location, effective as of the build date."""
    places = stg_departments.select("department_id", "department_name", "location")
    joined = stg_employees.join(places, "department_id", "left").select(
        "employee_id", "first_name", "last_name", "full_name", "email", "job_title",
        "hire_date", "status", "tenure_years", "department_name", "location",
    )
    return scd2_columns(joined, as_of_date(as_of))


def dim_departments(stg_departments: DataFrame, stg_employees: DataFrame, as_of=None) -> DataFrame:
    """Staged departments with manager name and headcount.

    Members are counted per department before the join, so a huge department
    costs one partial count per task instead of a fan-out.
    """
    members = (
        stg_employees.filter(F.col("department_id").isNotNull())
        .groupBy("department_id")
        .agg(F.count("employee_id").alias("headcount"))
    )
    people = stg_employees.select("employee_id", "full_name")
    managers = lookup_rows(stg_departments, people, "manager_id", "employee_id").select(
        F.col("employee_id").alias("manager_id"), F.col("full_name").alias("manager_name")
    )
    joined = (
        stg_departments.join(managers, "manager_id", "left")
        .join(members, "department_id", "left")
        .select(
            "department_id",
            "department_name",
            "location",
            or_default("manager_name", NO_MANAGER),
            F.coalesce("headcount", F.lit(0)).alias("headcount"),
        )
    )
    return scd2_columns(joined, as_of_date(as_of))
