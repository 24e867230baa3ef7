"""Declared tables: columns, keys, defaults and domains of source and warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: table layouts, domains and defaults the data has to meet ---

SOURCE_TABLES = {
    "departments": "department_id bigint, department_name string, location string, manager_id bigint, created_at timestamp",
    "employees": "employee_id bigint, first_name string, last_name string, email string, hire_date date, "
    "job_title string, department_id bigint, manager_id bigint, status string, created_at timestamp, updated_at timestamp",
    "salaries": "salary_id bigint, employee_id bigint, amount decimal(12,2), currency string, effective_date date, "
    "end_date date, created_at timestamp",
    "performance_reviews": "review_id bigint, employee_id bigint, reviewer_id bigint, rating int, review_date date, "
    "comments string, created_at timestamp",
    "projects": "project_id bigint, project_name string, department_id bigint, start_date date, end_date date, "
    "status string, budget decimal(15,2), created_at timestamp",
    "employee_projects": "emp_project_id bigint, employee_id bigint, project_id bigint, role string, assigned_date date",
    "leave_requests": "leave_id bigint, employee_id bigint, leave_type string, start_date date, end_date date, "
    "status string, created_at timestamp",
}

WAREHOUSE_TABLES = {
    "dim_date": "date_key int, full_date date, year int, quarter int, quarter_name string, month int, "
    "month_name string, week_of_year int, day_of_week int, day_name string, is_weekend boolean, is_holiday boolean",
    "dim_department": "department_key bigint, department_id bigint, department_name string, location string, "
    "manager_name string, effective_date date, expiry_date date, is_current boolean",
    "dim_employee": "employee_key bigint, employee_id bigint, first_name string, last_name string, full_name string, "
    "email string, job_title string, department_name string, hire_date date, status string, "
    "tenure_years decimal(5,2), effective_date date, expiry_date date, is_current boolean",
    "dim_project": "project_key bigint, project_id bigint, project_name string, department_name string, status string, "
    "start_date date, end_date date, budget decimal(15,2), duration_days int",
    "dim_leave_type": "leave_type_key bigint, leave_type string, category string, is_paid boolean",
    "fact_employee_snapshot": "snapshot_id bigint, employee_key bigint, department_key bigint, date_key int, "
    "project_key bigint, salary_amount decimal(12,2), performance_rating decimal(3,1), leave_days_taken int, "
    "project_count int, is_active boolean, load_timestamp timestamp, source_system string",
}

DEFAULTS = {
    "departments": {"created_at": "now"},
    "employees": {"status": "active", "created_at": "now", "updated_at": "now"},
    "salaries": {"currency": "USD", "created_at": "now"},
    "performance_reviews": {"created_at": "now"},
    "projects": {"status": "active", "created_at": "now"},
    "employee_projects": {"assigned_date": "today"},
    "leave_requests": {"status": "approved", "created_at": "now"},
    "dim_date": {"is_holiday": False},
    "dim_department": {"expiry_date": "9999-12-31", "is_current": True},
    "dim_employee": {"expiry_date": "9999-12-31", "is_current": True},
    "fact_employee_snapshot": {
        "leave_days_taken": 0,
        "project_count": 0,
        "load_timestamp": "now",
        "source_system": "hr_postgresql",
    },
}

PRIMARY_KEYS = {
    "departments": "department_id",
    "employees": "employee_id",
    "salaries": "salary_id",
    "performance_reviews": "review_id",
    "projects": "project_id",
    "employee_projects": "emp_project_id",
    "leave_requests": "leave_id",
    "dim_date": "date_key",
    "dim_department": "department_key",
    "dim_employee": "employee_key",
    "dim_project": "project_key",
    "dim_leave_type": "leave_type_key",
    "fact_employee_snapshot": "snapshot_id",
}

UNIQUE_KEYS = {"employees": [["email"]], "employee_projects": [["employee_id", "project_id"]]}

NOT_NULL = {
    "departments": ["department_name"],
    "employees": ["first_name", "last_name", "email", "hire_date"],
    "salaries": ["employee_id", "amount", "effective_date"],
    "performance_reviews": ["employee_id", "review_date"],
    "projects": ["project_name"],
    "employee_projects": ["employee_id", "project_id"],
    "leave_requests": ["employee_id", "leave_type", "start_date", "end_date"],
    "dim_date": ["full_date"],
    "dim_department": ["department_id", "effective_date"],
    "dim_employee": ["employee_id", "effective_date"],
    "dim_project": ["project_id"],
}

FOREIGN_KEYS = {
    "employees": {"department_id": ("departments", "department_id"), "manager_id": ("employees", "employee_id")},
    "salaries": {"employee_id": ("employees", "employee_id")},
    "performance_reviews": {"employee_id": ("employees", "employee_id"), "reviewer_id": ("employees", "employee_id")},
    "projects": {"department_id": ("departments", "department_id")},
    "employee_projects": {"employee_id": ("employees", "employee_id"), "project_id": ("projects", "project_id")},
    "leave_requests": {"employee_id": ("employees", "employee_id")},
    "fact_employee_snapshot": {
        "employee_key": ("dim_employee", "employee_key"),
        "department_key": ("dim_department", "department_key"),
        "date_key": ("dim_date", "date_key"),
        "project_key": ("dim_project", "project_key"),
    },
}

MAX_LENGTHS = {
    "departments": {"department_name": 100, "location": 100},
    "employees": {"first_name": 50, "last_name": 50, "email": 100, "job_title": 100, "status": 20},
    "salaries": {"currency": 3},
    "projects": {"project_name": 200, "status": 20},
    "employee_projects": {"role": 100},
    "leave_requests": {"leave_type": 50, "status": 20},
    "dim_date": {"quarter_name": 10, "month_name": 10, "day_name": 10},
    "dim_department": {"department_name": 100, "location": 100, "manager_name": 100},
    "dim_employee": {
        "first_name": 50,
        "last_name": 50,
        "full_name": 100,
        "email": 100,
        "job_title": 100,
        "department_name": 100,
        "status": 20,
    },
    "dim_project": {"project_name": 200, "department_name": 100, "status": 20},
    "dim_leave_type": {"leave_type": 50, "category": 50},
    "fact_employee_snapshot": {"source_system": 50},
}

RANGES = {"performance_reviews": {"rating": (1, 5)}}

LEAVE_TYPES = [
    ("annual", "personal", True),
    ("sick", "medical", True),
    ("maternity", "parental", True),
    ("paternity", "parental", True),
    ("unpaid", "personal", False),
]

SALARY_BANDS = {
    "Junior": (55000, 80000),
    "Associate": (60000, 85000),
    "Analyst": (65000, 95000),
    "Engineer": (90000, 140000),
    "Senior": (110000, 160000),
    "Lead": (130000, 180000),
    "Manager": (120000, 175000),
    "Director": (160000, 220000),
    "VP": (200000, 300000),
    "CFO": (250000, 400000),
    "CMO": (250000, 400000),
    "COO": (250000, 400000),
}
DEFAULT_SALARY_BAND = (60000, 100000)

# --- end of fixed values ---


def schema_of(table: str) -> StructType:
    return StructType.fromDDL({**SOURCE_TABLES, **WAREHOUSE_TABLES}[table])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(table))


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill missing columns, and NULLs of present ones, with their default."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), _default(value)) if name in df.columns else _default(value)
            for name, value in defaults.items()
        }
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of ``table`` in order and type; missing ones get their default or NULL."""
    filled = apply_defaults(df, DEFAULTS.get(table, {}))
    return filled.select(
        *[
            (F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema_of(table)
        ]
    )


def _default(value) -> Column:
    if value == "now":
        return F.current_timestamp()
    if value == "today":
        return F.current_date()
    return F.lit(value)
