"""Data-quality checks on the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tenura.operators import quality
from tenura.plans import models, warehouse
from tenura.plans.dimensions import NO_MANAGER
from tenura.settings import new_path
from workload.registry import query
from workload.roles import AS_OF

LINE_KEY = ["l_orderkey", "l_linenumber"]


def line(table: str, check: str, columns: str, failing: str) -> str:
    """One report row; ``failing`` is a scalar subquery or expression."""
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{columns}' AS columns, "
        f"CAST({failing} AS BIGINT) AS failing_rows, {failing} = 0 AS passed"
    )


def lines(*rows: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(line(*row) for row in rows)


def count_where(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


def repeated(table: str, columns: str) -> str:
    first = columns.split(",")[0]
    return (
        f"(SELECT count(*) FROM (SELECT {columns} FROM {table} WHERE {first} IS NOT NULL "
        f"GROUP BY {columns} HAVING count(*) > 1))"
    )


def orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} c WHERE c.{key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key}))"
    )


@query(
    "dq_unique",
    "",
    lines(
        ("lineitem", "unique", "l_orderkey,l_linenumber", repeated("lineitem", "l_orderkey,l_linenumber")),
        ("orders", "unique", "o_orderkey", repeated("orders", "o_orderkey")),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.unique(r.table("lineitem"), "lineitem", LINE_KEY),
            quality.unique(r.table("orders"), "orders", ["o_orderkey"]),
        ]
    )


@query(
    "dq_duplicate_keys",
    "",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(r):
    return quality.duplicate_keys(r.table("lineitem"), LINE_KEY)


@query(
    "dq_not_null",
    "employees reviews",
    lines(
        ("employees", "not_null", "first_name", count_where("employees", "first_name IS NULL")),
        ("employees", "not_null", "last_name", count_where("employees", "last_name IS NULL")),
        ("employees", "not_null", "email", count_where("employees", "email IS NULL")),
        ("reviews", "not_null", "rating", count_where("reviews", "rating IS NULL")),
    ),
)
def _(r):
    names = [quality.not_null(c) for c in ("first_name", "last_name", "email")]
    return quality.combine(
        [
            quality.row_checks(r.employees, "employees", names),
            quality.row_checks(r.reviews, "reviews", [quality.not_null("rating")]),
        ]
    )


@query(
    "dq_accepted_values",
    "employees",
    lines(
        (
            "employees",
            "accepted_values",
            "status",
            count_where("employees", "status NOT IN ('active', 'terminated', 'inactive')"),
        ),
        ("orders", "accepted_values", "o_orderstatus", count_where("orders", "o_orderstatus NOT IN ('F', 'O')")),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.row_checks(
                r.employees, "employees", [quality.accepted_values("status", models.MODEL_STATUS_VALUES)]
            ),
            quality.row_checks(r.table("orders"), "orders", [quality.accepted_values("o_orderstatus", ["F", "O"])]),
        ]
    )


@query(
    "dq_foreign_key",
    "projects departments leaves employees",
    lines(
        (
            "projects",
            "references",
            "department_id",
            orphans("projects", "department_id", "departments", "department_id"),
        ),
        ("leaves", "references", "employee_id", orphans("leaves", "employee_id", "employees", "employee_id")),
        ("lineitem", "references", "l_orderkey", orphans("lineitem", "l_orderkey", "orders", "o_orderkey")),
    ),
)
def _(r):
    lineitem, orders = r.table("lineitem"), r.table("orders")
    return quality.combine(
        [
            quality.references(r.projects, r.departments, "department_id", "department_id", "projects"),
            quality.references(r.leaves, r.employees, "employee_id", "employee_id", "leaves"),
            quality.references(lineitem, orders, "l_orderkey", "o_orderkey", "lineitem"),
        ]
    )


@query(
    "dq_orphan_keys",
    "projects departments",
    """SELECT department_id, count(*) AS row_count FROM projects
    WHERE department_id NOT IN (SELECT department_id FROM departments) GROUP BY 1""",
)
def _(r):
    return quality.orphan_keys(r.projects, r.departments, "department_id", "department_id")


@query(
    "dq_check_range",
    "reviews",
    lines(
        ("reviews", "in_range", "rating", count_where("reviews", "rating NOT BETWEEN 1 AND 5")),
        ("lineitem", "in_range", "l_quantity", count_where("lineitem", "l_quantity NOT BETWEEN 5 AND 45")),
        ("lineitem", "non_negative", "l_discount", count_where("lineitem", "l_discount < 0")),
    ),
)
def _(r):
    lineitem = [quality.in_range("l_quantity", 5, 45), quality.non_negative("l_discount")]
    return quality.combine(
        [
            quality.row_checks(r.reviews, "reviews", [quality.in_range("rating", 1, 5)]),
            quality.row_checks(r.table("lineitem"), "lineitem", lineitem),
        ]
    )


@query(
    "dq_non_negative",
    "",
    lines(
        ("customer", "non_negative", "c_acctbal", count_where("customer", "c_acctbal < 0")),
        ("supplier", "non_negative", "s_acctbal", count_where("supplier", "s_acctbal < 0")),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.row_checks(r.table("customer"), "customer", [quality.non_negative("c_acctbal")]),
            quality.row_checks(r.table("supplier"), "supplier", [quality.non_negative("s_acctbal")]),
        ]
    )


@query(
    "dq_implication",
    "leaves",
    lines(
        (
            "leaves",
            "implies",
            "status",
            count_where("leaves", "leave_type = 'unpaid' AND status NOT IN ('approved')"),
        ),
        (
            "orders",
            "implies",
            "weekday",
            count_where("orders", "dayname(o_orderdate) IN ('Saturday', 'Sunday') AND isodow(o_orderdate) < 6"),
        ),
    ),
)
def _(r):
    unpaid = quality.implies(F.col("leave_type") == "unpaid", "status", ["approved"])
    day = F.col("o_orderdate").cast("date")
    days = r.table("orders").select(
        (F.weekday(day) + 1).alias("weekday"), F.date_format(day, "EEEE").isin("Saturday", "Sunday").alias("is_weekend")
    )
    weekend = quality.implies(F.col("is_weekend"), "weekday", [6, 7])
    return quality.combine(
        [quality.row_checks(r.leaves, "leaves", [unpaid]), quality.row_checks(days, "orders", [weekend])]
    )


@query(
    "dq_primary_key",
    "employees leaves",
    lines(
        ("employees", "primary_key", "employee_id", repeated("employees", "employee_id")),
        (
            "employees",
            "primary_key",
            "email",
            f"({repeated('employees', 'email')} + {count_where('employees', 'email IS NULL')})",
        ),
        ("leaves", "primary_key", "leave_id", repeated("leaves", "leave_id")),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.primary_key(r.employees, "employees", ["employee_id"]),
            quality.primary_key(r.employees, "employees", ["email"]),
            quality.primary_key(r.leaves, "leaves", ["leave_id"]),
        ]
    )


@query(
    "dq_min_rows",
    "",
    lines(
        ("nation", "minimum_rows", "", "(SELECT greatest(100 - count(*), 0) FROM nation)"),
        ("orders", "minimum_rows", "", "(SELECT greatest(365 - count(*), 0) FROM orders)"),
        ("lineitem", "minimum_rows", "", "(SELECT greatest(100 - count(*), 0) FROM lineitem)"),
    ),
)
def _(r):
    least = {"nation": 100, "orders": 365, "lineitem": 100}
    return warehouse.minimum_row_report({name: r.table(name) for name in least}, least)


@query(
    "dq_required_columns",
    "",
    lines(
        ("orders", "required_columns", "o_orderkey,o_totalprice", "(SELECT (count(o_orderkey) = 0)::INT + (count(o_totalprice) = 0)::INT FROM orders)"),
        ("orders", "required_columns", "o_orderkey,full_name,status", "(SELECT 2 + (count(o_orderkey) = 0)::INT FROM orders)"),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.required_columns(r.table("orders"), "orders", ["o_orderkey", "o_totalprice"]),
            quality.required_columns(r.table("orders"), "orders", ["o_orderkey", "full_name", "status"]),
        ]
    )


_KNOWN = "email IS NOT NULL"
_OPEN_PAY = "(SELECT employee_id FROM salaries WHERE end_date IS NULL AND amount > 0)"


@query(
    "dq_report",
    "employees departments salaries",
    lines(
        ("dim_employees", "unique", "employee_id", repeated(f"(FROM employees WHERE {_KNOWN})", "employee_id")),
        ("dim_employees", "unique", "email", repeated(f"(FROM employees WHERE {_KNOWN})", "lower(email)")),
        ("dim_employees", "not_null", "employee_id", count_where("employees", f"{_KNOWN} AND employee_id IS NULL")),
        ("dim_employees", "not_null", "email", count_where("employees", f"{_KNOWN} AND email IS NULL")),
        (
            "dim_employees",
            "accepted_values",
            "status",
            count_where("employees", f"{_KNOWN} AND status NOT IN ('active', 'terminated', 'inactive')"),
        ),
        ("dim_employees", "not_null", "tenure_years", count_where("employees", f"{_KNOWN} AND hire_date IS NULL")),
        ("dim_departments", "unique", "department_id", repeated("departments", "department_id")),
        ("dim_departments", "not_null", "department_id", count_where("departments", "department_id IS NULL")),
        ("dim_departments", "not_null", "department_name", count_where("departments", "department_name IS NULL")),
        (
            "fct_employee_snapshot",
            "unique",
            "employee_id",
            repeated(f"(FROM employees LEFT JOIN {_OPEN_PAY} USING (employee_id) WHERE {_KNOWN})", "employee_id"),
        ),
        ("fct_employee_snapshot", "not_null", "employee_id", count_where("employees", "employee_id IS NULL")),
        ("fct_employee_snapshot", "not_null", "current_salary", count_where("salaries", "amount IS NULL")),
        ("fct_employee_snapshot", "not_null", "is_active", count_where("employees", f"{_KNOWN} AND status IS NULL")),
    ),
)
def _(r):
    built = models.build_models(r.spark, r.source, new_path(r.spark, "models"), AS_OF)
    return models.model_checks(built)


def _source_rows():
    keys = [
        ("departments", "departments", "department_id"),
        ("employees", "employees", "employee_id"),
        ("salaries", "salaries", "salary_id"),
        ("performance_reviews", "reviews", "review_id"),
        ("projects", "projects", "project_id"),
        ("employee_projects", "assignments", "emp_project_id"),
        ("leave_requests", "leaves", "leave_id"),
    ]
    required = {
        "departments": "department_name",
        "employees": "first_name last_name email hire_date",
        "salaries": "employee_id amount effective_date",
        "performance_reviews": "employee_id review_date",
        "projects": "project_name",
        "employee_projects": "employee_id project_id",
        "leave_requests": "employee_id leave_type start_date end_date",
    }
    parents = {
        "employees": [("department_id", "departments", "department_id"), ("manager_id", "employees", "employee_id")],
        "salaries": [("employee_id", "employees", "employee_id")],
        "performance_reviews": [
            ("employee_id", "employees", "employee_id"),
            ("reviewer_id", "employees", "employee_id"),
        ],
        "projects": [("department_id", "departments", "department_id")],
        "employee_projects": [("employee_id", "employees", "employee_id"), ("project_id", "projects", "project_id")],
        "leave_requests": [("employee_id", "employees", "employee_id")],
    }
    for table, role, key in keys:
        yield table, "primary_key", key, repeated(role, key)
        for column in required[table].split():
            yield table, "not_null", column, count_where(role, f"{column} IS NULL")
        for column, parent, parent_key in parents.get(table, []):
            yield table, "references", column, orphans(role, column, parent, parent_key)
    lengths = {
        "departments": "department_name:100 location:100",
        "employees": "first_name:50 last_name:50 email:100 job_title:100 status:20",
        "salaries": "currency:3",
        "projects": "project_name:200 status:20",
        "employee_projects": "role:100",
        "leave_requests": "leave_type:50 status:20",
    }
    for table, role, _ in keys:
        for column, limit in (item.split(":") for item in lengths.get(table, "").split()):
            yield table, "max_length", column, count_where(role, f"length({column}) > {limit}")
    yield "employees", "unique", "email", repeated("employees", "email")
    pair = "employee_id,project_id"
    yield "employee_projects", "unique", pair, repeated("assignments", pair)
    yield "performance_reviews", "in_range", "rating", count_where("reviews", "rating NOT BETWEEN 1 AND 5")


@query(
    "dq_source_report",
    "departments employees salaries reviews projects assignments leaves",
    lines(*_source_rows()),
)
def _(r):
    return warehouse.source_checks(r.source)


@query(
    "dq_max_length",
    "",
    lines(
        ("documents", "max_length", "text", count_where("documents", "length(text) > 2000")),
        ("part", "max_length", "p_name", count_where("part", "length(p_name) > 10")),
    ),
)
def _(r):
    return quality.combine(
        [
            quality.row_checks(r.table("documents"), "documents", [quality.max_length("text", 2000)]),
            quality.row_checks(r.table("part"), "part", [quality.max_length("p_name", 10)]),
        ]
    )


@query(
    "dq_warehouse_failures",
    "employees departments salaries",
    """SELECT 'fact_employee_snapshot' AS "table", 'references' AS "check", 'department_key' AS columns,
    count(*) AS failing_rows
    FROM employees e JOIN departments d USING (department_id)
    LEFT JOIN (SELECT employee_id FROM salaries WHERE end_date IS NULL) USING (employee_id)
    WHERE d.manager_id IS NULL""",
)
def _(r):
    """The failing constraints of the loaded warehouse when departments without a manager are missing from it."""
    loaded = warehouse.build_warehouse(
        r.spark, r.source, new_path(r.spark, "warehouse"), AS_OF, 1995, 2002, minimum_rows={"dim_date": 365}
    )
    managed = loaded["dim_department"].filter(F.col("manager_name") != NO_MANAGER)
    report = warehouse.warehouse_checks({**loaded, "dim_department": managed})
    return report.filter(~F.col("passed")).select("table", "check", "columns", "failing_rows")


@query(
    "dq_failing_checks",
    "reviews employees",
    f"SELECT \"table\", columns, failing_rows FROM ("
    f"{line('reviews', 'not_null', 'rating', count_where('reviews', 'rating IS NULL'))} UNION ALL "
    f"{line('reviews', 'in_range', 'rating', count_where('reviews', 'rating NOT BETWEEN 2 AND 4'))} UNION ALL "
    f"{line('employees', 'not_null', 'last_name', count_where('employees', 'last_name IS NULL'))}) WHERE NOT passed",
)
def _(r):
    report = reduce(
        lambda a, b: a.unionByName(b),
        [
            quality.row_checks(r.reviews, "reviews", [quality.not_null("rating"), quality.in_range("rating", 2, 4)]),
            quality.row_checks(r.employees, "employees", [quality.not_null("last_name")]),
        ],
    )
    return report.filter(~F.col("passed")).select("table", "columns", "failing_rows")
